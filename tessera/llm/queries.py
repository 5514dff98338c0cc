"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from tessera.llm.filter_audit import OP11_SQL, op11_filter_audit
from tessera.llm.fingerprint import op3_fingerprints
from tessera.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from tessera.llm.jaccard_join import OP2_SQL, op2_token_group_join
from tessera.llm.line_dedup import OP5_SQL, op5_line_dedup
from tessera.llm.mixing import op10_mixing
from tessera.llm.packing import op4_packing
from tessera.llm.quality import op7_quality_rules
from tessera.llm.secrets import op9_secret_scans
from tessera.llm.sharding import op6_kd_shards
from tessera.llm.token_store import op13_token_store
from tessera.llm.url_filter import OP8_SQL, op8_url_filters
from tessera.llm.warc import OP1_SQL, op1_warc_revisits

QUERIES = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_token_group_join": op2_token_group_join,
    "op3_fingerprints": op3_fingerprints,
    "op4_packing": op4_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_kd_shards": op6_kd_shards,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filters": op8_url_filters,
    "op9_secret_scans": op9_secret_scans,
    "op10_mixing": op10_mixing,
    "op11_filter_audit": op11_filter_audit,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_store": op13_token_store,
}

ORACLE = {
    "op1_warc_revisits": OP1_SQL,
    "op2_token_group_join": OP2_SQL,
    "op5_line_dedup": OP5_SQL,
    "op8_url_filters": OP8_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}
