"""Documents to packed training sequences, in five stages.

1. quality rules: documents that the label model or the base rules reject go;
2. line dedup: later copies of a line go, with them documents that lose every line;
3. n-gram Jaccard join: one document of each group of near duplicates stays;
4. mixing: sources are mixed to their target weights, documents repeated or left out;
5. packing: documents become pieces of token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. ``run`` writes each stage's rows as Parquet in the shared folder and reads
them back as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.jaccard_join import one_of_each
from tessera.llm.line_dedup import drop_repeated_lines
from tessera.llm.mixing import mix
from tessera.llm.packing import default_tokenizer, pack
from tessera.llm.quality import keep_good
from tessera.llm.shared import drop_stored, stored, table
from tessera.llm.tokensets import TEXT_ROWS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, default_tokenizer())


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources to target weights", mixing), ("packing", packing)]

#: The label model, hashes and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{k}", TEXT_ROWS)
        drop_stored(*before)
        before = [docs]
    return docs
