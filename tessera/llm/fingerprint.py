"""Threshold-scaled sketches of documents.

A sketch retains every distinct shingle hash below a fixed fraction of the hash space, so its
size follows the document's, the sketch of a union is the union of the sketches, and the share
of one sketch in another estimates containment however unequal the documents are. Shingles are
five lower-cased words; a shorter text's whole sequence is its one shingle.

As text a sketch is the base64 of its hashes in ascending order, 48 bits each (big-endian, after
the leading bits that the threshold fixes). A text none of whose hashes lie below the threshold is
written as ``=`` and a hash of all its shingles, so equal texts have equal fingerprints and
unequal tiny ones do not.

Defined results: a null text is an empty one; equal fingerprints have likeness 1, a sketch
without hashes has likeness 0 to any other. Repeated rows and empty tables need no care.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import stored, table
from tessera.llm.words import distinct_sorted, mixed, overlap, shingle_runs, slices

SCALE = 8        # one of so many hashes is retained
KEPT_BITS = 48


def sketches(texts: pa.Array, scale: int = SCALE) -> list[tuple[np.ndarray, str]]:
    """Retained hashes (sorted) and fingerprint of each text."""
    limit = np.uint64((1 << 64) // scale)
    lead = np.uint64(64 - KEPT_BITS - (int(scale).bit_length() - 1))
    out = []
    for s in slices(texts):
        hashes, bounds = shingle_runs(s.word_from, s.word_hashes())
        for i in range(len(s)):
            own = hashes[bounds[i]: bounds[i + 1]]
            kept = distinct_sorted(own[own < limit])
            if len(kept):
                code = (kept >> lead).astype(">u8").view(np.uint8).reshape(-1, 8)[:, -(KEPT_BITS // 8):]
                name = base64.b64encode(code.tobytes()).decode()
            else:
                whole = mixed(distinct_sorted(own)).sum(dtype=np.uint64) if len(own) else np.uint64(0)
                name = f"={int(whole):016x}"
            out.append((kept, name))
    return out


def likeness(a: tuple[np.ndarray, str], b: tuple[np.ndarray, str]) -> float:
    """Estimated Jaccard similarity of two texts' shingles."""
    if a[1] == b[1]:
        return 1.0
    common = overlap(a[0], b[0])
    return common / max(1, len(a[0]) + len(b[0]) - common)


def containment(a: tuple[np.ndarray, str], b: tuple[np.ndarray, str]) -> float:
    """Estimated share of the first text's shingles that the second has too."""
    return 1.0 if a[1] == b[1] else overlap(a[0], b[0]) / max(1, len(a[0]))


def merged(fingerprints: DataFrame, group: str, fingerprint: str = "fingerprint") -> DataFrame:
    """Sketch of the union of each group's documents: one fingerprint per group.

    Hashes are made distinct as rows, so a large group is reduced before the shuffle; what is
    gathered is the group's own sketch. A group of texts without retained hashes gets ``=``.
    """
    width = KEPT_BITS // 8
    held = fingerprints.select(F.col(group).alias("group"), F.col(fingerprint).alias("sketch"))
    code = F.unbase64("sketch")
    pieces = F.transform(F.sequence(F.lit(0), (F.octet_length(code) / width).cast("int") - 1),
                         lambda i: F.hex(F.substring(code, i * width + 1, F.lit(width))))
    each = held.select("group", F.explode(F.when(~F.col("sketch").startswith("="), pieces)).alias("hash")).distinct()
    found = each.unionByName(held.select("group", F.lit(None).cast("string").alias("hash")).distinct())
    union = F.base64(F.unhex(F.array_join(F.sort_array(F.collect_list("hash")), "")))
    union = F.translate(union, "\r\n", "")  # Spark breaks base64 into lines
    return found.groupBy("group").agg(F.when(F.count("hash") > 0, union).otherwise("=").alias("fingerprint")).select(
        F.col("group").alias(group), "fingerprint")


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the start of ``following``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, contained_edited double, contained_next double")
_EDGES = _RESULT + ", edge string, part int, packed binary"


def _rows(ids: list, texts: list[str], known: list) -> list[tuple]:
    """Result rows of all texts but the last, each against the one after it."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    of_changed = sketches(pa.array(changed, pa.large_string()))
    return [(ids[i], len(texts[i]), hashlib.sha256(changed[i].encode()).hexdigest(), known[i][1], of_changed[i][1],
             likeness(known[i], of_changed[i]), likeness(known[i], known[i + 1]),
             containment(known[i], of_changed[i]), containment(known[i], known[i + 1]))
            for i in range(len(changed))]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
             "binary": pa.binary()}
    fields = [c.split(" ") for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)],
                                      names=[n for n, _ in fields])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd bytes: the shuffle moves those."""
    press = zstandard.ZstdCompressor(level=3)
    for b in batches:
        packed = [press.compress((t.as_py() or "").encode()) for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())],
                                         names=["doc_id", "tie", "packed"])


def _open(packed: pa.Array) -> list[str]:
    unpress = zstandard.ZstdDecompressor()
    return [unpress.decompress(x.as_py()).decode() for x in packed]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition: rows but the last, then its first and last texts for its neighbours."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    held, first = None, None

    def edge(kind: str, row: tuple) -> tuple:
        return (row[0],) + (None,) * 8 + (kind, part, row[1])

    for b in batches:
        for at in range(0, b.num_rows, 512):
            piece = b.slice(at, 512)
            ids, texts = piece.column(0).to_pylist(), _open(piece.column(2))
            known = sketches(pa.array(texts, pa.large_string()))
            first = first or (ids[0], piece.column(2)[0].as_py())
            tail = (ids[-1], piece.column(2)[len(ids) - 1].as_py())
            if held:
                ids, texts, known = [held[0], *ids], [held[1], *texts], [held[2], *known]
            if len(ids) > 1:
                yield _batch([r + (None, part, None) for r in _rows(ids, texts, known)], _EDGES)
            held = (ids[-1], texts[-1], known[-1])
    if first:
        yield _batch([edge("first", first), edge("last", tail)], _EDGES)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows for the last document of each partition and the first of the next one."""
    for b in batches:
        for i in range(b.num_rows):
            pair = _open(b.column(1).slice(i, 1)) + _open(b.column(2).slice(i, 1))
            yield _batch(_rows([b.column(0)[i].as_py(), None], pair, sketches(pa.array(pair, pa.large_string()))),
                         _RESULT)


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each document and of its edited text; see ``edited``.

    The next document is the one with the next smaller id (nulls last, equal ids by a hash of
    the text; after the last one the first). One range shuffle of the compressed texts puts
    neighbours side by side; only the first and last document of each partition meet in a join.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(docs[text]).alias("tie"),
                       docs[text].alias("text"))
    packed = rows.mapInArrow(_packed, "doc_id long, tie long, packed binary")
    order = [F.desc_nulls_last("doc_id"), F.asc("tie")]
    walked = packed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_walk, _EDGES)
    walked = stored(walked, "fingerprints")
    firsts = walked.where("edge = 'first'").select("part", F.col("packed").alias("following"))
    lasts = walked.where("edge = 'last'").select("doc_id", "packed", F.col("part").alias("own"))
    by_part = Window.orderBy("part")  # one narrow row per partition
    parts = firsts.select("part").withColumn("next", F.lead("part").over(by_part))
    parts = parts.withColumn("next", F.coalesce("next", F.first("part").over(by_part)))
    ends = (lasts.join(parts.withColumnRenamed("part", "own"), "own")
            .join(firsts, F.col("next") == F.col("part")).select("doc_id", "packed", "following"))
    return walked.where("edge is null").drop("edge", "part", "packed").unionByName(ends.mapInArrow(_across, _RESULT))


def op3_fingerprints(spark, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "documents"))
