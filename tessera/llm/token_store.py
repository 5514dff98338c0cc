"""Token ids of a corpus in binary files, with Elias-Fano coded document boundaries.

A file is a sequence of segments, each the ids of consecutive documents one after another (2 bytes an id where the
vocabulary allows it, else 4), followed by two Elias-Fano sequences: where each document ends among the segment's ids,
and the document ids themselves. A sequence of n values up to u takes about 2 + log2(u / n) bits a value: the low bits
are stored as they are, the rest as ones in a bit vector, the one of value i standing at (value >> low) + i. Samples of
the places of every 256th one (32 bits each) let ``select`` return any value after looking at a few bytes. So a
document is found, and its ids are sliced, without a table of 64-bit offsets.

Writing: documents are tokenised once, dealt to shards by ranges of the document id, sorted there and written by Spark's
text sink, a segment per row: files appear only when a task commits, on any file system that Spark knows. The ranges
come from approximate quantiles of the ids (8 bytes a shard reach the driver); an id that alone fills several ranges is
split between them by the hash of its texts. Reading: ``binaryFile``; a document's place in the corpus is its place in
its segment and the ids of all segments before it, summed in two levels.

Layout of a segment, little-endian: 8 bytes ``TOKSEG01``; the segment's bytes, number of documents, of ids and the
smallest document id (64 bits each); shard, number in the shard, bytes of an id, documents without an id, CRC-32 of all
behind the header (32 bits each); the ids; two sequences. A sequence: low bits, bytes of the upper part, number of
samples (32 bits each); low part, upper part, samples.

Defined results: a null or empty text is the end id alone. Documents stand in ascending order of their id, equal ids by
the hash of their text, null ids last (they have no entry in the second sequence). Repeated rows are written each. An
empty table gives a folder without segments.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.packing import default_tokenizer, encoder
from tessera.llm.shared import scratch_path, stored, table, writing

MAGIC, END_ID = b"TOKSEG01", 2
SHARD_BYTES = 16 << 20    # of text in a shard, about
SEGMENT_IDS = 1 << 20     # a segment ends behind the document that reaches this
SAMPLE = 256              # every so many ones of the upper part are sampled
TEXT_ROWS = 500           # rows of an Arrow batch of texts or their ids
BLOCK = 1024              # shards whose ids are summed together
_HEAD = struct.Struct("<8sQQQqIIIII")
_SEQUENCE = struct.Struct("<III")
_U = np.uint64


@dataclass
class EliasFano:
    """A non-decreasing sequence of numbers below 2^64, as three byte strings."""

    n: int
    low_bits: int
    low: bytes
    upper: bytes
    samples: np.ndarray

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, _U)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", np.zeros(0, "<u4"))
        if (values[1:] < values[:-1]).any():
            raise ValueError("the values fall")
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        ones = (values >> _U(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        low = (values[:, None] >> np.arange(low_bits, dtype=_U)) & _U(1)
        return cls(n, low_bits, np.packbits(low.astype(np.uint8).reshape(-1), bitorder="little").tobytes(),
                   np.packbits(bits, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4"))

    def _ones(self, first: int, until: int | None) -> np.ndarray:
        """Places of the ones among the upper bits [first, until), from the byte on in which ``first`` lies."""
        part = np.frombuffer(self.upper, np.uint8)[first >> 3: None if until is None else (until >> 3) + 1]
        return np.flatnonzero(np.unpackbits(part, bitorder="little")) + (first >> 3 << 3)

    def select(self, i: int) -> int:
        """Value i: from the sample before it on, as far as the next sample at most."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        k = i // SAMPLE
        first = int(self.samples[k])
        ones = self._ones(first, int(self.samples[k + 1]) if k + 1 < len(self.samples) else None)
        one = int(ones[np.searchsorted(ones, first) + i % SAMPLE])
        at = i * self.low_bits
        end = at + self.low_bits
        low = int.from_bytes(self.low[at >> 3: (end + 7) >> 3], "little") >> (at & 7)
        return (one - i) << self.low_bits | low & ((1 << self.low_bits) - 1)

    def values(self) -> np.ndarray:
        """All values."""
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), count=self.n * self.low_bits, bitorder="little")
        low = (bits.reshape(self.n, self.low_bits).astype(_U) << np.arange(self.low_bits, dtype=_U)).sum(1, dtype=_U)
        high = (self._ones(0, None) - np.arange(self.n)).astype(_U)
        return (high << _U(self.low_bits)) | low

    def find(self, value: int) -> int:
        """Place of the first value that is not smaller, by bisection over ``select``."""
        a, z = 0, self.n
        while a < z:
            mid = (a + z) // 2
            if self.select(mid) < value:
                a = mid + 1
            else:
                z = mid
        return a

    def tobytes(self) -> bytes:
        return (_SEQUENCE.pack(self.low_bits, len(self.upper), len(self.samples)) + self.low + self.upper
                + self.samples.astype("<u4").tobytes())

    @classmethod
    def read(cls, data: memoryview, at: int, n: int) -> tuple[EliasFano, int]:
        """The sequence of ``n`` values at ``at``, and where it ends."""
        low_bits, upper, samples = _SEQUENCE.unpack_from(data, at)
        at += _SEQUENCE.size
        edges = np.cumsum([at, (n * low_bits + 7) // 8, upper, 4 * samples]).tolist()
        low, up, some = (data[a:z] for a, z in zip(edges, edges[1:]))
        return cls(n, low_bits, bytes(low), bytes(up), np.frombuffer(some, "<u4")), edges[-1]


@dataclass
class Segment:
    """Ids of consecutive documents."""

    shard: int
    number: int
    first_id: int          # the smallest document id
    nameless: int          # documents at the end without an id
    ids: np.ndarray
    ends: EliasFano
    names: EliasFano       # document ids, less the smallest

    def __len__(self) -> int:
        return self.ends.n

    @classmethod
    def of(cls, shard: int, number: int, documents: list[tuple[int | None, np.ndarray]]) -> Segment:
        """``documents``: (id, token ids), ids ascending, null ids last."""
        named = [d for d, _ in documents if d is not None]
        first = named[0] if named else 0
        names = np.array(named, np.int64).view(_U) - np.array([first], np.int64).view(_U)
        return cls(shard, number, first, len(documents) - len(named), np.concatenate([x for _, x in documents]),
                   EliasFano.encode(np.cumsum([len(x) for _, x in documents])), EliasFano.encode(names))

    def tobytes(self) -> bytes:
        width = self.ids.dtype.itemsize
        body = self.ids.astype(f"<u{width}").tobytes() + self.ends.tobytes() + self.names.tobytes()
        return _HEAD.pack(MAGIC, _HEAD.size + len(body), len(self), len(self.ids), self.first_id, self.shard,
                          self.number, width, self.nameless, zlib.crc32(body)) + body

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[Segment, int]:
        magic, size, n, n_ids, first, shard, number, width, nameless, crc = _HEAD.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError(f"not a segment: {magic!r}")
        if len(data) < at + size or zlib.crc32(data[at + _HEAD.size: at + size]) != crc:
            raise ValueError("the segment is cut off or damaged")
        ids_at = at + _HEAD.size
        ends, next_at = EliasFano.read(data, ids_at + n_ids * width, n)
        names, _ = EliasFano.read(data, next_at, n - nameless)
        return cls(shard, number, first, nameless, np.frombuffer(data, f"<u{width}", n_ids, ids_at), ends, names), at + size

    def bounds(self, i: int) -> tuple[int, int]:
        """Where document i begins and ends among the segment's ids."""
        return self.ends.select(i - 1) if i else 0, self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        a, z = self.bounds(i)
        return self.ids[a:z]

    def find(self, doc_id: int) -> list[int]:
        """Places of the documents of this id."""
        if doc_id < self.first_id:
            return []
        at, out = self.names.find(doc_id - self.first_id), []
        while at < self.names.n and self.names.select(at) == doc_id - self.first_id:
            out.append(at)
            at += 1
        return out

    def doc_ids(self) -> list[int | None]:
        named = (self.names.values() + np.array([self.first_id], np.int64).view(_U)).view(np.int64)
        return named.tolist() + [None] * self.nameless


def segments(content: bytes) -> Iterator[Segment]:
    """The segments of a file; each is followed by a line break, the sink's separator."""
    data, at = memoryview(content), 0
    while at < len(data):
        segment, at = Segment.read(data, at)
        yield segment
        at += 1


def id_bytes(tokenizer: str, end_id: int) -> int:
    """2 if all ids of the tokenizer and the end id fit into two bytes, else 4."""
    from tokenizers import Tokenizer
    vocabulary = Tokenizer.from_file(tokenizer).get_vocab()
    return 2 if max(end_id, *vocabulary.values()) < 1 << 16 else 4


def _ranges(docs: DataFrame, shard_bytes: int) -> tuple[np.ndarray, int]:
    """Largest document ids of all shards but the last, and how many shards documents without an id have."""
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 16
    total = docs.agg(F.sum(F.when(F.col("doc_id").isNotNull(), size)).alias("named"),
                     F.sum(F.when(F.col("doc_id").isNull(), size)).alias("nameless")).first()
    shards = max(1, -(-(total["named"] or 0) // shard_bytes))
    if shards == 1:
        return np.zeros(0, np.int64), -(-(total["nameless"] or 0) // shard_bytes)
    at = [k / shards for k in range(1, shards)]
    bounds = docs.agg(F.percentile_approx("doc_id", at, max(10_000, 100 * shards))).first()[0]
    return np.array(bounds, np.int64), -(-(total["nameless"] or 0) // shard_bytes)


def dealt_to(ids: pa.Array, hashes: np.ndarray, bounds: np.ndarray, nameless: int) -> np.ndarray:
    """The shard of each document. Where one id spans several shards, and for null ids, its hash decides."""
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    value = ids.fill_null(0).to_numpy(zero_copy_only=False)
    first, last = np.searchsorted(bounds, value, "left"), np.searchsorted(bounds, value, "right")
    last = np.where(last > first + 1, last, first)   # an id that is one bound only lies in one shard
    first = np.where(known, first, len(bounds) + 1)
    last = np.where(known, last, len(bounds) + max(1, nameless))
    part = (hashes.astype(np.float64) / 2.0 ** 64) + 0.5
    return first + np.minimum(np.floor(part * (last - first + 1)), last - first).astype(np.int64)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, doc_id: str = "doc_id",
                 text: str = "text", shard_bytes: int = SHARD_BYTES, segment_ids: int = SEGMENT_IDS) -> None:
    """Writes the token ids of ``docs``, each document followed by ``end_id``, as files in the folder ``path``."""
    held = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    bounds, nameless = _ranges(held, shard_bytes)
    shards = len(bounds) + 1 + nameless
    kind = f"<u{id_bytes(tokenizer, end_id)}"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            blobs = []
            for x in batch.column(2):
                x = x.as_py()
                blobs.append(np.append(encode(x) if x else np.zeros(0, np.uint32), end_id).astype(kind).tobytes())
            shard = dealt_to(batch.column(0), batch.column(1).to_numpy(), bounds, nameless)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), batch.column(0), batch.column(1),
                                              pa.array(blobs, pa.binary())], names=["shard", "doc_id", "hash", "ids"])

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, open_, size = None, 0, [], 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([Segment.of(shard, number, open_).tobytes()], pa.binary())],
                                              names=["segment"])

        for batch in batches:
            for s, d, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                if open_ and (s != shard or size >= segment_ids):
                    yield closed()
                    number, open_, size = number + 1 if s == shard else 0, [], 0
                shard = s
                open_.append((d, np.frombuffer(blob.as_py(), kind)))
                size += len(open_[-1][1])
        if open_:
            yield closed()

    rows = held.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), "text")
    rows = (rows.mapInArrow(encoded, "shard int, doc_id long, hash long, ids binary")
            .repartitionById(shards, F.col("shard"))
            .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_last(), "hash")
            .mapInArrow(built, "segment binary"))
    with writing(docs.sparkSession, TEXT_ROWS):
        rows.select(F.col("segment").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def read_segments(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """A row per document: shard, segment, place, doc_id, begin (in its segment), n_tokens, ids_crc32.

    With ``keep_ids`` also ``ids``, little-endian 32-bit numbers.
    """
    schema = "shard int, segment int, place long, doc_id long, begin long, n_tokens long, ids_crc32 long"
    names = [c.split(" ")[0] for c in schema.split(", ")] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for s in segments(content.as_py()):
                    ends = s.ends.values().astype(np.int64)
                    begins = np.concatenate([[0], ends[:-1]])
                    n = len(s)
                    whole = s.ids.astype("<u4")
                    parts = [whole[a:z].tobytes() for a, z in zip(begins, ends)]
                    columns = [pa.array(np.full(n, s.shard, np.int32)), pa.array(np.full(n, s.number, np.int32)),
                               pa.array(np.arange(n)), pa.array(s.doc_ids(), pa.int64()), pa.array(begins),
                               pa.array(ends - begins), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns + [pa.array(parts, pa.binary())] * keep_ids, names=names)

    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(run, schema + ", ids binary" * keep_ids))


def summed_before(sizes: DataFrame) -> DataFrame:
    """shard, segment, base: the ids of all segments before. ``sizes``: shard, segment, n.

    Sums within blocks of shards, then over the blocks: no task sees more than a block's segments or all blocks.
    """
    earlier = (Window.unboundedPreceding, -1)
    held = sizes.withColumn("block", F.floor(F.col("shard") / BLOCK))
    blocks = held.groupBy("block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("block", F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(*earlier)),
                                               F.lit(0)).alias("start"))
    inside = F.sum("n").over(Window.partitionBy("block").orderBy("shard", "segment").rowsBetween(*earlier))
    return (held.withColumn("inside", F.coalesce(inside, F.lit(0))).join(blocks, "block")
            .select("shard", "segment", (F.col("start") + F.col("inside")).alias("base")))


def read_tokens(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 (and ids) of each document in the files."""
    rows = stored(read_segments(spark, path, keep_ids), "documents", 1)  # a file is one row
    base = summed_before(rows.groupBy("shard", "segment").agg(F.sum("n_tokens").alias("n")))
    return rows.join(base, ["shard", "segment"]).select(
        "doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * keep_ids)


def op13_token_store(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, default_tokenizer())
    return read_tokens(spark, path)
