"""Shingle sets of texts or lines, and what the exact set joins share.

A set is the distinct five-word shingles (64-bit hashes) of a text or line; sets of fewer words
are their whole sequence. Two sets are similar when 5 * intersection >= 4 * union (0.8). A set's
id is a 64-bit digest of its shingles, so equal sets are one from the start, and a task that runs
again, whatever its input split, finds the same ids.

Shingles travel as postings: numpy blobs dealt to buckets by shingle, a few rows per batch
instead of a row per shingle. The number of buckets follows the number of shingles, so a bucket
stays small. Shingles that many sets of a batch hold (``frequent``) are known beforehand as a
list of bounded length; they never meet in one bucket. Where only a bound is asked for, half of
each hash travels (``Dealer(short=True)``): a bucket tells its few shingles apart by less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import drop_stored, stored
from tessera.llm.words import Slice, mixed, overlap, shingle_runs, slices

BUCKET_POSTINGS = 1 << 18
FLUSH_POSTINGS = 1 << 18  # postings that a task gathers before it deals them
TEXT_ROWS, BLOB_ROWS = 1000, 256  # rows of an Arrow batch of texts, of sets or postings
_U = np.uint64


def missing(n):
    """How many shingles of a set of ``n`` a similar set may lack: floor(n / 5)."""
    return n // 5


def compatible(n: str, m: str) -> str:
    """SQL: sets of these sizes can be similar."""
    return f"5 * least({n}, {m}) >= 4 * greatest({n}, {m})"


def ordered(hashes: np.ndarray, owner: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``hashes`` of owners 0, 1, ... (n[i] of owner i, one after another), sorted within each owner."""
    if len(n) and len(hashes) > 32 * len(n):
        hashes, at = hashes.copy(), 0
        for size in n:
            hashes[at: at + size].sort()
            at += size
        return hashes
    if len(n) < 1 << 20:  # the owner and the leading bits of the hash in one sort key, quicker than two keys
        out = hashes[np.argsort((owner.astype(_U) << _U(44)) | (hashes >> _U(20)))]
        if not ((out[1:] < out[:-1]) & (owner[1:] == owner[:-1])).any():
            return out
    return hashes[np.lexsort((hashes, owner))]


class Sets:
    """Sets of a slice: sorted distinct shingles of set i at [bounds[i], bounds[i + 1])."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray):
        n = np.diff(bounds)
        owner = np.repeat(np.arange(len(n)), n)
        hashes = ordered(hashes, owner, n)
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = hashes[fresh], owner[fresh]
        self.sizes = np.bincount(self.owner, minlength=len(n)).astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.tokens[self.bounds[i]: self.bounds[i + 1]]

    def folded(self, values: np.ndarray, how: np.ufunc, empty: int = 0) -> np.ndarray:
        """``how`` over each set's values."""
        out = np.full(len(self), empty, values.dtype)
        some = np.flatnonzero(self.sizes)
        if len(some):
            out[some] = how.reduceat(values, self.bounds[some])
        return out

    def ids(self) -> np.ndarray:
        """Digest of each set; of an empty one, 0."""
        total = self.folded(mixed(self.tokens), np.add)
        return np.where(self.sizes > 0, mixed(total + self.sizes.astype(_U) * _U(0x9E3779B97F4A7C15)),
                        _U(0)).astype(_U)

    def rank(self) -> np.ndarray:
        """Place of each shingle in its set."""
        return np.arange(len(self.tokens)) - self.bounds[:-1][self.owner]


def text_sets(s: Slice) -> Sets:
    return Sets(*shingle_runs(s.word_from, s.word_hashes()))


def line_bounds(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of the slice's texts that hold a word: (text, line number in the text, word bounds).

    Word bounds are one longer; all words lie in lines, so they are gapless.
    """
    breaks = np.flatnonzero(s.raw == 10)
    # A word's line: line breaks before it in its own text.
    text = s.text_of_word()
    before = np.cumsum(np.bincount(np.searchsorted(s.starts, breaks), minlength=len(s.starts))[:len(s.starts)])
    line = before - np.searchsorted(breaks, s.offsets[:-1])[text]
    first = np.ones(len(line), bool)
    first[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
    at = np.flatnonzero(first)
    return text[at], line[at], np.append(at, len(line)).astype(np.int64)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(_U).view(np.int64))


class Frequency:
    """Counts shingles over a batch; says which of them many of its sets hold."""

    def __init__(self, share: float = 0.02, least: int = 16):
        self.share, self.least, self.parts, self.sets = share, least, [], 0

    def add(self, tokens: np.ndarray, sets: int) -> None:
        self.parts.append(tokens)
        self.sets += sets

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        tokens, counts = np.unique(np.concatenate(self.parts), return_counts=True)
        often = counts >= max(self.least, self.share * self.sets)
        return tokens[often], counts[often]


def frequent(counted: DataFrame, total: int, share: float = 0.005) -> np.ndarray:
    """Shingles (sorted) that at least ``share`` of all sets hold, from batch counts (token, n).

    At most mean set size / share of them exist, so the list is bounded whatever the corpus.
    Those that no batch reports are in less than the batches' own share of the sets.
    """
    rows = (counted.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= share * total)
            .select("token").collect())
    return np.sort(np.array([r["token"] for r in rows], np.int64).view(_U))


def is_in(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which tokens occur in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(tokens), bool)
    at = np.searchsorted(known, tokens)
    at[at == len(known)] = 0
    return known[at] == tokens


def buckets_for(postings: int) -> int:
    return max(1, -(-int(postings) // BUCKET_POSTINGS))


def alike(tokens: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Mask of the tokens that equal another of their owner's, but one, in the half that travels of short postings."""
    short = (owner.astype(_U) << _U(32)) | (tokens & _U(0xFFFFFFFF))
    again = np.zeros(len(short), bool)
    held = np.sort(short)
    if (held[1:] == held[:-1]).any():
        again[:] = True
        again[np.unique(short, return_index=True)[1]] = False
    return again


def dealt(tokens: np.ndarray, owners: np.ndarray, extra: np.ndarray, buckets: int, short: bool = False) -> Iterator[tuple]:
    """(bucket, tokens, owners, extra) blobs of one batch; ``extra`` is a small unsigned number per posting."""
    bucket = ((mixed(tokens) >> _U(32)) * _U(buckets)) >> _U(32)
    # Two bytes are sorted by radix.
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    tokens, owners, extra, bucket = tokens[order], owners[order], extra[order], bucket[order]
    if short:
        tokens = tokens.astype("<u4")
    edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=_U))
    for b in np.flatnonzero(np.diff(edges)):
        a, z = edges[b], edges[b + 1]
        yield int(b), tokens[a:z].tobytes(), owners[a:z].tobytes(), extra[a:z].tobytes()


class Dealer:
    """Gathers postings of a task and deals them in batches of bounded size.

    ``short``: buckets get the lower 32 bits of each token. Others may then look shared, about one in 16,000; of an
    owner's own tokens none may be alike (``alike``).
    """

    def __init__(self, buckets: int, short: bool = False):
        self.buckets, self.short, self.parts, self.held = buckets, short, [], 0

    def add(self, tokens: np.ndarray, owners: np.ndarray, extra: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(tokens):
            self.parts.append((tokens, owners, extra))
            self.held += len(tokens)
        if self.held >= FLUSH_POSTINGS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            columns = [np.concatenate(x) for x in zip(*self.parts)]
            self.parts, self.held = [], 0
            yield posting_batch(list(dealt(*columns, self.buckets, self.short)))


POSTINGS = "bucket int, tokens binary, owners binary, extra binary"


def posting_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.split(" ")[0] for c in POSTINGS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def gathered(table: pa.Table, extras: str = "<u2", kind: str = "<u8") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens (of this ``kind``), owners and extras (numbers of this kind) of a bucket, ordered by token and owner."""
    def whole(name: str, kind: str) -> np.ndarray:
        return np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)])

    tokens, owners, extra = whole("tokens", kind), whole("owners", "<u8"), whole("extra", extras)
    order = np.argsort(tokens)
    held = tokens[order]
    again = held[1:] == held[:-1]
    more = np.zeros(len(held), bool)
    more[1:] = again
    more[:-1] |= again
    part = order[more]  # most tokens occur once: only the others are ordered further
    order[more] = part[np.lexsort((extra[part], owners[part], tokens[part]))]
    return tokens[order], owners[order], extra[order]


def shared_by_sets(tokens: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks over ordered postings: a token's first posting of its owner; the token has two owners or more."""
    if not len(tokens):
        return np.zeros(0, bool), np.zeros(0, bool)
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    fresh = new.copy()
    fresh[1:] |= owners[1:] != owners[:-1]
    run = np.cumsum(new) - 1
    return fresh, (np.bincount(run, fresh) >= 2)[run]


#: Counts by set on their way to their sum: blobs, as postings are.
COUNTS = "part int, ids binary, counts binary, often boolean"
PART_COUNTS = 1 << 22  # counts that are summed together, at most about


def parts_for(postings: int) -> int:
    """Into how many parts sets are dealt for summing: a bucket counts a set once, so postings bound the counts."""
    return max(1, -(-int(postings) // PART_COUNTS))


def counts_dealt(ids: np.ndarray, counts: np.ndarray, parts: int, often: bool = False) -> pa.Table:
    """A row per part that any id falls into. ``often``: counts of frequent shingles, which every copy of a set reports."""
    part = (((mixed(ids.astype(_U)) >> _U(32)) * _U(parts)) >> _U(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    ids, counts, part = ids[order], counts[order], part[order]
    edges = np.searchsorted(part, np.arange(parts + 1))
    some = np.flatnonzero(np.diff(edges))
    return pa.table({"part": pa.array(some.astype(np.int32)),
                     "ids": pa.array([ids[edges[i]: edges[i + 1]].astype("<u8").tobytes() for i in some], pa.binary()),
                     "counts": pa.array([counts[edges[i]: edges[i + 1]].astype("<i8").tobytes() for i in some],
                                        pa.binary()),
                     "often": pa.array(np.full(len(some), often))})


def summed_counts(counts: DataFrame, name: str) -> DataFrame:
    """(id, ``name``): the sum of each set's counts, those of frequent shingles once. ``counts``: as ``COUNTS``."""

    def run(group: pa.Table) -> pa.Table:
        ids, n = (np.concatenate([np.frombuffer(x.as_py(), kind) for x in group.column(c)])
                  for c, kind in (("ids", "<u8"), ("counts", "<i8")))
        often = np.repeat(group.column("often").to_numpy(), [len(x.as_py()) // 8 for x in group.column("ids")])
        known, place = np.unique(ids, return_inverse=True)
        out, once = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        np.add.at(out, place[~often], n[~often])
        np.maximum.at(once, place[often], n[often])
        return pa.table({"id": signed(known), name: pa.array(out + once)})

    return counts.groupBy("part").applyInArrow(run, f"id long, {name} long")


def packed_texts(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the text column as zstd bytes: what a shuffle of whole documents should move."""
    place = docs.columns.index(text)
    schema = docs.withColumn(text, F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            columns = list(b.columns)
            columns[place] = pa.array([None if x.as_py() is None else press.compress(x.as_py().encode())
                                       for x in columns[place]], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return docs.mapInArrow(run, schema)


def unpacked(column: pa.Array) -> list[str | None]:
    unpress = zstandard.ZstdDecompressor()
    return [None if x.as_py() is None else unpress.decompress(x.as_py()).decode() for x in column]


def unpacked_slices(column: pa.Array, rows: int = 512) -> Iterator[tuple[int, Slice]]:
    """Slices of packed texts, each with the row at which its part begins."""
    for at in range(0, len(column), rows):
        for s in slices(pa.array(unpacked(column.slice(at, rows)), pa.large_string())):
            yield at, s


def with_common(sets: DataFrame, hot: np.ndarray, name: str) -> DataFrame:
    """Stored sets (id, n, tokens) with ``common``: how many of a set's shingles any other set holds.

    ``sets`` is dropped. Only sets for which that is four fifths of their size or more; the others are like none.
    A set that ``sets`` holds twice comes once.
    """
    postings = sets.agg(F.sum("n")).first()[0] or 0
    parts = parts_for(postings)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer(buckets_for(postings))
        for batch in batches:
            for i, blob in zip(batch.column(0), batch.column(1)):
                tokens = np.frombuffer(blob.as_py(), "<u8")
                own = _U(i.as_py() & 0xFFFFFFFFFFFFFFFF)
                often = is_in(tokens, hot)
                if often.any():  # held by others for certain: a count, in a bucket by set
                    yield posting_batch([(-1 - int(own % _U(1 << 30)), np.array([often.sum()], "<u8").tobytes(),
                                          np.array([own], "<u8").tobytes(), np.zeros(1, "<u2").tobytes())])
                rest = tokens[~often]
                yield from dealer.add(rest, np.full(len(rest), own), np.zeros(len(rest), np.uint16))
        yield from dealer.rest()

    def meet(group: pa.Table) -> pa.Table:
        tokens, owners, _ = gathered(group)
        if group.column("bucket")[0].as_py() < 0:
            return counts_dealt(owners, tokens, parts, often=True)
        fresh, shared = shared_by_sets(tokens, owners)
        return counts_dealt(*np.unique(owners[fresh & shared], return_counts=True), parts)

    found = summed_counts(sets.select("id", "tokens").mapInArrow(emit, POSTINGS).groupBy("bucket")
                          .applyInArrow(meet, COUNTS), "common")
    kept = sets.join(found.where("common > 0"), "id").where("5 * common >= 4 * n")
    out = stored(kept.dropDuplicates(["id"]), name, TEXT_ROWS)
    drop_stored(sets)
    return out


def can_overlap(c: str, n: str, d: str, m: str) -> str:
    """SQL: sets of sizes n and m, c and d of whose shingles other sets hold, can be similar."""
    return f"9 * least({c}, {d}) >= 4 * ({n} + {m})"


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets are similar. ``sets``: id, tokens (sorted, little-endian 64-bit).

    A set that very many pairs name is read for each of them, but the join splits those pairs.
    """
    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                u, v = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                if 5 * min(len(u), len(v)) < 4 * max(len(u), len(v)):
                    keep.append(False)
                    continue
                common = overlap(u, v)
                keep.append(5 * common >= 4 * (len(u) + len(v) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)],
                                             names=["a", "b"])

    joined = pairs.select("a", "b").distinct().join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return stored(joined.mapInArrow(run, "a long, b long"), "links", BLOB_ROWS)
