"""Hierarchical packing of documents into context windows of several lengths.

Documents are tokenised and cut into full windows of the longest tier and a tail. A tail goes
to the smallest tier that holds it. The tiers are then packed from the longest down: a tail
opens a window, the gap takes the longest tails that fit from this and the shorter tiers, and
what is left of the gap takes the head of a shorter tail (whose rest goes back to its tier).
The last rest of a block is cut into powers of two, which need no padding. Windows are dealt
to step groups of near-equal token totals, longest first.

A block (a bounded number of tokens of one input partition) is packed in one Python task, so
nothing is shuffled and memory does not grow with the corpus. ``sequence_id`` holds the
partition and a counter; a task that runs again gives the same rows.

Token ids: those of the ``tokenizers`` library for a byte-level BPE file. Where the file's
merge ranks follow its ids, ``tiktoken`` runs the merges (same ids, several times faster);
otherwise, and for texts with very long runs of white space, ``tokenizers`` itself. Strings of special tokens in a text are ordinary text.

Defined results: a null or empty text is a document of the end id alone. Repeated rows are
packed each by itself. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.shared import small_batches, table

TIERS = (1024, 512, 256, 128)
END_ID = 0
BLOCK_TOKENS = 1 << 21
STEP_TOKENS = 64 * 1024
LONG_BLANK = 100_000  # a text with a run of white space of this length is left to ``tokenizers``
_LONG_BLANK = re.compile(rf"\s{{{LONG_BLANK}}}")

#: Split pattern of the byte-level BPE pre-tokeniser (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes for U+0100 upwards.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    out = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in plain):
        out[chr(256 + i)] = b
    return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids (uint32) for a tokenizer file; one per Python worker."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    symbol = _byte_of_symbol()
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {}
    if model.get("type", "BPE") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space"):
        pieces = {t: i for t, i in model["vocab"].items() if t not in special}
        if all(c in symbol for t in pieces for c in t):
            ranks = {bytes(symbol[c] for c in t): i for t, i in pieces.items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    in_order = [model["vocab"].get(a + b) for a, b in merges]
    fast = (len(ranks) == 256 + len(merges) and None not in in_order and in_order == sorted(in_order)
            and spec.get("normalizer") is None and not model.get("ignore_merges")
            and pre.get("use_regex", True))

    @lru_cache(maxsize=1)
    def plain():
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        return lambda text: np.asarray(tok.encode(text, add_special_tokens=False).ids, np.uint32)

    if not fast:
        return plain()
    import tiktoken
    core = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        # tiktoken's split pattern recurses along a run of white space and overflows its stack on very long ones.
        if len(text) >= LONG_BLANK and _LONG_BLANK.search(text):
            return plain()(text)
        return np.asarray(core.encode_ordinary(text), np.uint32)

    return encode


def plan(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> tuple[list[list[tuple[int, int, int]]], list[int]]:
    """Windows for documents of the given lengths: [(document, start, length), ...], and their tiers.

    Every position of every document lies in exactly one piece, and every window is full: as
    long as its tier or, for the last rest, a smaller power of two.
    """
    longest = tiers[0]
    windows, kinds = [], []
    loose: list[tuple[int, int, int]] = []  # (left, document, start) of tails, sorted
    for d, n in enumerate(lengths):
        full = n // longest
        windows += [[(d, i * longest, longest)] for i in range(full)]
        kinds += [longest] * full
        if n % longest:
            loose.append((n % longest, d, full * longest))
    loose.sort()
    rest = sum(x[0] for x in loose)
    for k, tier in enumerate(tiers):
        shortest = tiers[k + 1] if k + 1 < len(tiers) else 0
        while rest >= tier and loose[-1][0] > shortest:
            left, d, start = loose.pop()
            window, gap = [(d, start, left)], tier - left
            rest -= tier
            while gap:
                at = bisect_right(loose, (gap, 1 << 62, 0)) - 1
                if at >= 0:  # the longest tail that fits
                    n, d, start = loose.pop(at)
                    window.append((d, start, n))
                    gap -= n
                else:  # the head of the shortest one; its rest goes back
                    n, d, start = loose.pop(0)
                    window.append((d, start, gap))
                    insort(loose, (n - gap, d, start + gap))
                    gap = 0
            windows.append(window)
            kinds.append(tier)
        if loose and loose[-1][0] > shortest:
            break
    # Less than a window: powers of two, filled one after another.
    pieces = iter(sorted(loose, reverse=True))
    left, d, start = next(pieces, (0, 0, 0))
    for bit in reversed(range(rest.bit_length())):
        size = 1 << bit
        if not rest & size:
            continue
        window, gap = [], size
        while gap:
            if not left:
                left, d, start = next(pieces)
            n = min(left, gap)
            window.append((d, start, n))
            left, start, gap = left - n, start + n, gap - n
        windows.append(window)
        kinds.append(size)
    return windows, kinds


def step_groups(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for each window: the longest windows first, each to the group with fewest tokens."""
    groups = max(1, -(-sum(sizes) // step_tokens))
    heap = [(0, g) for g in range(groups)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (load + sizes[i], g))
    return out


SCHEMA_TAIL = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()),
               ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType()),
               ("tier", T.IntegerType()), ("step_group", T.LongType())]


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
         tiers: tuple[int, ...] = TIERS, block_tokens: int = BLOCK_TOKENS, keep_ids: bool = False) -> DataFrame:
    """One row per piece; see the module's description.

    Columns: the document id, ``start`` and ``length`` of the piece in the document's ids,
    ``ids_crc32`` of the piece's ids as little-endian 32-bit numbers, ``doc_tokens``,
    ``sequence_id``, ``offset`` in the sequence, ``tier`` (the sequence's length) and
    ``step_group``; with ``keep_ids`` also ``ids``, the little-endian bytes themselves.
    """
    small_batches(docs.sparkSession)
    tail = SCHEMA_TAIL + ([("ids", T.BinaryType())] if keep_ids else [])
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType)]
                          + [T.StructField(n, t) for n, t in tail])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        base = TaskContext.get().partitionId() << 33
        used = {"sequence": 0, "group": 0}
        held, id_parts, total = [], [], 0

        def flush() -> pa.RecordBatch:
            windows, kinds = plan([len(x) for x in held], tiers)
            groups = step_groups(kinds)
            rows = []
            for w, (window, kind, group) in enumerate(zip(windows, kinds, groups)):
                at = 0
                for d, start, n in window:
                    rows.append((d, start, n, len(held[d]), base + used["sequence"] + w, at, kind,
                                 base + used["group"] + group))
                    at += n
            used["sequence"] += len(windows)
            used["group"] += max(groups, default=-1) + 1
            cols = np.array(rows, np.int64).reshape(-1, 8).T
            parts = [held[d][s: s + n].astype("<u4").tobytes() for d, s, n in cols[:3].T.tolist()]
            ids = pa.concat_arrays(id_parts).take(pa.array(cols[0]))
            arrays = [ids, cols[1], cols[2], [zlib.crc32(p) for p in parts], cols[3], cols[4], cols[5],
                      cols[6].astype(np.int32), cols[7]] + ([parts] if keep_ids else [])
            return pa.RecordBatch.from_arrays(
                [a if isinstance(a, pa.Array) else pa.array(a, pa.binary()) if keep_ids and a is parts
                 else pa.array(a) for a in arrays], names=[f.name for f in schema.fields])

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            first = 0
            for i in range(batch.num_rows):
                value = texts[i].as_py()
                tokens = encode(value) if value else np.zeros(0, np.uint32)
                held.append(np.append(tokens, np.uint32(END_ID)))
                total += len(tokens) + 1
                if total >= block_tokens:
                    id_parts.append(ids.slice(first, i + 1 - first))
                    yield flush()
                    held, id_parts, total, first = [], [], 0, i + 1
            if first < batch.num_rows:
                id_parts.append(ids.slice(first))
        if held:
            yield flush()

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
