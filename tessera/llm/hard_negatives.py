"""Hard negatives by bounds along a spanning tree of the anchors.

Every anchor (a query row) gets its best rows of the same label, its positives, and for each positive the best rows of
other labels whose score lies in a window below the positive's. Scores are integer inner products of quantised vectors.

Rows are dealt to spans, anchors to groups, both of bounded size. A group's anchors are joined by a minimum spanning
tree of their distances, once. A span meets a group in one task, which walks the tree from its root: of the root all
scores are known, and if a row x scores between lo and hi with an anchor p, then with a child c of p between
lo - |c - p| |x| and hi + |c - p| |x|. Only rows whose interval overlaps what is asked for are scored again with the
child; their interval shrinks to a point, the others' grows by the edge. Nothing is lost, whatever the data; the tree
decides only how many rows are scored again.

Two passes of the tree: the first asks for each anchor's best rows of its label (a row stays if its upper bound reaches
the k-th best lower bound of the span), the second for the windows of its positives. A span gives at most k rows per
anchor and positive, so what the final ranking sees is bounded by anchors and spans, not by pairs.

Anchors are replicated once per span and spans once per group of anchors, as blocks; no pair of rows is ever a row.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part. Of rows
with equal ids the one of the smallest label, then vector, counts. A shorter vector counts as filled up with zeros. A
score beyond 63 bits raises an error. An anchor without positives, and a positive without negatives, give no rows. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.shared import stored, table

SPAN_ROWS, GROUP_ANCHORS = 8192, 2048
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100          # the window of a positive, in percent of its score
SCALE = 256
_BLOCK = "block int, n int, ids binary, labels binary, vectors binary"
_TREE = _BLOCK + ", parents binary, edges binary"
_FOUND = "anchor_id long, id long, score long"
_MINED = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
_LABEL = pa.int64()


def names_of(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def usable(rows: DataFrame, vec_id: str, label: Column, vector: str) -> DataFrame:
    """vec_id, label, vector of the rows that take part, one per id; stored."""
    held = rows.select(rows[vec_id].cast("long").alias("vec_id"), label.cast("long").alias("label"),
                       rows[vector].cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    held = held.where("vec_id is not null and label is not null and vector is not null").where(~bad)
    best = held.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("b"))
    return stored(best.select("vec_id", "b.label", "b.vector"), "vectors")


def quantised(vectors: pa.Array, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of the components, a row per vector, shorter ones filled up with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    n = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(n), int(n.max(initial=0))))
    out[np.repeat(np.arange(len(n)), n), np.concatenate([np.arange(k) for k in n] or [[]]).astype(int)] = flat
    return out


def _blobs(out: np.ndarray) -> bytes:
    """Whole numbers as 32 bits where they fit, else as doubles (which the quantised components are)."""
    small = not out.size or np.abs(out).max() < 1 << 31
    return (b"i" + out.astype("<i4").tobytes()) if small else (b"d" + out.astype("<f8").tobytes())


class Block:
    """Ids, labels and quantised vectors, ordered by label and id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.norms = np.sqrt((vectors * vectors).sum(1)) * (1 + 1e-12)

    @classmethod
    def of(cls, group: pa.Table, scale: int) -> Block:
        ids, labels = (group.column(c).to_numpy() for c in ("vec_id", "label"))
        order = np.lexsort((ids, labels))
        return cls(ids[order], labels[order], quantised(group.column("vector"), scale)[order])

    @classmethod
    def read(cls, row: dict) -> Block:
        kind = "<i4" if row["vectors"][:1] == b"i" else "<f8"
        flat = np.frombuffer(row["vectors"][1:], kind).astype(np.float64)
        return cls(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), flat.reshape(row["n"], -1))

    def __len__(self) -> int:
        return len(self.ids)

    def blobs(self) -> list[bytes]:
        return [self.ids.astype("<i8").tobytes(), self.labels.astype("<i8").tobytes(), _blobs(self.vectors)]


def exact(vectors: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered vectors, exact: in doubles where no sum can leave 2^53."""
    n = min(vectors.shape[1], len(other))
    vectors, other = vectors[:, :n], other[:n]
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(other).sum())
    if most < 1 << 53:
        return (vectors @ other).astype(np.int64)
    big = [int(x) for x in other]
    return np.array([sum(int(x) * y for x, y in zip(row, big)) for row in vectors], np.int64)


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree: (order, parents, edge lengths). Row ``order[i]`` hangs on ``parents[i]``, -1 for the root.

    The order is depth-first, the largest subtree last, so that few rows' intervals are open at a time.
    """
    n = len(vectors)
    square = (vectors * vectors).sum(1)
    near, link, left = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    children: list[list[int]] = [[] for _ in range(n)]
    parent, edge, joined = np.full(n, -1), np.zeros(n), []
    at = 0
    for _ in range(n):
        left[at] = False
        joined.append(at)
        away = np.maximum(square + square[at] - 2 * (vectors @ vectors[at]), 0)
        closer = left & (away < near)
        near[closer], link[closer] = away[closer], at
        if len(joined) == n:
            break
        at = int(np.where(left, near, np.inf).argmin())
        parent[at] = link[at]
        edge[at] = np.sqrt(((vectors[at] - vectors[link[at]]) ** 2).sum()) * (1 + 1e-12)
        children[link[at]].append(at)
    weight = np.ones(n, int)
    for x in reversed(joined):
        if parent[x] >= 0:
            weight[parent[x]] += weight[x]
    order, stack = [], [0] if n else []
    while stack:
        x = stack.pop()
        order.append(x)
        stack += sorted(children[x], key=lambda c: -weight[c])
    order = np.array(order, np.int64)
    return order, parent[order] if n else order, edge[order] if n else np.zeros(0)


class Walk:
    """Intervals of the scores of a span's rows with each anchor of a tree, in the tree's order."""

    def __init__(self, rows: Block, anchors: Block, parents: np.ndarray, edges: np.ndarray):
        self.rows, self.anchors, self.parents, self.edges = rows, anchors, parents, edges
        self.waiting = np.bincount(parents[parents >= 0], minlength=len(anchors))
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        # More than the rounding of doubles can do to a bound.
        self.slack = 1e-3 + 1e-9 * float(rows.norms.max(initial=0)) * float(anchors.norms.max(initial=0))
        self.scored = 0

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, lo, hi): ``settle`` may be called before the next one."""
        for i in range(len(self.anchors)):
            p = int(self.parents[i])
            if p < 0:
                lo = exact(self.rows.vectors, self.anchors.vectors[i]).astype(np.float64)
                lo, hi = lo.copy(), lo
                self.scored += len(lo)
            else:
                lo, hi = self.open[p]
                wide = self.edges[i] * self.rows.norms + self.slack
                lo, hi = lo - wide, hi + wide
                self.waiting[p] -= 1
                if not self.waiting[p]:
                    del self.open[p]
            if self.waiting[i]:
                self.open[i] = lo, hi
            yield i, lo, hi

    def settle(self, i: int, which: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Scores of the rows ``which`` with anchor ``i``; their intervals become points."""
        score = exact(self.rows.vectors[which], self.anchors.vectors[i])
        lo[which] = hi[which] = score
        self.scored += len(which)
        return score


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by the smaller id."""
    if len(score) > k:
        bar = np.partition(score, -k)[-k]
        some = np.flatnonzero(score >= bar)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))][:k]


def _same_label(walk: Walk, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, scores): the best ``k`` rows of the anchor's label in the span."""
    rows, anchors = walk.rows, walk.anchors
    for i, lo, hi in walk:
        a, z = np.searchsorted(rows.labels, anchors.labels[i], "left"), np.searchsorted(rows.labels, anchors.labels[i], "right")
        able = np.arange(a, z)
        able = able[rows.ids[able] != anchors.ids[i]]
        if len(able) > k:
            able = able[hi[able] >= np.partition(lo[able], -k)[-k]]
        if len(able):
            score = walk.settle(i, able, lo, hi)
            top = best(score, rows.ids[able], k)
            yield i, able[top], score[top]


def _in_windows(walk: Walk, wanted: dict[int, list[tuple[int, int]]], k: int
                ) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(anchor, positive id and score, rows, scores): the best ``k`` rows of another label in each positive's window."""
    rows, anchors = walk.rows, walk.anchors
    for i, lo, hi in walk:
        # The window of each positive, in whole scores; that of a negative score is empty.
        windows = [(name, s, -(-LOW * s // 100), HIGH * s // 100) for name, s in wanted.get(int(anchors.ids[i]), [])]
        windows = [w for w in windows if w[2] <= w[3]]
        if not windows:
            continue
        floor, most = min(w[2] for w in windows), max(w[3] for w in windows)
        able = np.flatnonzero((hi >= floor - walk.slack) & (lo <= most + walk.slack) & (rows.labels != anchors.labels[i]))
        if not len(able):
            continue
        score = walk.settle(i, able, lo, hi)
        for name, s, low, high in windows:
            inside = np.flatnonzero((score >= low) & (score <= high))
            if len(inside):
                top = inside[best(score[inside], rows.ids[able][inside], k)]
                yield i, name, s, able[top], score[top]


def spans_of(rows: DataFrame, count: int, scale: int) -> DataFrame:
    """A row per span; stored."""

    def pack(group: pa.Table) -> pa.Table:
        block = Block.of(group, scale)
        return _table(_BLOCK, [[group.column("block")[0].as_py()], [len(block)], *[[b] for b in block.blobs()]])

    held = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(7), F.col("vec_id")), F.lit(count)).cast("int"))
    return stored(held.groupBy("block").applyInArrow(pack, _BLOCK), "spans", 16)


def trees_of(anchors: DataFrame, count: int, scale: int) -> DataFrame:
    """A row per group of anchors, in the order of its tree; ``parents`` are places in it, the root's -1; stored."""

    def pack(group: pa.Table) -> pa.Table:
        block = Block.of(group, scale)
        order, parents, edges = spanning_tree(block.vectors)
        held = Block(block.ids[order], block.labels[order], block.vectors[order])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        parents = np.where(parents < 0, -1, place[parents])
        return _table(_TREE, [[group.column("block")[0].as_py()], [len(block)], *[[b] for b in held.blobs()],
                              [parents.astype("<i8").tobytes()], [edges.astype("<f8").tobytes()]])

    held = anchors.withColumn("block", F.pmod(F.xxhash64(F.lit(11), F.col("vec_id")), F.lit(count)).cast("int"))
    return stored(held.groupBy("block").applyInArrow(pack, _TREE), "trees", 16)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _table(schema: str, columns: list) -> pa.Table:
    kinds = [_KINDS[c.split(" ")[1]] for c in schema.split(", ")]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names_of(schema), columns, kinds)})


def _columns(parts: list[list[np.ndarray]], schema: str) -> pa.Table:
    """Parts of rows as one table."""
    whole = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64) for _ in names_of(schema)]
    return _table(schema, whole)


def _walked(spans: pa.Table, trees: pa.Table) -> Iterator[Walk]:
    for span in spans.to_pylist():
        rows = Block.read(span)
        for tree in trees.to_pylist():
            yield Walk(rows, Block.read(tree), np.frombuffer(tree["parents"], "<i8"), np.frombuffer(tree["edges"], "<f8"))


def _met(spans: DataFrame, trees: DataFrame, n_spans: int, n_trees: int) -> tuple:
    """Both sides by (span, tree): spans repeated per tree, trees per span, dealt to one task a meeting."""
    left = spans.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
    right = trees.withColumn("span", F.explode(F.sequence(F.lit(0), F.lit(n_spans - 1))))
    tasks = n_spans * n_trees
    return (left.withColumnRenamed("block", "span").repartition(tasks, "span", "tree").groupBy("span", "tree"),
            right.withColumnRenamed("block", "tree").repartition(tasks, "span", "tree").groupBy("span", "tree"))


def _ranked(rows: DataFrame, by: list[str], score: str, name: str, k: int) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank``; a group holds at most ``k`` rows per span."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(name))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(rows: DataFrame, anchor: Column, vec_id: str = "vec_id", label: Column | None = None, vector: str = "embedding",
          positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE, span_rows: int = SPAN_ROWS,
          group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor``: a condition on ``vec_id``, named so; rows that meet it and take part are anchors.
    """
    held = usable(rows, vec_id, F.col("label") if label is None else label, vector)
    size = held.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.when(anchor, 1)).alias("anchors")).first()
    n_spans = max(1, -(-size["rows"] // span_rows))
    n_trees = max(1, -(-(size["anchors"] or 0) // group_anchors))
    spans = spans_of(held, n_spans, scale)
    trees = trees_of(held.where(anchor), n_trees, scale)

    def first(spans: pa.Table, trees: pa.Table) -> pa.Table:
        parts = []
        for walk in _walked(spans, trees):
            for i, found, score in _same_label(walk, positives):
                parts.append([np.full(len(found), walk.anchors.ids[i]), walk.rows.ids[found], score])
        return _columns(parts, _FOUND)

    left, right = _met(spans, trees, n_spans, n_trees)
    found = left.cogroup(right).applyInArrow(first, _FOUND)
    best_ = stored(_ranked(found, ["anchor_id"], "score", "id", positives).drop("rank"), "positives")

    # The positives of a group of anchors travel with its tree: at most ``positives`` a member.
    of = F.pmod(F.xxhash64(F.lit(11), F.col("anchor_id")), F.lit(n_trees)).cast("int")
    asked = best_.groupBy(of.alias("block")).agg(F.collect_list(F.struct("anchor_id", "id", "score")).alias("asked"))
    trees = trees.join(asked, "block")

    def second(spans: pa.Table, trees: pa.Table) -> pa.Table:
        parts = []
        wanted = [x for t in trees.column("asked").to_pylist() for x in t]
        by_anchor: dict[int, list[tuple[int, int]]] = {}
        for x in wanted:
            by_anchor.setdefault(x["anchor_id"], []).append((x["id"], x["score"]))
        for walk in _walked(spans, trees):
            for i, name, s, rows_, score in _in_windows(walk, by_anchor, negatives):
                parts.append([np.full(len(rows_), x) for x in (walk.anchors.ids[i], name)]
                             + [walk.rows.ids[rows_], np.full(len(rows_), s), score])
        return _columns(parts, _MINED)

    left, right = _met(spans, trees, n_spans, n_trees)
    found = left.cogroup(right).applyInArrow(second, _MINED)
    return _ranked(found, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
        "negative_score")


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
