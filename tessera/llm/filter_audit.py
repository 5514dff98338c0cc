"""Filter interaction audit: what each filter of a chain removes, in every order, and its Shapley value.

A document's failures are a mask of five bits. Per part (a value of a grouping column) the documents are tabulated by
mask; from these 32 counts follows what each of the 32 coalitions of filters removes. All else is arithmetic on the
coalitions: a filter f behind the filters P removes v(P + f) - v(P), and so on for lost good and toxic documents.

Shapley values come from the coalitions by exact constrained least squares. Of all additive models
u(S) = sum of phi_f over S, the one with phi_1 + ... + phi_m = v(all) that fits v best under the Shapley kernel
(m - 1) / (C(m, s) s (m - s)) has the Shapley values as coefficients. Its normal equations, with a multiplier for the
constraint, are solved in rationals, so the result has no rounding.

Only ids, hashes and masks are shuffled, never texts; a part's copies, however many, are counted map-side. The solver
sees one row per part.

Defined results: a null text is empty. A null part is the part ''. A document is a duplicate if a smaller document id
has the same text; a null id is neither smaller nor larger than another, so rows of null id are no duplicates. Rows of
equal id and text are all first or all duplicates. A document with several label rows is good (toxic) if one of them
says so; a label that is null or of an unknown id says nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import stored, table

FILTERS = "ABCDE"
_SPACES = r"[\x20\x09-\x0D]+"
_AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column) -> list[Column]:
    """The conditions A to D of a text."""
    words = F.filter(F.split(text, _SPACES), lambda w: w != "")
    n = F.size(words)
    return [n < 50,
            100 * F.size(F.array_distinct(words)) < 65 * n,
            100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
            text.rlike(r"[#$%&*|]")]


def bits(conditions: Sequence[Column]) -> Column:
    """Condition i as bit i of a number."""
    out = F.lit(0)
    for i, c in enumerate(conditions):
        out = out + F.when(c, F.lit(1 << i)).otherwise(F.lit(0))
    return out


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """doc_id, part, mask (bit i: filter i of ``FILTERS`` would remove the document) of each row."""
    body = F.coalesce(docs[text], F.lit(""))
    held = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
                       F.sha2(F.encode(body, "UTF-8"), 256).alias("digest"), body.alias("body"))
    own = stored(held.select("doc_id", "part", "digest", bits(text_failures(F.col("body"))).alias("own")), "failures")
    # Copies of a text meet as partial minima; only texts with copies come back to the rows.
    first = (own.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("digest", "first"))
    first = stored(first, "first")  # then both sides of the join are plain shuffles, which AQE can split
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return own.join(first, "digest", "left").select(
        "doc_id", "part", (F.col("own") + F.when(again, F.lit(16)).otherwise(F.lit(0))).alias("mask"))


def tabulated(failed: DataFrame, labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality",
              toxic: str = "toxic", filters: int = len(FILTERS)) -> DataFrame:
    """One row per part: arrays ``n``, ``good``, ``toxic`` of document counts by mask."""
    said = (labels.select(labels[doc_id].alias("l_id"), labels[quality].alias("q"), labels[toxic].alias("t"))
            .groupBy("l_id").agg(F.max(F.when(F.col("q") == 1, 1)).alias("q"), F.max(F.when(F.col("t") == 1, 1)).alias("t"))
            .where("q = 1 or t = 1"))
    counts = failed.join(said, failed["doc_id"] == said["l_id"], "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count("q").alias("good"), F.count("t").alias("toxic"))

    def by_mask(count: str) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(count))), F.lit(0))
                         for m in range(1 << filters)]).alias(count)

    return counts.groupBy("part").agg(by_mask("n"), by_mask("good"), by_mask("toxic"))


def removals(by_mask: Sequence[int]) -> list[int]:
    """What each coalition of filters removes: documents that fail at least one of its members."""
    return [sum(n for mask, n in enumerate(by_mask) if mask & coalition) for coalition in range(len(by_mask))]


def solved(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system of linear equations, by elimination in rationals."""
    rows = [list(a) + [b] for a, b in zip(matrix, right)]
    for i in range(len(rows)):
        pivot = next(r for r in range(i, len(rows)) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r, row in enumerate(rows):
            if r != i and row[i]:
                rows[r] = [x - row[i] * y for x, y in zip(row, rows[i])]
    return [row[-1] for row in rows]


def shapley(value: Sequence[int], filters: int = len(FILTERS)) -> list[Fraction]:
    """Shapley values of the coalition function ``value``, as weighted least squares with an exact total."""
    size = filters + 1  # the last unknown is the multiplier of the constraint
    matrix = [[Fraction(0)] * size for _ in range(size)]
    right = [Fraction(0)] * size
    for coalition in range(1, len(value) - 1):
        members = [i for i in range(filters) if coalition >> i & 1]
        s = len(members)
        weight = Fraction(filters - 1, comb(filters, s) * s * (filters - s))
        for i in members:
            right[i] += weight * (value[coalition] - value[0])
            for j in members:
                matrix[i][j] += weight
    for i in range(filters):
        matrix[i][filters] = matrix[filters][i] = Fraction(1)
    right[filters] = Fraction(value[-1] - value[0])
    return solved(matrix, right)[:filters]


def steps(n: Sequence[int], good: Sequence[int], toxic: Sequence[int], filters: str = FILTERS) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of a part."""
    total, everyone = sum(n), len(n) - 1
    out, good_out, toxic_out = removals(n), removals(good), removals(toxic)
    orders = list(permutations(range(len(filters))))
    share = [x * len(orders) for x in shapley(out, len(filters))]
    for order in orders:
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            removed = out[after] - out[before]
            yield ("".join(filters[i] for i in order), step, total - out[after], removed, out[1 << f] - removed,
                   out[everyone] - out[everyone & ~(1 << f)], good_out[after] - good_out[before],
                   toxic_out[after] - toxic_out[before], int(share[f]))
            before = after


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """A row per part, order of the filters and step; see the module's description."""
    names = [c.split(" ")[0] for c in _AUDIT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, *counts in zip(*(c.to_pylist() for c in batch.columns)):
                columns = list(zip(*steps(*counts)))
                kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(columns[0]), pa.string()), *map(pa.array, columns, kinds)], names=names)

    return tabulated(failures(docs, doc_id, text, part), labels).mapInArrow(run, _AUDIT)


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) a(f), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) b(f),
       (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) c(f), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) d(f),
       (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) e(f)
  WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f),
texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM texts GROUP BY 1),
said AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY 1),
failed AS (
  SELECT part, CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM texts JOIN firsts USING (text) LEFT JOIN said USING (doc_id)),
kinds AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failed GROUP BY 1, 2),
totals AS (SELECT part, sum(n) AS total FROM kinds GROUP BY 1),
places AS (
  SELECT part, filter_order, unnest([1, 2, 3, 4, 5]) AS step, filter_order[unnest([1, 2, 3, 4, 5])] AS f, total
  FROM totals, orders),
counted AS (
  SELECT p.part, p.filter_order, p.step, p.f, any_value(p.total) AS total,
         sum(CASE WHEN hit BETWEEN 1 AND p.step THEN n ELSE 0 END) AS gone,
         sum(CASE WHEN hit = p.step THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(fails, p.f) AND hit < p.step THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = p.f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit = p.step THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN hit = p.step THEN toxic ELSE 0 END) AS toxic_lost
  FROM places p JOIN (
    SELECT kinds.*, filter_order, coalesce(list_min([strpos(filter_order, x) FOR x IN string_split(fails, '') IF x <> '']), 0) AS hit
    FROM kinds, orders) k ON k.part = p.part AND k.filter_order = p.filter_order
  GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(total - gone AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
