"""URL rules by host-suffix and path-prefix expressions.

A rule is (host, path, verdict) and fits its host and all subdomains where the URL's path
starts with its path. Each URL is expanded into the host suffixes and path prefixes that any
rule could have (only label counts and path lengths that occur among the rules, so long hosts
and paths stay cheap and no rule is missed). Expressions meet rules in an equi-join on the
first bytes of their SHA-256; the full digest confirms a match; the longest rule decides.

Defined results: a null URL or one without ``://`` has an empty host and path and fits no
rule. Of rules of equal length the one with the longer host wins, then ``block``. Without a
rule the default verdict holds. Repeated rows are judged each by itself; an empty table gives
an empty result, an empty rule list the default for all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import table, unused

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORT_DIGITS = 8  # hex digits of the digest in the join key: 32 bits

#: The rules of the registered query (fixed values): host, path, verdict.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL, by the first ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def expression(host: Column, path: Column) -> Column:
    """Digest of a host suffix with a path prefix; the length keeps the two parts apart."""
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit(":"), host, path), 256)


def apply_rules(pages: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url",
                default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null if none) and verdict under free names."""
    spark = pages.sparkSession
    host_c, path_c, rule_c, verdict_c, row, exprs, full = unused(
        pages, "host", "path", "rule", "verdict", "row", "exprs", "full")
    rules = [(h.translate(str.maketrans(UPPER, LOWER)), p, v) for h, p, v in rules]
    labels = sorted({h.count(".") + 1 for h, _, _ in rules})
    lengths = sorted({len(p) for _, p, _ in rules})
    host, path = host_and_path(F.col(url))
    parts = F.split(F.col(host_c), r"\.")
    held = pages.withColumn(host_c, host).withColumn(path_c, path).withColumn(row, F.monotonically_increasing_id())
    if not rules:
        return (held.drop(row).withColumn(rule_c, F.lit(None).cast("string"))
                .withColumn(verdict_c, F.lit(default)))

    def numbers(values: list[int]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    suffixes = F.transform(F.filter(numbers(labels), lambda n: n <= F.size(parts)),
                           lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    prefixes = F.transform(F.filter(numbers(lengths), lambda n: n <= F.length(F.col(path_c))),
                           lambda n: F.col(path_c).substr(F.lit(1), n))
    found = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: expression(h, p))))
    listed = spark.createDataFrame([(h, p, v, f"{h}{p}", [len(h) + len(p), len(h), int(v == "block")])
                                    for h, p, v in rules],
                                   "r_host string, r_path string, r_verdict string, r_name string, r_rank array<int>")
    listed = listed.withColumn("r_full", expression(F.col("r_host"), F.col("r_path")))
    listed = listed.select(F.substring("r_full", 1, SHORT_DIGITS).alias("r_short"), "r_full", "r_verdict", "r_name",
                           "r_rank")
    # A rule meets each page at most once per expression; the page's row number is its key from here.
    hits = (held.select(row, F.explode(found).alias(full))
            .withColumn("r_short", F.substring(full, 1, SHORT_DIGITS))
            .join(listed, "r_short").where(F.col(full) == F.col("r_full")))
    everything = (held.withColumn("r_name", F.lit(None).cast("string"))
                  .withColumn("r_verdict", F.lit(default)).withColumn("r_rank", numbers([-1, -1, -1])))
    best = hits.select(row, "r_name", "r_verdict", "r_rank")
    keep = [c for c in everything.columns if c not in (row, "r_name", "r_verdict", "r_rank")]
    payload = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])
    merged = (everything.select(row, "r_name", "r_verdict", "r_rank", payload.alias("page"))
              .unionByName(best, allowMissingColumns=True))
    out = merged.groupBy(row).agg(F.max_by(F.struct("r_name", "r_verdict"), F.col("r_rank")).alias("best"),
                                  F.max_by("page", F.when(F.col("page").isNotNull(), 1)).alias("page"))
    return out.select(*[F.col(f"page.c{i}").alias(c) for i, c in enumerate(keep)],
                      F.col("best.r_name").alias(rule_c), F.col("best.r_verdict").alias(verdict_c))


def op8_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return apply_rules(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = """
WITH cut AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN position('://' IN coalesce(url, '')) > 0
              THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
named AS (
  SELECT r, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
rules(rhost, rpath, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT n.r, rhost || rpath AS rule, v,
         row_number() OVER (PARTITION BY n.r ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
  FROM named n JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM named LEFT JOIN (SELECT * FROM fits WHERE k = 1) f USING (r)
"""
