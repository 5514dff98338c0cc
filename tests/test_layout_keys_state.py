"""Interleaved layout, keys from stored positions, mergeable distinct counts, sizes by bytes."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.operators import distinct_state
from tessera.operators.joins import broadcast_if_small, bytes_at_most, lookup_join
from tessera.operators.keys import assign_keys
from tessera.operators.layout import interleaved_layout, quantile_bounds, rank_of


def test_statistics_skip_files_on_each_key(spark, workdir):
    df = (spark.range(30000).select((F.col("id") * 7919 % 10007).alias("a"),
                                    F.date_add(F.lit("2020-01-01"), (F.col("id") * 104729 % 900).cast("int")).alias("b"),
                                    F.concat(F.lit("k"), F.lpad((F.col("id") * 31 % 1000).cast("string"), 4, "0")).alias("c")))
    path = f"{workdir}/z"
    interleaved_layout(df, ["a", "b", "c"], 64).write.parquet(path)
    files = [f for f in spark.read.parquet(path).inputFiles()]
    read = {"a": 5000, "b": __import__("datetime").date(2021, 6, 1), "c": "k0500"}
    for i, (key, value) in enumerate(read.items()):
        hit = 0
        for f in files:
            meta = pq.ParquetFile(f.replace("file://", "").replace("file:", "")).metadata
            stats = [meta.row_group(g).column(i).statistics for g in range(meta.num_row_groups)]
            hit += any(s.min <= value <= s.max for s in stats)
        assert hit <= len(files) // 2, (key, hit, len(files))
    assert spark.read.parquet(path).count() == 30000


def test_a_hot_value_is_spread(spark):
    df = spark.range(20000).select(F.lit(1).alias("a"), F.lit("x").alias("b"), "id")
    sizes = interleaved_layout(df, ["a", "b"], 16).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 8 and max(r["count"] for r in sizes) < 5000


def test_bounds_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, None)], "a long, b long")
    bounds = quantile_bounds(df, ["a", "b"])
    assert bounds == {"a": [3], "b": [1, 2]}
    assert sorted(r[0] for r in df.select(rank_of(F.col("b"), bounds["b"])).collect()) == [0, 1, 2]
    assert interleaved_layout(df.limit(0), ["a", "b"]).count() == 0
    assert sorted(map(str, interleaved_layout(df, ["a", "b"]).collect())) == sorted(map(str, df.collect()))


def test_keys_evaluate_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(5000).select((F.col("id") * 37 % 101).alias("g"), "id").mapInArrow(note, "g long, id long")
    keyed = assign_keys(df, ["g", "id"], "key", base=10, num_partitions=7).collect()
    assert seen.value == 5000
    rows = sorted(keyed, key=lambda r: (r["g"], r["id"]))
    assert [r["key"] for r in rows] == list(range(11, 5011))


def test_keys_of_ties_and_nothing(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [("a", 2), (None, 3)], "x string, _k_row long")
    keyed = assign_keys(df, ["x"], "key", num_partitions=4)
    assert keyed.columns == ["x", "_k_row", "key"]
    assert sorted(r["key"] for r in keyed.collect()) == list(range(1, 53))
    assert [r["key"] for r in keyed.where("x IS NULL").collect()] == [1]
    assert assign_keys(df.limit(0), ["x"], "key").count() == 0


def test_merged_states_count_like_all_rows(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.choice([None, *[f"o{i}" for i in range(40000)]]), rng.randrange(9)) for _ in range(60000)]
    rows += [("none", None, 1), ("none", None, 2)]
    df = spark.createDataFrame(rows, "g string, o string, q long").repartition(4).cache()
    numbers, state = distinct_state.empty_numbers(spark, "o", "n"), None
    for part in ("q < 3", "q BETWEEN 3 AND 5", "q > 5"):
        feed = df.where(part)
        numbers = distinct_state.number_new(numbers, feed, "o", "n", ["g"]).checkpoint()
        new = distinct_state.state_of(feed, numbers, ["g"], "o", "n", ["q"])
        state = new if state is None else distinct_state.merged(state, new, ["g"], ["q"])
    assert numbers.count() == numbers.agg(F.max("n")).first()[0] == df.select("o").distinct().where("o IS NOT NULL").count()
    got = sorted(map(tuple, distinct_state.counted(state, ["g"], ["q"], "ids").collect()))
    want = sorted(map(tuple, df.groupBy("g").agg(F.sum("q"), F.count_distinct("o")).collect()))
    assert got == want


def test_sizes_are_judged_by_bytes(spark, workdir):
    wide = spark.range(200).select("id", F.repeat(F.lit("x"), 10000).alias("t")).repartition(2)
    wide.write.parquet(f"{workdir}/wide")
    stored = spark.read.parquet(f"{workdir}/wide")
    assert not bytes_at_most(wide, 100_000) and bytes_at_most(wide, 3_000_000)
    assert bytes_at_most(stored, 3_000_000)
    hinted = broadcast_if_small(stored, 10)._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in hinted and "UnresolvedHint" not in hinted
    assert lookup_join(spark.range(5), stored, "id").count() == 5


@pytest.mark.parametrize("limit", [1, 10_000])
def test_an_empty_side_is_small(spark, limit):
    assert bytes_at_most(spark.createDataFrame([], "a long, b string"), limit)
