"""Cleaning functions: own values for each rule, and edge rows."""

import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions import clean


def _col(spark, values, fn, name="v", dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")
    return [r[0] for r in df.select(fn(name)).collect()]


def test_title_case(spark):
    got = _col(spark, ["ada", "mAX von planck", "two  blanks", "well-known o'brien", "", None], clean.title_case)
    assert got == ["Ada", "Max Von Planck", "Two  Blanks", "Well-known O'brien", "", None]


def test_digits(spark):
    got = _col(spark, ["+41 22 767 6111", "12 pcs", "0007", "none", "7.25", None], clean.digits_only)
    assert got == ["41227676111", "12", "0007", "", "725", None]


def test_digits_to_int(spark):
    got = _col(spark, ["4,096", "6.75", "-12", "xyz", "", None, "88888888888", "$3,141.593",
                       "(42)", "EUR 9"], lambda c: clean.to_int(clean.digits_only(c)))
    assert got == [4096, 675, 12, None, None, None, None, 3141593, 42, 9]


def test_currency(spark):
    got = _col(spark, ["$7", "$12,345,678.90", "88.10", "$ 5", "CHF 3", ""], clean.strip_currency)
    assert got == ["7", "12345678.90", "88.10", " 5", "CHF 3", ""]


def test_currency_to_decimal(spark):
    got = _col(spark, ["4,096", "6.7", "-12", "xyz", "", None, "88888888888", "$3,141.595",
                       "(42.00)", "EUR 9", "8765432109.87"],
               lambda c: clean.to_money(clean.strip_currency(c)))
    assert got == [Decimal("4096.00"), Decimal("6.70"), Decimal("-12.00"), None, None, None,
                   None, Decimal("3141.60"), None, None, None]


def test_zoned_timestamps(spark):
    values = ["2021-12-31 20:05:09 PST", "2021-12-31 20:05:09 EST", "2022-07-04 23:59:59 PDT",
              "  2021-12-31 20:05:09 PST", "2022-07-04 00:00:01 EDT", "2022-02-28 07:08:09 Z",
              "2022-02-28 07:08:09 -03:30", "2022-02-28 07:08:09 UTC", "2022-02-28 07:08:09 CST",
              "2022-02-28 07:08:09", "2022-02-28T07:08:09 PST", "\t2022-02-28 07:08:09 PST",
              "soon", "", None]
    got = _col(spark, values, clean.parse_zoned_timestamp)
    expect = [dt.datetime(2022, 1, 1, 4, 5, 9), dt.datetime(2022, 1, 1, 1, 5, 9),
              dt.datetime(2022, 7, 5, 6, 59, 59), dt.datetime(2022, 1, 1, 4, 5, 9),
              dt.datetime(2022, 7, 4, 4, 0, 1), dt.datetime(2022, 2, 28, 7, 8, 9),
              dt.datetime(2022, 2, 28, 10, 38, 9)] + [None] * 8
    assert got == expect


def test_clean_timestamp_writes_requested_column(spark):
    df = spark.createDataFrame([("2022-03-04 05:06:07 EST",)], "sent_at string")
    out = clean.with_clean_timestamp(df, "sent_at", out="order_timestamp")
    assert out.columns == ["sent_at", "order_timestamp"]


def test_corrupt_filter(spark):
    df = spark.createDataFrame([(1, "Y"), (2, "N"), (3, None), (4, "y"), (5, ""), (6, "Y ")], "k int, bad string")
    kept = sorted(r[0] for r in clean.drop_corrupt(df, "bad").collect())
    assert kept == [2, 3, 4, 5, 6]


def test_change_hash(spark):
    people = [("Ada", "L.", "ada@example.org"), ("Max", "P.", "max@example.org")]
    df = spark.createDataFrame(people, "a string, b string, c string")
    got = [r.hash_value for r in clean.with_change_hash(df, ["a", "b", "c"]).collect()]
    assert got == [hashlib.sha256("|".join(p).encode()).hexdigest() for p in people]


def test_change_hash_null_skipping_and_token(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a|b", None, None),
                                (None, None, None)], "x string, y string, z string")
    plain = [r[0] for r in df.select(clean.change_hash(["x", "y", "z"])).collect()]
    assert plain[0] == plain[1] == plain[2] == hashlib.sha256(b"a|b").hexdigest()
    assert plain[3] == hashlib.sha256(b"").hexdigest()
    token = [r[0] for r in df.select(clean.change_hash(["x", "y", "z"], null_token="\\N")).collect()]
    assert len(set(token[:3])) == 3


def test_cleaning_stays_in_codegen(spark):
    df = spark.createDataFrame([("$1.00", "7 pcs", "2022-03-04 05:06:07 PST", None)],
                               "price string, quantity string, ts string, flag string")
    out = (clean.drop_corrupt(df, "flag")
           .select(clean.to_money(clean.strip_currency("price")),
                   clean.to_int(clean.digits_only("quantity")),
                   clean.parse_zoned_timestamp("ts")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
