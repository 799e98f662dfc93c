"""Messages, checks and reconciliation."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import quality


def test_check_ignores_unknown_outcomes(spark):
    df = spark.createDataFrame([(1, "4"), (2, "1"), (3, None)], "k int, tier string")
    got = quality.check(df, ~F.col("tier").try_cast("int").isin(1, 2, 3), "S", "bad tier", F.col("k"), batch=2)
    assert [tuple(r) for r in got.collect()] == [(2, "S", "bad tier", "Alert", "1")]


def test_domain_counts_missing_as_outside(spark):
    df = spark.createDataFrame([(0,), (2,), (5,), (None,)], "v int")
    assert df.where(quality.outside_domain(F.col("v"), (0, 1, 2))).count() == 2


def test_status_and_stamp(spark):
    at = F.lit("2020-01-01 00:00:00").cast("timestamp")
    row = quality.stamped(quality.status_message(spark.range(5), "T"), at).first()
    assert tuple(row) == (dt.datetime(2020, 1, 1), 1, "T", "Inserted rows", "Status", "5")
    now = quality.stamped(quality.status_message(spark.range(5), "T")).first()
    assert now.message_time.year >= 2024


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "k int, v string")
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert sorted(tuple(r) for r in quality.null_counts(df, ["k", "v"]).collect()) == [("k", 0), ("v", 2)]


def test_reconcile(spark):
    df = spark.range(4)
    actual = quality.long_form(df, "T", {"rows": F.count(F.lit(1)), "sum": F.sum("id")})
    expected = quality.long_form(df, "T", {"rows": F.lit(4), "sum": F.lit(7), "gone": F.lit(1)})
    got = {r.attribute: (r.actual, r.matches) for r in quality.reconcile(expected, actual).collect()}
    assert got == {"rows": (4, True), "sum": (6, False), "gone": (None, False)}
