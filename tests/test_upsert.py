"""Upserts: first and last columns, sums, halves against whole."""

import random

from pyspark.sql import functions as F

from ledgerloom.operators import upsert as ups


def _rows(seed=2, n=200):
    rnd = random.Random(seed)
    return [(rnd.choice("aaab"), i, rnd.choice([None, "x", "y"]), rnd.choice([None, 1, 2]), rnd.randrange(5)) for i in range(n)]


SCHEMA = "k string, seq int, f string, l int, m int"


def _upsert(df, **more):
    return ups.upsert(df, ["k"], ["seq"], first=["f"], last=["l"], add=["m"], **more)


def test_upsert_matches_a_loop(spark):
    expected = {}
    for k, _, f, l, m in _rows():
        if k in expected:
            expected[k] = (expected[k][0], l, expected[k][2] + m)
        else:
            expected[k] = (f, l, m)
    df = spark.createDataFrame(_rows(), SCHEMA).orderBy(F.rand(3))
    assert {r.k: (r.f, r.l, r.m) for r in _upsert(df).collect()} == expected


def test_two_halves_equal_the_whole(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    early, late = df.where("seq < 77"), df.where("seq >= 77")
    assert sorted(_upsert(late, existing=_upsert(early)).collect()) == sorted(_upsert(df).collect())


def test_second_sighting(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 3, "r"), ("a", 2, "q"), ("b", 1, "p")], "k string, seq int, v string")
    got = ups.second_sighting(df, ["k"], ["seq"], "v", "opened", "closed")
    assert sorted(tuple(r) for r in got.collect()) == [("a", "p", "r"), ("b", "p", None)]


def test_open_close_goes_by_action_not_by_arrival(spark):
    df = spark.createDataFrame([("a", 5, "CNCL"), ("a", 1, "ACTV"), ("a", 2, "ACTV"), ("b", 1, "CNCL"), ("c", 1, "?")], "k string, t int, act string")
    act = F.col("act")
    got = ups.open_close(df, ["k"], "t", {"placed": act == "ACTV"}, {"removed": act == "CNCL"})
    assert sorted((tuple(r) for r in got.collect()), key=str) == [("a", 1, 5), ("b", None, 1), ("c", None, None)]


def test_update_from(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, v string, w int")
    new = spark.createDataFrame([(1, "z"), (2, None), (9, "y")], "k int, v string")
    got = ups.update_from(df, new, ["k"], ["v"])
    assert got.columns == ["k", "v", "w"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "z", 1), (2, None, 2), (3, "c", 3)]
