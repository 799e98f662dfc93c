"""The ordered scan against plain Python, with one key that holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import UNCUT, find_cuts, ordered_scan, sort_position, surrogate_key
from ledgerloom.sinks import stage


def _data(n=600, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = rnd.choice(["hot"] * 6 + ["a", "b", "c", None])
        out.append((key, i // 7, rnd.random(), i, rnd.choice([None, None, "x", "y", ""]), rnd.choice([None, 1, 2, 5])))
    rnd.shuffle(out)
    return out


def _brute(data):
    expected = {}
    for key in {r[0] for r in data}:
        group = sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[3]))
        last, run = None, None
        for i, r in enumerate(group):
            last = r[4] if r[4] is not None else last
            run = (run or 0) + r[5] if r[5] is not None else run
            expected[r[3]] = (
                last, run, group[0][4],
                group[i + 1][4] if i + 1 < len(group) else None,
                group[i - 1][4] if i else None,
            )
    return expected


@pytest.mark.parametrize("limit", [10**6, 40, 7, 1])
def test_scan_matches_brute_force(spark, limit):
    data = _data()
    df = spark.createDataFrame(data, "k string, t int, r double, id int, c string, v int").repartition(5)
    got = ordered_scan(
        df, ["k"], ["t", "id"],
        carry={"carried": "c"}, total={"running": "v"}, opening={"opened": "c"},
        following={"nxt": "c"}, preceding={"prv": "c"}, rows_per_task=limit,
    )
    assert set(got.columns) == {"k", "t", "r", "id", "c", "v", "carried", "running", "opened", "nxt", "prv"}
    out = {r.id: (r.carried, r.running, r.opened, r.nxt, r.prv) for r in got.collect()}
    assert out == _brute(data)


def test_large_key_is_cut_and_small_ones_are_not(spark):
    df = spark.createDataFrame(_data(), "k string, t int, r double, id int, c string, v int")
    assert find_cuts(df, ["k"], ["t", "id"], 10**6) is UNCUT
    cuts = find_cuts(df, ["k"], ["t", "id"], 100)
    assert [r.k for r in cuts.table.collect()] == ["hot"]


def test_many_cuts(spark):
    df = spark.range(500).select(F.lit("k").alias("k"), F.col("id").cast("int").alias("id"))
    got = ordered_scan(df.repartition(4), ["k"], ["id"], total={"n": F.lit(1)}, rows_per_task=3)
    assert all(r.n == r.id + 1 for r in got.collect())


@pytest.mark.parametrize("rows", [0, 1, 300])
def test_surrogate_key_is_dense(spark, rows):
    df = spark.range(rows).select((F.col("id") * 7 % 300).alias("id")).repartition(6)
    got = surrogate_key(df, ["id"], "sk", start=5)
    assert got.columns == ["id", "sk"]
    assert sorted((r.id, r.sk) for r in got.collect()) == [(i, k + 5) for k, i in enumerate(sorted(7 * n % 300 for n in range(rows)))]


def test_both_ways_give_the_same_types(spark):
    df = spark.createDataFrame(_data(), "k string, t int, r double, id int, c string, v int").withColumn("m", F.col("v").cast("decimal(12,2)"))
    ways = [ordered_scan(df, ["k"], ["t", "id"], total={"a": "v", "b": "m"}, rows_per_task=n) for n in (10**6, 20)]
    assert ways[0].dtypes == ways[1].dtypes
    assert sorted(map(str, ways[0].collect())) == sorted(map(str, ways[1].collect()))
    with pytest.raises(TypeError):
        ordered_scan(df, ["k"], ["t"], total={"x": "r"})


def test_sort_position_is_textual(spark):
    df = spark.createDataFrame([(1, 10), (2, 9), (3, 100), (4, 9)], "id int, v int")
    got = sort_position(df, F.col("v"), ["id"])
    assert {r.id: r.position for r in got.collect()} == {1: 1, 3: 2, 2: 3, 4: 4}


def test_rows_of_a_segment_meet_what_enters_it_where_they_are(spark):
    """One shuffle for the pass, none for the join with the rolled-up segments; a null key is a key."""
    rows = [(None if i % 3 == 0 else i % 3, i, i if i % 4 else None) for i in range(120)]
    df = stage(spark.createDataFrame(rows, "k int, i int, v int"), "rows")
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        got = ordered_scan(df, ["k"], ["i"], carry={"last": "v"}, total={"sum": F.col("i").cast("bigint")}, rows_per_task=5)
        plan = got._jdf.queryExecution().executedPlan().toString()
        found = {r.i: (r.last, r.sum) for r in got.collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for k in (None, 1, 2):
        last = None
        for i, v in sorted((i, v) for key, i, v in rows if key == k):
            last = v if v is not None else last
            assert found[i] == (last, sum(j for key, j, _ in rows if key == k and j <= i))
    # cuts and rows for the pass and again for the roll-up, the pass, the roll-up, its window, what enters the segments
    assert plan.count("Exchange hashpartitioning") == 8, plan
