"""Lookups: at most one match, both strategies alike, hot keys included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import lookup as look


def d(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def _facts(seed=5):
    rnd = random.Random(seed)
    keys = ["hot"] * 5 + ["a", "b", "none", None]
    return [(i, rnd.choice(keys), rnd.choice([None] + [d(n) for n in range(-3, 40)])) for i in range(500)]


DIM = [
    ("hot", d(0), d(5), 1), ("hot", d(5), d(9), 2), ("hot", d(12), d(20), 3), ("hot", d(20), None, 4),
    ("a", d(3), d(30), 5), ("a", d(25), d(28), 6), ("b", d(1), d(2), 7), ("b", d(1), d(4), 8),
    (None, d(0), None, 9), ("a", None, None, 10),
]
NESTED = [*DIM, ("hot", d(1), None, 11), ("hot", d(2), d(30), 12), ("hot", d(6), d(7), 13), ("b", d(0), d(38), 14), ("b", d(9), d(9), 15)]


def _brute(closed, dim=DIM):
    """Of the versions valid at the fact's date, the one that started last."""
    out = {}
    for i, key, at in _facts():
        valid = [
            (start, sk) for k, start, end, sk in dim
            if key is not None and at is not None and start is not None and k == key and start <= at
            and (end is None or at < end or (closed and at == end))
        ]
        out[i] = max(valid)[1] if valid else None
    return out


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("versions", [DIM, NESTED])
@pytest.mark.parametrize("small, task", [(100, 10**6), (0, 10**6), (0, 50), (0, 3)])
def test_temporal_lookup(spark, closed, small, task, versions):
    facts = spark.createDataFrame(_facts(), "id int, k string, at date").repartition(4)
    dim = spark.createDataFrame(versions, "k string, s date, e date, sk int")
    got = look.temporal_lookup(
        facts, dim, ["k"], "at", "s", "e", ["sk"], tie=["sk"], closed=closed,
        small_rows=small, rows_per_task=task,
    )
    assert got.columns == ["id", "k", "at", "sk"]
    rows = got.collect()
    assert len(rows) == 500
    assert {r.id: r.sk for r in rows} == _brute(closed, versions)


@pytest.mark.parametrize("levels, task", [(16, 10**6), (2, 40), (0, 10**6)])
def test_nested_versions_are_cut_by_a_sweep(spark, levels, task):
    rnd = random.Random(levels)
    rows = [("hot" if i % 3 else f"k{i % 7}", s, None if i % 41 == 0 else s + 1 + rnd.randrange(60), i) for i, s in ((i, rnd.randrange(300)) for i in range(240))]
    rows += [("hot", 5, 9, 900), ("hot", 5, 300, 900)]
    versions = spark.createDataFrame(rows, "k string, __t int, __end int, sk int")
    versions = versions.select("k", *[F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("t"), F.lit(0).alias("after"))).alias(c) for c in ("__t", "__end")], F.struct("sk").alias("__tie"), F.struct("sk").alias("__row"))
    spans = look.disjoint(versions, ["k"], levels, rows_per_task=task)
    plan = spans._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan  # no key is gathered in one row or task
    got = {}
    for x in spans.collect():
        got.setdefault(x.k, []).append((x["__t"].t, x["__end"].t if x["__end"] else 10**6, x["__row"].sk))
    for k in {r[0] for r in rows}:
        for at in range(-1, 400):
            valid = [(s, sk) for key, s, e, sk in rows if key == k and s <= at and (e is None or at < e)]
            assert [sk for s, e, sk in got[k] if s <= at < e] == ([max(valid)[1]] if valid else []), (k, at)


@pytest.mark.parametrize("small", [100, 0])
def test_temporal_lookup_inner_and_renames(spark, small):
    facts = spark.createDataFrame(_facts(), "id int, k string, at date")
    dim = spark.createDataFrame(DIM, "dk string, s date, e date, sk int")
    got = look.temporal_lookup(
        facts, dim, {"k": "dk"}, "at", "s", "e", {"version": "sk"}, tie=["sk"], how="inner", small_rows=small
    )
    expected = {i: v for i, v in _brute(False).items() if v is not None}
    assert {r.id: r.version for r in got.collect()} == expected


def test_many_versions_are_not_broadcast(spark):
    facts = spark.createDataFrame([(1, "k", d(70))], "id int, k string, at date")
    dim = spark.createDataFrame([("k", d(i), d(i + 1), i) for i in range(100)], "k string, s date, e date, sk int")
    got = look.temporal_lookup(facts, dim, ["k"], "at", "s", "e", ["sk"])
    assert "Broadcast" not in got._jdf.queryExecution().sparkPlan().toString()
    assert [r.sk for r in got.collect()] == [70]


def test_id_or_name(spark):
    dim = spark.createDataFrame(
        [(1, "Ace", d(0), d(5), 10), (1, "Ace", d(5), None, 11), (2, "Bee", d(0), None, 20)],
        "id long, name string, s date, e date, sk int",
    )
    facts = spark.createDataFrame(
        [(1, "0000000001", d(1)), (2, "0000000001", d(6)), (3, "Ace   ", d(6)), (4, "Bee", d(-1)),
         (5, "0x", d(1)), (6, None, d(1)), (7, "Bee", d(0))],
        "n int, ref string, at date",
    )
    inner = look.id_or_name_lookup(facts, dim, "ref", "id", "name", ["sk"], at="at", start="s", end="e")
    assert sorted((r.n, r.sk) for r in inner.collect()) == [(1, 10), (2, 11), (3, 11), (7, 20)]
    left = look.id_or_name_lookup(
        facts, dim, "ref", "id", "name", ["sk"], at="at", start="s", end="e", how="left"
    )
    assert sorted(r.n for r in left.collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_failed_lookup_gives_the_default_and_nothing_else(spark):
    facts = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "n int, b int")
    dim = spark.createDataFrame([(5, 50)], "broker int, sk int")
    got = look.lookup_default(facts, dim, {"b": "broker"}, "sk", "sk_broker")
    assert sorted((r.n, r.sk_broker) for r in got.collect()) == [(1, 50), (2, -1), (3, -1)]


def test_enrichment_takes_nulls_as_blank_on_both_sides(spark):
    left = spark.createDataFrame(
        [(1, "Ames", None, True), (2, "AMES", "x", True), (3, "ames", None, False), (4, None, None, True)],
        "n int, last string, first string, cur boolean",
    )
    right = spark.createDataFrame(
        [("B", "ames", None, 2), ("A", "Ames", "", 1), ("C", "nan", "nan", 3)], "agency string, last string, first string, worth int"
    )
    key = look.derived_key(["last", "first"])
    got = look.enrich_on(left, right, key, key, F.col("cur"), ["agency", "worth"], ["agency"])
    assert sorted((r.n, r.agency, r.worth) for r in got.collect()) == [
        (1, "A", 1), (2, None, None), (3, None, None), (4, None, None),
    ]


def test_code_lookup_uses_each_column_for_itself(spark):
    facts = spark.createDataFrame([(1, "N", "L"), (2, None, "L"), (3, "N", "?")], "n int, nat string, lcl string")
    codes = spark.createDataFrame([("N", "nation", 0.3), ("L", "local", 0.1)], "id string, name string, rate double")
    got = look.code_lookup(facts, codes, "nat", "id", {"nat_name": "name"})
    got = look.code_lookup(got, codes, "lcl", "id", {"lcl_name": "name"})
    assert sorted((r.n, r.nat_name, r.lcl_name) for r in got.collect()) == [
        (1, "nation", "local"), (2, None, "local"), (3, "nation", None),
    ]


def test_semi_join_keeps_left_rows_once(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    right = spark.createDataFrame([(2,), (2,), (3,)], "r int")
    got = look.semi_join(left, right, "k", "r")
    assert sorted(tuple(r) for r in got.collect()) == [(2, "b"), (2, "c")]
    assert look.merge_join(left, right, "k", "r").count() == 4


def test_star_and_clock_lookup(spark):
    facts = spark.sql("SELECT 1 n, 'x' code, timestamp_ntz'2020-01-01 00:00:59' ts UNION ALL SELECT 2, 'y', timestamp_ntz'2020-01-02 00:01:00'")
    codes = spark.createDataFrame([("x", "ex")], "code string, name string")
    assert [(r.n, r.name) for r in look.star_lookup(facts, (codes, "code", "code")).collect()] == [(1, "ex")]
    dates = spark.sql("SELECT date'2020-01-01' day, 1 id")
    times = spark.sql("SELECT '00:00:59' clock, 59 id")
    got = look.date_time_keys(facts, "ts", dates, "day", "id", times, "clock", "id", how="left")
    assert sorted((r.n, r.date_key, r.time_key) for r in got.collect()) == [(1, 1, 59), (2, None, None)]



def test_both_ways_give_the_same_columns(spark):
    facts = spark.createDataFrame(_facts(), "id int, sk string, at date").withColumnRenamed("sk", "k").withColumn("sk", F.lit(0))
    dim = spark.createDataFrame(DIM, "k string, s date, e date, sk int")
    ways = [look.temporal_lookup(facts, dim, ["k"], "at", "s", "e", ["sk"], tie=["sk"], small_rows=n) for n in (100, 0)]
    assert ways[0].dtypes == ways[1].dtypes == [("id", "int"), ("k", "string"), ("at", "date"), ("sk", "int")]
    assert sorted(map(str, ways[0].collect())) == sorted(map(str, ways[1].collect()))


def test_histories_that_share_a_key_are_not_cut(spark, monkeypatch):
    """Versions overlap, yet the one that began last is always the valid one: nothing is dealt to ranges."""
    rnd = random.Random(3)
    rows = []
    for member in range(30):
        days = sorted({0, *rnd.sample(range(1, 200), 4)})
        rows += [("k", d(s), d(e) if e else None, 1000 * member + s) for s, e in zip(days, [*days[1:], None])]
    facts = [(i, "k", d(i)) for i in range(-1, 210)]
    monkeypatch.setattr(look, "disjoint", lambda *_, **__: pytest.fail("cut"))
    monkeypatch.setattr(look, "_disjoint_few", lambda *_, **__: pytest.fail("cut"))
    dim = spark.createDataFrame(rows, "k string, s date, e date, sk int")
    got = look.temporal_lookup(spark.createDataFrame(facts, "id int, k string, at date"), dim, ["k"], "at", "s", "e", ["sk"], tie=["sk"])
    valid = {i: [(s, sk) for _, s, e, sk in rows if s <= at and (e is None or at < e)] for i, _, at in facts}
    assert {r.id: r.sk for r in got.collect()} == {i: max(v)[1] if v else None for i, v in valid.items()}


def test_a_dimension_is_made_ready_once_and_only_names_are_searched(spark, monkeypatch):
    searched = []
    marked = look._marked
    monkeypatch.setattr(look, "_marked", lambda versions, *a, **b: searched.append(versions.count()) or marked(versions, *a, **b))
    dim = spark.createDataFrame(
        [(1, "Ace", d(0), d(5), 10), (1, "Ace", d(5), None, 11), (2, "Ace", d(1), d(3), 20), (3, "Bee", d(0), None, 30)],
        "id long, name string, s date, e date, sk int",
    )
    ready = look.IdOrName(dim, "id", "name", ["sk"], "s", "e", ["sk"], flat_ids=True)
    facts = spark.createDataFrame(
        [(1, "0000000001", d(2)), (2, "0000000002", d(4)), (3, "Ace ", d(2)), (4, "Ace", d(4)), (5, "Bee", d(9)), (6, None, d(1))], "n int, ref string, at date"
    )
    for rows in (facts, facts.where("n > 2")):
        got = {r.n: r.sk for r in ready.look_up(rows, "ref", "at", how="left").collect()}
        assert got == {k: v for k, v in {1: 10, 2: None, 3: 20, 4: 10, 5: 30, 6: None}.items() if k > 2 or rows is facts}
    assert searched == [4]


def test_scan_shuffles_no_hash_and_keeps_types(spark):
    facts = spark.createDataFrame(_facts(), "id int, k string, at date").withColumn("n", F.col("id") % 3)
    dim = spark.createDataFrame([(i, d(0), None, i) for i in range(3)], "n long, s date, e date, sk int")
    got = look.temporal_lookup(facts, dim, ["n"], "at", "s", "e", ["sk"], small_rows=0)
    assert "xxhash64" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.dtypes == [*facts.dtypes, ("sk", "int")]
    assert all(r.sk == (r.n if r["at"] and r["at"] >= d(0) else None) for r in got.collect())


def test_facts_with_row_numbers_are_joined_by_them_alone(spark):
    facts = spark.createDataFrame([(n, i, k, at) for n, (i, k, at) in enumerate(_facts() * 2)], "row long, id int, k string, at date").withColumn("g", F.col("k"))
    dim = spark.createDataFrame(DIM, "k string, s date, e date, sk int")
    versions = [look.Versions(dim, {c: "k"}, "s", "e", {f"sk_{c}": "sk"}, tie=["sk"]) for c in ("k", "g")]
    got = look.temporal_lookups(facts, "at", ["row"], *versions, small_rows=0, unique=True)
    assert "Deduplicate" not in got._jdf.queryExecution().analyzed().toString()
    assert got.columns == [*facts.columns, "sk_k", "sk_g"]
    rows, want = got.collect(), _brute(False)
    assert len(rows) == 1000 and all(r.sk_k == r.sk_g == want[r.id] and r.k == r.g for r in rows)


def test_points_of_time_are_plain_unless_the_end_is_included(spark):
    """Rows of a half-open lookup are sorted and shuffled with the day itself, not with a record around it."""
    facts = spark.sql("SELECT id % 3 AS k, date_add(DATE '2020-01-01', CAST(id AS INT)) AS day FROM range(9)")
    dim = spark.sql("SELECT id % 3 AS k, date_add(DATE '2020-01-01', CAST(id AS INT)) AS s, date_add(DATE '2020-01-03', CAST(id AS INT)) AS e, id AS v FROM range(6)")
    for closed, size in ((False, 6), (True, 6)):
        found = look.temporal_lookup(facts, dim, ["k"], "day", "s", "e", ["v"], closed=closed, small_rows=0)
        assert ("struct(t, " in found._jdf.queryExecution().optimizedPlan().toString()) == closed
        assert found.where("v IS NOT NULL").count() == size
