"""Type 2 versions and change-log replay: properties and order independence."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import changelog as log
from ledgerloom.operators.scd import OPEN_END, latest_per, scd2


def d(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def _snapshots(seed):
    rnd = random.Random(seed)
    return [(rnd.choice(["hot"] * 4 + ["a", "b"]), d(rnd.randrange(40)), i, rnd.randrange(9)) for i in range(300)]


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
@pytest.mark.parametrize("task", [10**6, 10])
def test_versions_are_contiguous(spark, kind, task):
    df = spark.createDataFrame(_snapshots(1), "k string, eff date, seq int, v int").repartition(3)
    df = df.withColumn("eff", F.col("eff").cast(kind))
    extra = {} if kind == "date" else {"rows_per_task": task}
    rows = scd2(df, ["k"], "eff", ["seq"], **extra).collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.k, []).append(r)
    snapshots = {}
    for k, eff, seq, v in _snapshots(1):
        if (k, eff) not in snapshots or snapshots[k, eff][0] < seq:
            snapshots[k, eff] = (seq, v)
    assert len(rows) == len(snapshots)
    for key, versions in by_key.items():
        versions.sort(key=lambda r: r.eff)
        assert [r.is_current for r in versions] == [False] * (len(versions) - 1) + [True]
        for one, two in zip(versions, versions[1:]):
            assert one.end_date == two.eff and one.eff < one.end_date
        assert str(versions[-1].end_date)[:10] == OPEN_END
        for r in versions:
            eff = r.eff if kind == "date" else r.eff.date()
            assert snapshots[key, eff] == (r.seq, r.v)


def test_latest_per_keeps_nulls_of_the_last_row(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 1, "b")], "k int, seq int, v string")
    assert sorted(tuple(r) for r in latest_per(df, ["k"], ["seq"]).collect()) == [(1, 2, None), (2, 1, "b")]


LOG = [
    ("c1", 1, "NEW", "x", "1"), ("c1", 2, "UPD", None, "2"), ("c1", 3, "UPD", "", None),
    ("c1", 4, "INACT", None, None), ("c1", 5, "UPD", "z", None),
    ("c2", 3, "UPD", "late", None), ("c3", 2, "INACT", None, None),
]


@pytest.mark.parametrize("task", [10**6, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_replay(spark, task, seed):
    shuffled = list(LOG)
    random.Random(seed).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "k string, t int, op string, name string, tier string").repartition(3)
    got = log.replay(
        df, ["k"], ["t"], ["name", "tier"], effective="t",
        status_of={"NEW": "ACTIVE", "INACT": "INACTIVE"}, end="until", rows_per_task=task,
    )
    assert sorted((r.k, r.t, r.name, r.tier, r.status, r.until, r.is_current) for r in got.collect()) == [
        ("c1", 1, "x", "1", "ACTIVE", 2, False),
        ("c1", 2, "x", "2", "ACTIVE", 3, False),       # null is unchanged
        ("c1", 3, None, "2", "ACTIVE", 4, False),      # blank is cleared
        ("c1", 4, None, "2", "INACTIVE", 5, False),    # and stays cleared
        ("c1", 5, "z", "2", "INACTIVE", None, True),   # an update does not activate
        ("c2", 3, "late", None, None, None, True),
        ("c3", 2, None, None, "INACTIVE", None, True),
    ]


@pytest.mark.parametrize("task", [10**6, 1])
def test_replay_with_an_opening(spark, task):
    df = spark.createDataFrame(LOG, "k string, t int, op string, name string, tier string").repartition(3)
    got = log.replay(
        df, ["k"], ["t"], ["name"], effective="t", opening="OPEN",
        status_of={"OPEN": "ACTIVE", "INACT": "INACTIVE"}, end="until", rows_per_task=task,
    )
    assert sorted((r.k, r.t, r.op, r.status) for r in got.collect()) == [
        ("c1", 1, "OPEN", "ACTIVE"), ("c1", 2, "UPD", "ACTIVE"), ("c1", 3, "UPD", "ACTIVE"),
        ("c1", 4, "INACT", "INACTIVE"), ("c1", 5, "UPD", "INACTIVE"),
        ("c2", 3, "OPEN", "ACTIVE"),
        ("c3", 2, "OPEN", "ACTIVE"),  # an opening row does not inactivate
    ]


def test_route_opens_with_the_first_row(spark):
    df = spark.createDataFrame(LOG, "k string, t int, op string, name string, tier string")
    got = log.route(df, ["k"], ["t"], F.col("op"), opening="OPEN", name="action")
    assert sorted((r.k, r.t, r.action) for r in got.collect())[:2] == [("c1", 1, "OPEN"), ("c1", 2, "UPD")]
    assert {r.k for r in got.where("action = 'OPEN'").collect()} == {"c1", "c2", "c3"}


def test_collapse_overlays_the_changes_of_a_day(spark):
    df = spark.createDataFrame(
        [("k", 1, 1, "a", None), ("k", 1, 2, None, "x"), ("k", 1, 3, "", None), ("k", 2, 4, None, None)],
        "k string, day int, seq int, a string, b string",
    )
    got = log.collapse_changes(df, ["k", "day"], ["seq"], ["a", "b"])
    assert sorted(got.collect()) == [("k", 1, "", "x"), ("k", 2, None, None)]


def _cascade_brute(children, parents):
    out = []
    for account in {c[0] for c in children}:
        mine = [c for c in children if c[0] == account]
        user, opened = mine[0][1], min(c[2] for c in mine)
        closes = [c[2] for c in mine if c[3]]
        closed = min(closes) if closes else None
        changes = sorted({p[1] for p in parents if p[0] == user})
        points = {c[2] for c in mine if closed is None or c[2] <= closed}
        points |= {t for t in changes if t > opened and (closed is None or t < closed)}
        points = sorted(points)
        for i, t in enumerate(points):
            out.append((
                account, t, points[i + 1] if i + 1 < len(points) else None,
                sum(c < t for c in changes), sum(c <= t for c in changes),
            ))
    return sorted(out, key=str)


@pytest.mark.parametrize("task", [10**6, 15])
def test_cascade_matches_brute_force(spark, task):
    rnd = random.Random(9)
    children = []
    for _ in range(160):
        user = rnd.choice([1, 1, 1, 2, 3])
        children.append((user * 10 + rnd.randrange(3), user, rnd.randrange(100), rnd.random() < 0.05))
    parents = [(rnd.choice([1, 1, 2, 4]), rnd.randrange(100)) for _ in range(60)]
    got = log.cascade(
        spark.createDataFrame(children, "account int, user int, t int, bye boolean").repartition(3),
        spark.createDataFrame(parents, "user int, t int"),
        "account", "user", "t", F.col("bye"), rows_per_task=task,
    )
    assert sorted((tuple(r) for r in got.collect()), key=str) == _cascade_brute(children, parents)


def _actions(spark, rows):
    from ledgerloom.sources import schemas as layouts

    texts = [n for names in layouts.CUSTOMER_GROUPS.values() for n in names if n != "C_ID"]
    texts += [f"{phone}_{part}" for phone in layouts.PHONES for part in layouts.PHONE_PARTS]
    texts += ["CA_TAX_ST", "CA_NAME"]
    given = spark.createDataFrame(rows, "ActionType string, C_ID long, day string, ACTION_SEQ long, C_TIER string, CA_ID long")
    days = {"ACTION_DAY": F.to_date("day"), "ACTION_AT": F.to_timestamp("day"), "CA_INDEX": F.lit(0), "CA_B_ID": F.lit("1")}
    return given.withColumns(days | {n: F.lit(None).cast("string") for n in texts if n not in given.columns})


CHANGES = [
    (kind, c, f"2020-01-{day:02d}", c * 100 + day, str(day % 3), c)
    for c in (3, 1, 2) for kind, day in (("NEW", 1), ("UPDCUST", 5), ("UPDCUST", 9), ("INACT", 20))
]


def test_customers_are_numbered_as_they_are_replayed(spark):
    from ledgerloom.plans.dimensions import customer_versions

    got = customer_versions(_actions(spark, CHANGES)).orderBy("SK_CustomerID").collect()
    assert [r.SK_CustomerID for r in got] == list(range(12))
    assert [(r.CustomerID, r.EffectiveDate.day) for r in got] == [(c, day) for c in (1, 2, 3) for day in (1, 5, 9, 20)]
    assert [r.Tier for r in got[:4]] == [1, 2, 0, 0] and got[3].Status == "INACTIVE"


def test_accounts_are_numbered_as_they_are_replayed(spark):
    from ledgerloom.plans.dimensions import account_versions, customer_versions

    actions = _actions(spark, CHANGES)
    got = account_versions(actions, customer_versions(actions)).orderBy("SK_AccountID").collect()
    assert [r.SK_AccountID for r in got] == list(range(12))
    assert [(r.AccountID, r.EffectiveDate.day) for r in got] == [(c, day) for c in (1, 2, 3) for day in (1, 5, 9, 20)]
    assert [r.Status for r in got[:4]] == ["ACTIVE"] * 3 + ["INACTIVE"]
