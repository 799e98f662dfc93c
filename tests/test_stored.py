"""Runs that are committed last, tables that take upserts, rejects beside rows, lookups of several dimensions."""

import datetime as dt
import random
from pathlib import Path

import pytest
import raw_batch
from pyspark.sql import functions as F

from ledgerloom.keyed import KeyedTable
from ledgerloom.operators import changelog as log
from ledgerloom.operators import lookup as look
from ledgerloom.operators.upsert import upsert
from ledgerloom.plans import load, staging
from ledgerloom.plans.facts import watch_spans
from ledgerloom.plans.store import Store
from ledgerloom.sources import readers


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


# --- rows and rejects ----------------------------------------------------------------------------


def test_escapes_are_read_as_a_loader_reads_them(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1|a\\|b|c\\\\\n\n2|x\\ny\\t|\\N\n3|\\\\\\|z|\\Nope\n4||\\'q\\\\\\\\|\n")
    got = readers.read_rows(spark, str(tmp_path / "a.txt"), "n INT, t STRING, u STRING", "|")
    assert tuples(got, "n", "t", "u") == [(1, "a|b", "c\\"), (2, "x\ny\t", None), (3, "\\|z", "Nope"), (4, None, "'q\\\\")]
    assert [len(r.rejected) for r in got.orderBy("n").collect()] == [0, 0, 0, 1]  # the last line has a fourth field


def test_what_does_not_fit_is_kept_beside_its_row(spark):
    lines = spark.createDataFrame([("7|2020-01-01|1",), ("x|2020-13-01|yes?",), ("8",), ("9|||extra",), (None,)], "line string")
    casts = {"f": lambda c: c.try_cast("boolean")}
    got = readers.typed_rows(lines.withColumn("tag", F.lit("t")), "line", "n INT, d DATE, f BOOLEAN", "|", casts)
    assert got.columns == ["tag", "n", "d", "f", "rejected"]
    assert tuples(got, "n", "d", "f", "rejected") == sorted([
        (7, dt.date(2020, 1, 1), True, []),
        (None, None, None, [("n", "x"), ("d", "2020-13-01"), ("f", "yes?")]),
        (8, None, None, [("(fields)", "1")]),
        (9, None, None, [("(fields)", "4")]),
        (None, None, None, []),
    ], key=str)


def test_unknown_records_are_kept_and_lines_read_once(spark, tmp_path):
    (tmp_path / "LINES").write_text("AAA001x\nZZZ9\n\nBBB-y\nAAA00qx\n")
    layouts = {"AAA": {"id": (3, 6), "rest": (6, None)}, "BBB": {"x": (4, 5), "id": (3, 4)}}
    lines = readers.read_lines(spark, str(tmp_path / "LINES"))
    routed = readers.routed_fixed_width(lines, "value", layouts, (0, 3), {"AAA": {"id": lambda c: c.try_cast("int")}})
    assert tuples(routed.where("size(rejected) > 0"), "record_kind", "id", "rejected") == [("AAA", "00q", [("id", "00q")])]
    found = readers.read_fixed_width(spark, str(tmp_path / "LINES"), layouts, (0, 3))
    assert tuples(found["unknown"], "unknown_line") == [("",), ("ZZZ9",)]
    assert tuples(found["BBB"], "x", "id") == [("y", "-")]
    assert all("LINES" not in f for kind in found for f in found[kind].inputFiles())


def test_load_reports_what_it_left_out(spark, tmp_path):
    raw = Path(raw_batch.write_batch(tmp_path / "raw"))
    folder = raw / "1" / "Batch1"
    with open(folder / "CashTransaction.txt", "a") as out:
        out.write("101|2012-02-30 10:00:00|ten|in\n")
    with open(folder / "HoldingHistory.txt", "a") as out:
        out.write("5|77|0|1\n")
    store, _ = load.run(spark, str(raw), 1, str(tmp_path / "out"))
    told = store.table("DImessages").where("MessageType = 'Alert'")
    found = {(r.MessageSource, r.MessageText): r.MessageData for r in told.collect()}
    assert found["S_Cash_Balances", "Value does not fit"] in ("CT_DTS = 2012-02-30 10:00:00", "CT_AMT = ten")
    assert found["S_FinWire", "Unknown record type"] == "type = XYZ, lines = 1"
    assert found["DimCompany", "Company without industry or status"].startswith("CIK = 0000000013, PTS = 20090101-120000, INDUSTRY_ID = ??")
    assert found["FactHoldings", "Holding without trade"] == "TradeID = 5, CurrentTradeID = 77"
    assert "AccountID = 555" in str(tuples(told.where("MessageSource = 'FactCashBalances'"), "MessageData"))
    audit = {r.attribute: (r.expected, r.actual, r.matches) for r in store.table("AuditResult").collect()}
    assert audit == {"HR_BROKERS": (2, 2, True), "FW_CMP": (3, 5, False), "T_Records": (4, 4, True)}
    assert found["Audit", "Audit difference"] == "DimCompany.FW_CMP: expected 3.00000, found 5.00000"
    joined = staging.trade_joined(store)
    assert joined.count() == 9 and "rejected" not in joined.columns


# --- commits -------------------------------------------------------------------------------------


def test_a_load_that_fails_leaves_the_tables_of_the_run_before(spark, tmp_path, monkeypatch):
    raw, out = raw_batch.write_batch(tmp_path / "raw"), str(tmp_path / "out")
    assert Store.committed(spark, out) is None
    first, _ = load.run(spark, raw, 1, out)
    before = tuples(first.table("DimBroker"))

    def broken(store):
        store.save("DimBroker", spark.createDataFrame([], first.table("DimBroker").schema))
        raise RuntimeError("half way")

    monkeypatch.setitem(load.STEPS, "Prospect", broken)
    with pytest.raises(RuntimeError, match="half way"):
        load.run(spark, raw, 1, out)
    now = Store.committed(spark, out)
    assert now.run == first.run and tuples(now.table("DimBroker")) == before
    monkeypatch.undo()
    (Path(raw) / "1" / "Batch1" / "HR.csv").write_text("7,1,Ann,Broker,M,314,B1,OFF1,555\n")
    second, _ = load.run(spark, raw, 1, out)
    now = Store.committed(spark, out)
    assert now.run == second.run and now.table("DimBroker").count() == 1 and len(before) == 2


def test_upserts_write_only_the_buckets_they_touch(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(rnd.randrange(300), i, f"f{i}", i % 7) for i in range(900)] + [(None, 901, "n", 1), (None, 902, "m", 2)]
    df = spark.createDataFrame(rows, "k long, seq int, f string, m long").withColumn("l", F.col("f"))
    stored = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["f"], ["l"], ["m"], buckets=8)
    assert stored.read() is None and stored.upsert(df.limit(0), ["seq"]) == []
    stored.upsert(df.where("seq < 700"), ["seq"])
    times = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    touched = stored.upsert(df.where("seq = 700"), ["seq"])
    assert len(touched) == 1 and all(f.stat().st_mtime_ns == t for f, t in times.items())
    new = [f for f in (tmp_path / "t" / "data").rglob("*.parquet") if f not in times]
    assert {f.parent.name for f in new} == {f"bucket={touched[0]}"}
    stored.upsert(df.where("seq > 700"), ["seq"])
    assert tuples(stored.read()) == tuples(upsert(df, ["k"], ["seq"], ["f"], ["l"], ["m"]))


def test_a_write_without_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, 1, 5), (2, 2, 6)], "k int, seq int, m int")
    stored = KeyedTable(spark, str(tmp_path / "t"), ["k"], add=["m"], buckets=2)
    stored.upsert(df, ["seq"])
    monkeypatch.setattr("ledgerloom.commits.record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        stored.upsert(df, ["seq"])
    assert tuples(stored.read(), "k", "m") == [(1, 5), (2, 6)]


# --- lookups and cascade -------------------------------------------------------------------------


@pytest.mark.parametrize("small_rows", [100_000, 0])
def test_several_dimensions_at_once(spark, small_rows):
    rnd = random.Random(9)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    facts = [(i % 40, rnd.choice(["a", "b", None]), rnd.choice([1, 2, 3, None]), rnd.choice([day(rnd.randrange(60)), None]), f"w{i}") for i in range(120)]
    facts += facts[:3]
    fact = spark.createDataFrame(facts, "id int, s string, n int, day date, wide string")
    one = spark.createDataFrame([("a", day(0), day(20), 10), ("a", day(20), None, 11), ("b", day(30), day(40), 12)], "s string, f date, t date, sk int")
    two = spark.createDataFrame([(1, day(5), None, "x"), (2, day(0), day(50), "y")], "num int, f date, t date, tag string")
    got = look.temporal_lookups(
        fact, "day", ["id"], look.Versions(one, ["s"], "f", "t", ["sk"], flat=True), look.Versions(two, {"n": "num"}, "f", "t", {"name": "tag"}), small_rows=small_rows
    )
    want = look.temporal_lookup(fact, one, ["s"], "day", "f", "t", ["sk"])
    want = look.temporal_lookup(want, two, {"n": "num"}, "day", "f", "t", {"name": "tag"})
    assert got.columns == want.columns and tuples(got) == tuples(want)


def test_both_ways_of_cutting_nested_versions_agree(spark):
    rnd = random.Random(3)
    rows = [(k, (s := rnd.randrange(60)), rnd.choice([None, s + rnd.randrange(1, 30)]), i) for i, k in enumerate(rnd.choices("pq", k=60))]
    versions = spark.createDataFrame(rows, "k string, s int, e int, i int").select(
        F.col("k").alias("__k0"), look._moment(F.col("s"), 0).alias("__t"), look._moment(F.col("e"), 0).alias("__end"),
        F.struct(F.lit(0), "i").alias("__tie"), F.struct("i").alias("__row"),
    )

    few, many = (f(versions, ["__k0"]).toDF("k", "s", "e", "tie", "row") for f in (look._disjoint_few, look.disjoint))
    points = [
        {(r.k, p): r.row.i for r in spans.collect() for p in range(r.s.t, min(r.e.t if r.e else 999, 100))} for spans in (few, many)
    ]
    assert points[0] == points[1] and len(points[0]) > 100


def test_references_by_number_and_by_name_share_one_scan(spark):
    facts = spark.createDataFrame([(1, "01", 5), (2, "Ann ", 5), (3, "Ann", 9), (4, "0x", 5), (5, None, 5), (6, "None", 5)], "id int, ref string, day int")
    dim = spark.createDataFrame([(1, "Ann", 0, 6), (2, "Ann", 4, None), (3, None, 0, None)], "num int, name string, f int, t int")
    got = look.id_or_name_lookup(facts, dim, "ref", "num", "name", {"sk": "num"}, at="day", start="f", end="t", tie=["num"], how="left")
    assert tuples(got, "id", "sk") == [(1, 1), (2, 2), (3, 2), (4, None), (5, None), (6, None)]


def test_inherited_changes_match_all_pairs(spark):
    rnd = random.Random(8)
    lives = [(c, rnd.choice("ppq"), (o := rnd.randrange(30)), rnd.choice([None, o + rnd.randrange(15)])) for c in range(60)] + [(99, "none", 1, 5), (98, None, 1, 5)]
    changes = sorted({(rnd.choice("pq"), rnd.randrange(40)) for _ in range(50)})
    got = log.inherited_changes(
        spark.createDataFrame(lives, "c int, p string, o int, z int"),
        spark.createDataFrame([(p, t, f"{p}{t}") for p, t in changes], "p string, at int, v string"), "p", "at", "o", "z",
    )
    want = [(c, p, o, z, t, f"{p}{t}") for c, p, o, z in lives for q, t in changes if p == q and o < t and (z is None or t < z)]
    assert tuples(got, "c", "p", "o", "z", "at", "v") == sorted(want, key=str)


def test_a_watch_placed_again_is_not_removed(spark):
    at = lambda h: dt.datetime(2020, 1, 1, h)
    rows = [(1, "A", at(1), "ACTV"), (1, "A", at(2), "CNCL"), (1, "A", at(3), "ACTV"), (2, "A", at(1), "ACTV"), (2, "A", at(2), "CNCL"), (3, "A", at(5), "CNCL")]
    got = watch_spans(spark.createDataFrame(rows, "W_C_ID int, W_S_SYMB string, W_DTS timestamp, W_ACTION string"))
    assert tuples(got, "W_C_ID", "placed", "removed") == [(1, at(1), None), (2, at(1), at(2)), (3, None, at(5))]
