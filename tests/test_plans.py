"""Physical plans: what must and must not be in them."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from ledgerloom.catalog import QUERIES

FOLDER = "/root/testdata/sf0.01"

# Queries made of columns and filters only.
NO_SHUFFLE = [
    "phone_format", "gender_clean", "low_grade_flag", "string_functions", "date_functions", "safe_casts",
    "null_handling", "quality_messages", "domain_check", "scan_delimited", "scan_fixed_width_routed",
    "tolerant_decode", "split_join_roundtrip",
]
# Keyed aggregates: combined before their one shuffle.
ONE_SHUFFLE = [
    "upsert_additive", "upsert_first_last", "upsert_second_sighting", "watch_open_close", "trade_lifecycle",
    "duplicate_key_check", "customer_replay", "account_replay", "changelog_group",
]


def plan(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES[name](spark, FOLDER).explain()
    return out.getvalue()


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_columns_do_not_shuffle(spark, name):
    text = plan(spark, name)
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("name", ONE_SHUFFLE)
def test_keyed_work_shuffles_once(spark, name):
    text = plan(spark, name)
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_" in text or "Window" in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(NO_SHUFFLE)))
def test_no_python_and_no_pairs(spark, name):
    text = plan(spark, name)
    for bad in ("Python", "Pandas", "Cartesian", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "merge_semi_join")
    assert "EqualTo(o_orderpriority,1-URGENT)" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in text
    text = plan(spark, "watch_open_close")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_small_dimension_leaves_the_facts_where_they_are(spark):
    text = plan(spark, "validity_nulling")
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text


def test_replay_is_one_pass(spark):
    text = plan(spark, "customer_replay")
    assert text.count("Window [") == 1 and text.count("Sort [") == 1


def test_written_files_are_packed(spark, tmp_path):
    from ledgerloom import sinks
    from ledgerloom.catalog.batch_files import write_batch

    write_batch(spark, "/root/testdata/sf0.001", f"{tmp_path}/raw/")
    parts = [p for name in ("DailyMarket.txt", "FINWIRE1994Q1", "CustomerMgmt.xml") for p in (tmp_path / "raw" / name).glob("part-*")]
    assert parts and all(p.suffix == ".gz" for p in parts)
    held, rest = sinks.divide(spark.range(10), F.col("id") < 7, "packed")
    assert (held.count(), rest.count()) == (7, 3) and all(".zstd." in f for f in held.inputFiles())


def test_cash_is_shuffled_once_unless_an_account_is_large(spark):
    from decimal import Decimal

    from ledgerloom.plans.facts import daily_balances

    rows = [(i % 7, f"2020-01-{1 + i % 9:02d} 10:00:00", Decimal(i)) for i in range(400)]
    cash = spark.createDataFrame(rows, "CT_CA_ID bigint, at string, CT_AMT decimal(10, 2)").withColumn("CT_DTS", F.to_timestamp("at"))
    one, two = daily_balances(cash), daily_balances(cash, rows_per_task=20)
    shuffles = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (one, two)]
    assert shuffles == [1, 2]
    assert sorted(one.collect()) == sorted(two.collect()) and one.count() == 63


def test_target_and_unmatched_rows_are_written_once(spark, tmp_path):
    from ledgerloom.plans.store import Store

    store = Store(spark, str(tmp_path))
    rows = spark.range(10).select(F.col("id").alias("SK_CustomerID"), F.when(F.col("id") < 7, F.col("id")).alias("SK_AccountID"))
    rows = rows.withColumns({"SK_DateID": F.lit(1), "Cash": F.lit("2.50"), "BatchID": F.lit(1)})
    kept = store.save_matched("FactCashBalances", rows, F.col("SK_AccountID").isNotNull(), "Balance without account", "SK_CustomerID", "SK_AccountID")
    assert kept.columns == ["SK_CustomerID", "SK_AccountID", "SK_DateID", "Cash", "BatchID"]
    assert sorted(r.SK_AccountID for r in Store(spark, str(tmp_path), run=store.run).table("FactCashBalances").collect()) == list(range(7))
    told = sorted(r.message_data for m in store.messages for r in m.collect())
    assert told == ["7"] + [f"SK_CustomerID = {i}, SK_AccountID = null" for i in (7, 8, 9)]
    none = store.save_matched("FactCashBalances", rows.where("false"), F.lit(True), "Balance without account")
    assert none.count() == 0


def test_versions_are_made_and_numbered_in_one_shuffle(spark):
    from ledgerloom.operators.ordered import surrogate_key, together
    from ledgerloom.operators.scd import scd2

    rows = spark.createDataFrame([(i % 97, i % 13, i) for i in range(3000)], "k long, day int, seq int").withColumn(
        "eff", F.date_add(F.lit("2020-01-01").cast("date"), F.col("day"))
    )
    placed = together(rows, ["k"], ranged=True)
    versions = scd2(placed, ["k"], "eff", ["seq"])
    text = versions._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in text
    got = surrogate_key(versions, ["k", "eff"], "sk", ranged=True)
    plain = surrogate_key(scd2(rows, ["k"], "eff", ["seq"]), ["k", "eff"], "sk")
    assert got.orderBy("sk").collect() == plain.orderBy("sk").collect() and got.count() == 97 * 13
    assert together(rows, ["k"], ranged=True, rows_per_task=20) is None
