"""What may be gathered on the driver for a join: by rows counted, not by the size of packed files."""

import pytest
import raw_batch
from pyspark.sql import functions as F

from ledgerloom import sinks
from ledgerloom.operators import quality
from ledgerloom.plans import load, staging
from ledgerloom.plans.store import Store
from ledgerloom.session import counted_broadcasts
from ledgerloom.sinks import stage

LIMITS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def ran(df):
    """The plan that all rows were made by."""
    made = df.agg(*[F.max(c) for c in df.columns])
    made.collect()
    return made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def packed(spark, rows):
    """A table whose file is far smaller than its rows."""
    texts = [F.lit(str(i) * 100).alias(f"text{i}") for i in range(4)]
    return stage(spark.range(rows).select("id", *texts), "packed", codec="zstd")


def joined(spark, rows):
    left = stage(spark.range(1_500_000).select("id", F.lit(1).alias("one")), "left")
    kept = packed(spark, rows).groupBy("id").agg(F.min_by(F.struct("text0", "text1"), "text2").alias("kept"))
    return left.join(kept, "id", "left").select("one", F.length("kept.text0").alias("n"))


def test_a_packed_table_is_not_broadcast_by_the_size_of_its_file(spark):
    before = [spark.conf.get(name, None) for name in LIMITS]
    assert "BroadcastHashJoin" in ran(joined(spark, 200_000))  # 80 MB of rows
    with counted_broadcasts(spark):
        assert "BroadcastHashJoin" not in ran(joined(spark, 200_000))
        assert "BroadcastHashJoin" in ran(joined(spark, 20))
    assert [spark.conf.get(name, None) for name in LIMITS] == before


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return raw_batch.write_batch(tmp_path_factory.mktemp("broadcasts") / "raw")


def test_the_steps_of_a_load_broadcast_by_rows_counted(spark, tmp_path, raw, monkeypatch):
    before, plans = [spark.conf.get(name, None) for name in LIMITS], {}

    def step(store):
        plans["packed"] = ran(joined(spark, 200_000))
        trades = store.table("S_Trade").select("T_ID", "T_ST_ID")
        plans["codes"] = ran(trades.join(store.reference("StatusType"), F.col("T_ST_ID") == F.col("ST_ID"), "left"))
        store.rows["StatusType"] = 100_001
        plans["many codes"] = store.reference("StatusType")._jdf.queryExecution().analyzed().toString()
        raise InterruptedError

    monkeypatch.setattr(load, "STEPS", {"probe": step})
    with pytest.raises(InterruptedError):
        load.run(spark, raw, 1, str(tmp_path / "out"))
    assert "BroadcastHashJoin" not in plans["packed"]
    assert "BroadcastHashJoin" in plans["codes"] and "SortMergeJoin" not in plans["codes"] and "ResolvedHint" not in plans["many codes"]
    assert [spark.conf.get(name, None) for name in LIMITS] == before


def test_neither_trades_nor_their_history_are_broadcast(spark, tmp_path, raw):
    store, _ = load.run(spark, raw, 1, str(tmp_path / "out"))
    plan = ran(staging.trade_joined(store))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_messages_are_written_a_few_plans_at_a_time_with_one_time(spark, tmp_path, monkeypatch):
    store, plans, append = Store(spark, str(tmp_path / "out")), [], sinks.append
    store.start_over()
    store.report(*[quality.counted_message(spark, i, f"table {i}") for i in range(14)])
    monkeypatch.setattr(sinks, "append", lambda df, *rest: (plans.append(df._jdf.queryExecution().analyzed().toString().count("Range")), append(df, *rest)))
    store.flush()
    found = store.table("DImessages").collect()
    assert sum(plans) == 14 and max(plans) <= 6
    assert sorted(r.MessageSource for r in found) == sorted(f"table {i}" for i in range(14)) and len({r[0] for r in found}) == 1
