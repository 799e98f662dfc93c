"""Keyed upserts, status pivots and updates from a join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import EVENTS_WITH_K, amount, events_with_k, text
from ledgerloom.catalog.registry import query
from ledgerloom.functions.cleanse import MONEY, to_decimal
from ledgerloom.keyed import KeyedTable
from ledgerloom.operators import upsert as ups
from ledgerloom.operators.scd import latest_per
from ledgerloom.session import scratch_path, table


@query("""
SELECT o_custkey, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_date,
       CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS DOUBLE) AS cash
FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey
""")
def upsert_additive(spark: SparkSession, folder: str) -> DataFrame:
    rows = (
        table(spark, folder, "orders")
        .where(F.col("o_orderstatus") != "P")
        .select(
            "o_custkey", "o_orderkey", "o_orderdate",
            F.to_date("o_orderdate").alias("first_date"),
            to_decimal(text("o_totalprice"), 18, 2).alias("cash"),
        )
    )
    merged = ups.upsert(
        rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], first=["first_date"], add=["cash"]
    )
    return merged.select(
        "o_custkey", text("first_date").alias("first_date"),
        F.col("cash").cast(MONEY).cast("double").alias("cash"),
    )


@query("""
WITH ranked AS (
    SELECT user_id, event_type, value,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS front,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back
    FROM events)
SELECT user_id, max(CASE WHEN front = 1 THEN event_type END) AS first_type,
       CAST(max(CASE WHEN back = 1 THEN CAST(value AS DECIMAL(18, 2)) END) AS DOUBLE) AS last_value
FROM ranked GROUP BY user_id
""")
def upsert_first_last(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        "user_id", "ts", "event_id",
        F.col("event_type").alias("first_type"), amount("value").alias("last_value"),
    )
    return ups.upsert(
        rows, ["user_id"], ["ts", "event_id"], first=["first_type"], last=["last_value"]
    )


@query("""
WITH ranked AS (
    SELECT user_id, event_type, value,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS front,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back
    FROM events)
SELECT user_id, max(CASE WHEN front = 1 THEN event_type END) AS first_type, max(CASE WHEN back = 1 THEN event_type END) AS last_type,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total
FROM ranked GROUP BY user_id
""")
def upsert_into_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """All events in three upserts into one stored table, by their time."""
    events = table(spark, folder, "events").select(
        "user_id", "ts", "event_id", F.col("event_type").alias("first_type"), F.col("event_type").alias("last_type"),
        to_decimal(text("value"), 18, 2).alias("total"),
    )
    stored = KeyedTable(spark, scratch_path(spark, "keyed"), ["user_id"], ["first_type"], ["last_type"], ["total"], buckets=16)
    start, end = events.agg(F.min("ts"), F.max("ts")).first()
    first, second = (start + (end - start) * share for share in (0.5, 0.9)) if start else (None, None)
    for part in (F.col("ts") < F.lit(first), (F.col("ts") >= F.lit(first)) & (F.col("ts") < F.lit(second)), F.col("ts") >= F.lit(second)):
        stored.upsert(events.where(part), ["ts", "event_id"])
    rows = stored.read()
    rows = events.select("user_id", "first_type", "last_type", "total").limit(0) if rows is None else rows
    return rows.select("user_id", "first_type", "last_type", F.col("total").cast(MONEY).cast("double").alias("total"))


@query("""
SELECT user_id, event_type, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS placed,
       CASE WHEN count(*) > 1 THEN CAST(CAST(max(ts) AS DATE) AS VARCHAR) END AS removed
FROM events GROUP BY user_id, event_type
""")
def upsert_second_sighting(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        "user_id", "event_type", "ts", "event_id", F.to_date("ts").alias("day")
    )
    seen = ups.second_sighting(
        rows, ["user_id", "event_type"], ["ts", "event_id"], "day", "placed", "removed"
    )
    return seen.select(
        "user_id", "event_type", text("placed").alias("placed"), text("removed").alias("removed")
    )


@query("""
SELECT user_id, CAST(min(CASE WHEN event_type = 'view' THEN ts END) AS VARCHAR) AS placed,
       CAST(max(CASE WHEN event_type = 'error' THEN ts END) AS VARCHAR) AS removed
FROM events GROUP BY user_id
""")
def watch_open_close(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    watches = ups.open_close(
        table(spark, folder, "events"), ["user_id"], "ts",
        opened={"placed": kind == "view"}, closed={"removed": kind == "error"},
    )
    return watches.select("user_id", text("placed").alias("placed"), text("removed").alias("removed"))


@query(f"""
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
       CAST(min(CASE WHEN event_type = 'signup' OR (event_type = 'view' AND k % 2 = 0)
                     THEN ts END) AS VARCHAR) AS created,
       CAST(max(CASE WHEN event_type IN ('purchase', 'error') THEN ts END) AS VARCHAR) AS closed
FROM ({EVENTS_WITH_K}) GROUP BY user_id, CAST(ts AS DATE)
""")
def trade_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    trades = ups.open_close(
        events_with_k(spark, folder).withColumn("day", F.to_date("ts")), ["user_id", "day"], "ts",
        opened={"created": (kind == "signup") | ((kind == "view") & (F.col("k") % 2 == 0))},
        closed={"closed": kind.isin("purchase", "error")},
    )
    return trades.select("user_id", *[text(c).alias(c) for c in ("day", "created", "closed")])


@query("""
WITH last_order AS (
    SELECT o_custkey, o_orderstatus, o_totalprice,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS back
    FROM orders)
SELECT c_custkey, c_mktsegment,
       CAST(CAST(CASE WHEN o.o_custkey IS NOT NULL THEN o.o_totalprice ELSE c_acctbal END
                 AS DECIMAL(18, 2)) AS DOUBLE) AS balance
FROM customer LEFT JOIN last_order o ON o.o_custkey = c_custkey AND back = 1 AND o.o_orderstatus = 'F'
""")
def update_from_join(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_mktsegment", F.col("c_acctbal").alias("balance")
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey", "o_orderstatus",
        F.col("o_totalprice").alias("balance"),
    )
    last = latest_per(orders, ["c_custkey"], ["o_orderdate", "o_orderkey"])
    updated = ups.update_from(
        customers, last.where(F.col("o_orderstatus") == "F"), ["c_custkey"], ["balance"]
    )
    return updated.withColumn("balance", amount("balance"))
