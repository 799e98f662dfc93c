"""Inputs that several demonstration queries share, and the same inputs as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.cleanse import money
from ledgerloom.operators.changelog import route
from ledgerloom.operators.scd import latest_per
from ledgerloom.session import table


def amount(value: Column | str) -> Column:
    """Money rounded to cents, as a double for output."""
    return money(value).cast("double")


def text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def events_with_k(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the integer ``k`` of their properties."""
    return table(spark, folder, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    ).drop("props")


EVENTS_WITH_K = "SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"


def tier_change(k: Column) -> Column:
    """Null is unchanged, blank is cleared."""
    return F.when(k % 3 == 0, F.lit(None)).when(k % 7 == 0, F.lit("")).otherwise((k % 5).cast("string"))


TIER_CHANGE = "CASE WHEN k % 3 = 0 THEN NULL WHEN k % 7 = 0 THEN '' ELSE CAST(k % 5 AS VARCHAR) END"


def raw_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as INACT or UPD with a change of tier; the first of a user is not yet told apart."""
    return events_with_k(spark, folder).select(
        "event_id", "ts", "user_id", tier_change(F.col("k")).alias("tier"),
        F.when(F.col("event_type") == "error", "INACT").otherwise("UPD").alias("op"),
    )


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a customer change log: NEW, INACT or UPD, with a change of tier."""
    return route(raw_changes(spark, folder), ["user_id"], ["ts", "event_id"], F.col("op"))


CHANGE_LOG = f"""
SELECT event_id, ts, user_id, event_type, {TIER_CHANGE} AS tier,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 'NEW'
            WHEN event_type = 'error' THEN 'INACT' ELSE 'UPD' END AS op
FROM ({EVENTS_WITH_K})
"""


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Events as an account change log: two accounts per user."""
    return events_with_k(spark, folder).select(
        (F.col("user_id") * 2 + F.col("k") % 2).alias("account_id"),
        "user_id", "event_id", "ts", "event_type", "k",
        tier_change(F.col("k")).alias("tier"),
    )


ACCOUNTS = f"""
SELECT user_id * 2 + k % 2 AS account_id, user_id, event_id, ts, event_type, k, {TIER_CHANGE} AS tier
FROM ({EVENTS_WITH_K})
"""


def order_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_custkey",
        F.to_date("o_orderdate").alias("effective"),
        "o_orderkey",
        "o_orderstatus",
    )


def order_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as versions of their customer: the last order of each customer and day."""
    return latest_per(order_snapshots(spark, folder), ["o_custkey", "effective"], ["o_orderkey"])


ORDER_VERSIONS = """
SELECT o_custkey, effective, o_orderkey, o_orderstatus
FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS effective, o_orderkey, o_orderstatus,
             row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                                ORDER BY o_orderkey DESC) AS back
      FROM orders)
WHERE back = 1
"""
