"""Type 2 versions, version numbers, surrogate keys and sorted positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import ORDER_VERSIONS, order_snapshots, order_versions, text
from ledgerloom.catalog.registry import query
from ledgerloom.functions.cleanse import MONEY, money
from ledgerloom.operators.ordered import UNCUT, ordered_scan, sort_position
from ledgerloom.operators.ordered import surrogate_key as number_all
from ledgerloom.operators.ordered import version_number as number_versions
from ledgerloom.operators.scd import scd2
from ledgerloom.session import table


@query(f"""
WITH ov AS ({ORDER_VERSIONS}),
     closed AS (SELECT *, lead(effective) OVER (PARTITION BY o_custkey ORDER BY effective) AS next FROM ov)
SELECT o_custkey, o_orderkey, o_orderstatus, CAST(effective AS VARCHAR) AS effective,
       CAST(coalesce(next, DATE '9999-12-31') AS VARCHAR) AS end_date, next IS NULL AS is_current
FROM closed
""")
def scd2_build(spark: SparkSession, folder: str) -> DataFrame:
    versions = scd2(order_snapshots(spark, folder), ["o_custkey"], "effective", ["o_orderkey"])
    return versions.select(
        "o_custkey", "o_orderkey", "o_orderstatus",
        text("effective").alias("effective"), text("end_date").alias("end_date"), "is_current",
    )


@query(f"""
SELECT o_custkey, o_orderkey, CAST(effective AS VARCHAR) AS effective,
       row_number() OVER (PARTITION BY o_custkey ORDER BY effective) AS version
FROM ({ORDER_VERSIONS})
""")
def version_number(spark: SparkSession, folder: str) -> DataFrame:
    # One row per customer and day, so a customer's rows always fit one task.
    versions = number_versions(
        order_versions(spark, folder), ["o_custkey"], ["effective"], cuts=UNCUT
    )
    return versions.select("o_custkey", "o_orderkey", text("effective").alias("effective"), "version")


@query("""
SELECT p_partkey, p_brand, row_number() OVER (ORDER BY p_brand, p_partkey) AS part_sk FROM part
""")
def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    return number_all(parts, ["p_brand", "p_partkey"], "part_sk")


@query("""
SELECT c_custkey, balance_text, row_number() OVER (ORDER BY balance_text, c_custkey) AS position
FROM (SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR) AS balance_text FROM customer)
""")
def sort_by_field_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select(
        "c_custkey", text(money("c_acctbal")).alias("balance_text")
    )
    return sort_position(rows, F.col("balance_text"), ["c_custkey"])


RUNNING_BALANCE = """
WITH days AS (
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS day,
           sum(CASE WHEN o_orderstatus = 'F' THEN -CAST(o_totalprice AS DECIMAL(18, 2))
                    ELSE CAST(o_totalprice AS DECIMAL(18, 2)) END) AS net
    FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE))
SELECT o_custkey, CAST(day AS VARCHAR) AS day, CAST(CAST(net AS DECIMAL(18, 2)) AS DOUBLE) AS net,
       CAST(CAST(sum(net) OVER (PARTITION BY o_custkey ORDER BY day) AS DECIMAL(18, 2)) AS DOUBLE) AS balance
FROM days
"""


def _balances(spark: SparkSession, folder: str, **scan) -> DataFrame:
    price = money("o_totalprice")
    days = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", F.to_date("o_orderdate").alias("day"))
        .agg(F.sum(F.when(F.col("o_orderstatus") == "F", -price).otherwise(price)).alias("net"))
    )
    balances = ordered_scan(days, ["o_custkey"], ["day"], total={"balance": "net"}, **scan)
    return balances.select(
        "o_custkey", text("day").alias("day"),
        F.col("net").cast(MONEY).cast("double").alias("net"),
        F.col("balance").cast(MONEY).cast("double").alias("balance"),
    )


@query(RUNNING_BALANCE)
def running_balance(spark: SparkSession, folder: str) -> DataFrame:
    return _balances(spark, folder, cuts=UNCUT)


@query(RUNNING_BALANCE)
def running_balance_segmented(spark: SparkSession, folder: str) -> DataFrame:
    """The way of large keys: every key of more than four days is cut."""
    return _balances(spark, folder, rows_per_task=4)
