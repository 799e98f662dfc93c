"""Quality messages, checks and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import text
from ledgerloom.catalog.registry import query
from ledgerloom.functions.cleanse import century_before, integer_or_null, money
from ledgerloom.operators import quality
from ledgerloom.session import table


@query("""
SELECT 1 AS batch_id, 'customer' AS message_source, 'Inserted rows' AS message_text,
       'Status' AS message_type, CAST(count(*) AS VARCHAR) AS message_data
FROM customer
""")
def load_status_message(spark: SparkSession, folder: str) -> DataFrame:
    return quality.status_message(table(spark, folder, "customer"), "customer")


@query("""
WITH c AS (
    SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 5 AS VARCHAR) END AS tier,
           DATE '1900-01-01' + CAST(c_custkey * 137 % 50000 AS INT) AS dob
    FROM customer)
SELECT 1 AS batch_id, 'customer' AS message_source, 'Invalid customer tier' AS message_text,
       'Alert' AS message_type, 'C_ID = ' || c_custkey || ', C_TIER = ' || tier AS message_data
FROM c WHERE tier NOT IN ('1', '2', '3')
UNION ALL
SELECT 1, 'customer', 'DOB out of range', 'Alert', 'C_ID = ' || c_custkey || ', C_DOB = ' || CAST(dob AS VARCHAR)
FROM c WHERE dob < DATE '1917-07-07' OR dob > DATE '2017-07-07'
""")
def quality_messages(spark: SparkSession, folder: str) -> DataFrame:
    key, batch_date = F.col("c_custkey"), F.to_date(F.lit("2017-07-07"))
    customers = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(key % 7 != 0, text(key % 5)).alias("tier"),
        F.date_add(F.to_date(F.lit("1900-01-01")), (key * 137 % 50000).cast("int")).alias("dob"),
    )
    tier = quality.check(
        customers, ~integer_or_null("tier").isin(1, 2, 3), "customer", "Invalid customer tier",
        F.concat(F.lit("C_ID = "), text("c_custkey"), F.lit(", C_TIER = "), "tier"),
    )
    dob = quality.check(
        customers, ~F.col("dob").between(century_before(batch_date), batch_date), "customer", "DOB out of range",
        F.concat(F.lit("C_ID = "), text("c_custkey"), F.lit(", C_DOB = "), text("dob")),
    )
    return quality.union_messages(tier, dob)


@query("""
SELECT 1 AS batch_id, 'customer' AS message_source, 'Invalid tax status' AS message_text, 'Alert' AS message_type,
       'C_ID = ' || c_custkey || ', status = ' || coalesce(CAST(code AS VARCHAR), '') AS message_data
FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 4 END AS code FROM customer)
WHERE code IS NULL OR code NOT IN (0, 1, 2)
""")
def domain_check(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.when(key % 9 != 0, key % 4).alias("code")
    )
    return quality.check(
        customers, quality.outside_domain(F.col("code"), (0, 1, 2)), "customer", "Invalid tax status",
        F.concat(F.lit("C_ID = "), text("c_custkey"), F.lit(", status = "), F.coalesce(text("code"), F.lit(""))),
    )


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def duplicate_key_check(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
WITH j AS (SELECT * FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = l_orderkey)
SELECT 'l_partkey' AS column_name, count(*) FILTER (l_partkey IS NULL) AS nulls FROM j
UNION ALL SELECT 'l_shipdate', count(*) FILTER (l_shipdate IS NULL) FROM j
UNION ALL SELECT 'o_custkey', count(*) FILTER (o_custkey IS NULL) FROM j
UNION ALL SELECT 'o_orderdate', count(*) FILTER (o_orderdate IS NULL) FROM j
""")
def null_check(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").where(F.col("o_orderstatus") != "P")
    lines = table(spark, folder, "lineitem").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )
    return quality.null_counts(lines, ["l_partkey", "l_shipdate", "o_custkey", "o_orderdate"])


@query("""
WITH actual(data_set, attribute, value) AS (
    SELECT 'customer', 'rows', CAST(count(*) AS DECIMAL(20, 2)) FROM customer
    UNION ALL SELECT 'customer', 'balance', sum(CAST(c_acctbal AS DECIMAL(18, 2))) FROM customer
    UNION ALL SELECT 'orders', 'rows', count(*) FROM orders
    UNION ALL SELECT 'orders', 'price', sum(CAST(o_totalprice AS DECIMAL(18, 2))) FROM orders
    UNION ALL SELECT 'lineitem', 'rows', count(*) FROM lineitem
    UNION ALL SELECT 'lineitem', 'quantity', sum(CAST(l_quantity AS DECIMAL(18, 2))) FROM lineitem),
expected(data_set, attribute, value) AS (
    SELECT 'customer', 'rows', CAST(count(DISTINCT o_custkey) AS DECIMAL(20, 2)) FROM orders
    UNION ALL SELECT 'customer', 'loyalty', 0
    UNION ALL SELECT 'orders', 'rows', count(DISTINCT l_orderkey) FROM lineitem
    UNION ALL SELECT 'orders', 'price', sum(CAST(o_totalprice AS DECIMAL(18, 2))) FROM orders JOIN customer ON c_custkey = o_custkey
    UNION ALL SELECT 'lineitem', 'rows', count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT e.data_set, e.attribute, CAST(e.value AS DOUBLE) AS expected, CAST(a.value AS DOUBLE) AS actual,
       coalesce(e.value = a.value, FALSE) AS matches
FROM expected e LEFT JOIN actual a ON a.data_set = e.data_set AND a.attribute = e.attribute
""")
def audit_attributes(spark: SparkSession, folder: str) -> DataFrame:
    customer, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem")
    rows = F.count(F.lit(1))
    actual = quality.union_messages(
        quality.long_form(customer, "customer", {"rows": rows, "balance": F.sum(money("c_acctbal"))}),
        quality.long_form(orders, "orders", {"rows": rows, "price": F.sum(money("o_totalprice"))}),
        quality.long_form(lines, "lineitem", {"rows": rows, "quantity": F.sum(money("l_quantity"))}),
    )
    known = orders.join(customer, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    placed = lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    expected = quality.union_messages(
        quality.long_form(orders, "customer", {"rows": F.count_distinct("o_custkey"), "loyalty": F.lit(0)}),
        quality.long_form(lines, "orders", {"rows": F.count_distinct("l_orderkey")}),
        quality.long_form(known, "orders", {"price": F.sum(money("o_totalprice"))}),
        quality.long_form(placed, "lineitem", {"rows": rows}),
    )
    return quality.reconcile(expected, actual).withColumns(
        {c: F.col(c).cast("double") for c in ("expected", "actual")}
    )
