"""Joins: plain, star, temporal, by id or name, by derived key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import ORDER_VERSIONS, amount, order_snapshots, text
from ledgerloom.catalog.registry import query
from ledgerloom.functions.cleanse import clock_text, date_key
from ledgerloom.operators import lookup as look
from ledgerloom.operators.scd import scd2
from ledgerloom.session import table
from ledgerloom.sinks import stage

#: Rows at which the queries of the large way cut a key.
SEGMENT = 30


@query("""
SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus, l_linestatus,
       CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE) AS price
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
""")
def trade_history_join(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus",
        amount("l_extendedprice").alias("price"),
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey")


@query("""
SELECT o_orderkey, c_mktsegment, n_name, r_name
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
     JOIN region ON r_regionkey = n_regionkey
""")
def star_lookup(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return look.star_lookup(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey"),
        (customers, "o_custkey", "c_custkey"),
        (table(spark, folder, "nation"), "c_nationkey", "n_nationkey"),
        (table(spark, folder, "region"), "n_regionkey", "r_regionkey"),
    ).select("o_orderkey", "c_mktsegment", "n_name", "r_name")


ASOF_DIM_LOOKUP = f"""
WITH ov AS (
    SELECT o_custkey, o_orderkey AS version_key, o_orderstatus AS version_status, effective,
           coalesce(lead(effective) OVER (PARTITION BY o_custkey ORDER BY effective), DATE '9999-12-31') AS end_date
    FROM ({ORDER_VERSIONS}))
SELECT l_orderkey, l_linenumber, l_partkey, o.o_custkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_date,
       version_key, version_status
FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey
     LEFT JOIN ov ON ov.o_custkey = o.o_custkey AND effective <= CAST(l_shipdate AS DATE)
                 AND CAST(l_shipdate AS DATE) < end_date
"""


def _asof(spark: SparkSession, folder: str, **options) -> DataFrame:
    versions = scd2(order_snapshots(spark, folder), ["o_custkey"], "effective", ["o_orderkey"])
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("ship_date"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .drop("o_orderkey")
    )
    # both are read more than once; versions made by scd2 do not overlap
    found = look.temporal_lookup(
        stage(lines, "lines"), stage(versions, "versions"), ["o_custkey"], "ship_date", "effective", "end_date",
        {"version_key": "o_orderkey", "version_status": "o_orderstatus"}, flat=True, **options,
    )
    return found.withColumn("ship_date", text("ship_date"))


@query(ASOF_DIM_LOOKUP)
def asof_dim_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return _asof(spark, folder)


@query(ASOF_DIM_LOOKUP)
def asof_dim_lookup_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The way of large dimensions, with every key cut into segments."""
    return _asof(spark, folder, small_rows=0, rows_per_task=SEGMENT)


@query("""
WITH v AS (SELECT o_custkey, o_orderkey AS version_key, CAST(o_orderdate AS DATE) AS s,
                  CAST(o_orderdate AS DATE) + CAST(o_orderkey * 37 % 900 AS INTEGER) AS e FROM orders),
     found AS (SELECT f.o_orderkey, f.o_custkey, version_key,
                      row_number() OVER (PARTITION BY f.o_orderkey ORDER BY s DESC NULLS LAST, version_key DESC) AS nth
               FROM orders f LEFT JOIN v ON v.o_custkey = f.o_custkey
                    AND s <= CAST(f.o_orderdate AS DATE) + 200 AND CAST(f.o_orderdate AS DATE) + 200 < e)
SELECT o_orderkey, o_custkey, version_key FROM found WHERE nth = 1
""")
def asof_overlap_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Versions that overlap and nest: the one that started last of those still valid."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("s"))
    versions = orders.select(
        F.col("o_orderkey").alias("version_key"), "o_custkey", "s",
        F.date_add("s", (F.col("o_orderkey") * 37 % 900).cast("int")).alias("e"),
    )
    facts = orders.withColumn("at", F.date_add("s", 200)).drop("s")
    found = look.temporal_lookup(facts, versions, ["o_custkey"], "at", "s", "e", ["version_key"], tie=["version_key"])
    return found.select("o_orderkey", "o_custkey", "version_key")


@query("""
WITH u AS (SELECT user_id, CAST(min(ts) AS DATE) AS start_date, CAST(min(ts) AS DATE) + 6 AS end_date
           FROM events GROUP BY user_id)
SELECT event_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
       CASE WHEN CAST(ts AS DATE) BETWEEN start_date AND end_date THEN u.user_id END AS user_key
FROM events e JOIN u ON u.user_id = e.user_id
""")
def validity_nulling(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", "event_type", "user_id", F.to_date("ts").alias("day")
    )
    users = (
        events.groupBy("user_id")
        .agg(F.min("day").alias("start_date"))
        .withColumn("end_date", F.date_add("start_date", 6))
    )
    found = look.temporal_lookup(
        events, users, ["user_id"], "day", "start_date", "end_date", {"user_key": "user_id"}, closed=True
    )
    return found.select("event_id", "event_type", text("day").alias("day"), "user_key")


@query("""
SELECT o_orderkey, c_custkey, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey
""")
def id_or_name_lookup(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    number = text("o_custkey")
    name = F.concat(F.lit("Customer#"), F.lpad(number, 9, "0"), F.lit("  "))
    facts = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 2 == 0, F.lpad(number, 10, "0")).otherwise(name).alias("ref"),
    )
    dim = customers.select(
        "c_custkey", "c_mktsegment", F.col("c_custkey").alias("number"), F.col("c_name").alias("name")
    )
    return look.id_or_name_lookup(
        facts, dim, "ref", "number", "name", ["c_custkey", "c_mktsegment"]
    ).select("o_orderkey", "c_custkey", "c_mktsegment")


@query("""
WITH v AS (
    SELECT s_suppkey AS id, 'Name ' || s_suppkey // 2 AS name, DATE '1992-01-01' + CAST(s_suppkey % 2 * 700 AS INT) AS start_date,
           CASE WHEN s_suppkey % 2 = 0 THEN DATE '1996-06-01' END AS end_date FROM supplier),
f AS (SELECT o_orderkey, o_custkey % (SELECT count(*) + 2 FROM supplier) AS ref, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT o_orderkey, max(v.id) AS supplier FROM f LEFT JOIN v
    ON v.start_date <= day AND (v.end_date IS NULL OR day < v.end_date)
   AND CASE WHEN o_orderkey % 2 = 0 THEN v.id = ref ELSE v.name = 'Name ' || ref // 2 END
GROUP BY o_orderkey
""")
def id_or_name_asof(spark: SparkSession, folder: str) -> DataFrame:
    """Two suppliers share each name, with overlapping times: the one that started last counts."""
    suppliers = table(spark, folder, "supplier")
    number = F.col("s_suppkey")
    versions = suppliers.select(
        number.alias("supplier"), F.concat(F.lit("Name "), F.floor(number / 2).cast("string")).alias("name"),
        F.date_add(F.lit("1992-01-01").cast("date"), (number % 2 * 700).cast("int")).alias("start_date"),
        F.when(number % 2 == 0, F.lit("1996-06-01").cast("date")).alias("end_date"),
    )
    ref = F.col("o_custkey") % (suppliers.count() + 2)
    facts = table(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lpad(text(ref), 10, "0")).otherwise(
            F.concat(F.lit("Name "), F.floor(ref / 2).cast("string"), F.lit(" "))
        ).alias("ref"),
    )
    found = look.id_or_name_lookup(
        facts, versions, "ref", "supplier", "name", ["supplier"], at="day", start="start_date", end="end_date", tie=["supplier"], how="left"
    )
    return found.select("o_orderkey", "supplier")


@query("""
SELECT o_orderkey, o_custkey, coalesce(s_suppkey, -1) AS supplier_key
FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey
""")
def lookup_default(spark: SparkSession, folder: str) -> DataFrame:
    return look.lookup_default(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey"),
        table(spark, folder, "supplier").select("s_suppkey"),
        {"o_custkey": "s_suppkey"}, "s_suppkey", "supplier_key",
    )


@query("""
WITH s AS (SELECT upper(n_name || CAST(s_suppkey % 10 AS VARCHAR)) AS k, s_suppkey, s_name, s_acctbal,
                  row_number() OVER (PARTITION BY n_name, s_suppkey % 10 ORDER BY s_suppkey) AS nth
           FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT c_custkey, n_name, s_suppkey, s_name, CAST(CAST(s_acctbal AS DECIMAL(18, 2)) AS DOUBLE) AS s_acctbal
FROM customer JOIN nation ON n_nationkey = c_nationkey
     LEFT JOIN s ON s.k = upper(n_name || CAST(c_custkey % 10 AS VARCHAR)) AND nth = 1 AND c_acctbal > 0
""")
def derived_key_enrich(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customers = look.star_lookup(
        table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal"),
        (nations, "c_nationkey", "n_nationkey"),
    )
    suppliers = look.star_lookup(
        table(spark, folder, "supplier").withColumn("s_acctbal", amount("s_acctbal")),
        (nations, "s_nationkey", "n_nationkey"),
    )
    return look.enrich_on(
        customers, suppliers,
        look.derived_key(["n_name", text(F.col("c_custkey") % 10)]),
        look.derived_key(["n_name", text(F.col("s_suppkey") % 10)]),
        F.col("c_acctbal") > 0,
        ["s_suppkey", "s_name", "s_acctbal"],
        ["s_suppkey"],
    ).select("c_custkey", "n_name", "s_suppkey", "s_name", "s_acctbal")


@query("""
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INT) AS date_key, dayofmonth(ts) AS day_number,
       CAST(extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60
            + CAST(floor(extract(second FROM ts)) AS BIGINT) AS BIGINT) AS time_key
FROM events
""")
def date_time_keys(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts")
    dates = events.select(F.to_date("ts").alias("day")).distinct().select(
        "day", F.struct(date_key("day").alias("date_key"), F.dayofmonth("day").alias("day_number")).alias("keys")
    )
    clock = spark.range(24 * 60 * 60).select(
        F.col("id").alias("second"),
        clock_text("id").alias("value"),
    )
    return look.date_time_keys(
        events, "ts", dates, "day", "keys", clock, "value", "second", date_name="keys"
    ).select("event_id", "keys.date_key", "keys.day_number", "time_key")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, a.n_name AS line_name, b.n_name AS quantity_name
FROM lineitem LEFT JOIN nation a ON a.n_nationkey = l_linenumber
     LEFT JOIN nation b ON b.n_nationkey = CAST(l_quantity AS INT)
""")
def code_lookup_twice(spark: SparkSession, folder: str) -> DataFrame:
    codes = table(spark, folder, "nation")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("quantity")
    )
    once = look.code_lookup(lines, codes, "l_linenumber", "n_nationkey", {"line_name": "n_name"})
    return look.code_lookup(once, codes, "quantity", "n_nationkey", {"quantity_name": "n_name"}).drop("quantity")


@query("""
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def merge_semi_join(spark: SparkSession, folder: str) -> DataFrame:
    urgent = table(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return look.semi_join(customers, urgent, "c_custkey", "o_custkey")


@query("""
SELECT c_custkey, c_mktsegment, o_orderkey, o_orderstatus
FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT'
""")
def merge_inner_join(spark: SparkSession, folder: str) -> DataFrame:
    urgent = table(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return look.merge_join(customers, urgent, "c_custkey", "o_custkey").select(
        "c_custkey", "c_mktsegment", "o_orderkey", "o_orderstatus"
    )
