"""Column rules: cleaning, typing, text and date functions, the nameplate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import EVENTS_WITH_K, amount, events_with_k, text
from ledgerloom.catalog.registry import query
from ledgerloom.functions import cleanse
from ledgerloom.functions.rules import ENRICHMENT_RULES, PROSPECT_RULES, NameplateRules, nameplate
from ledgerloom.session import table


def _measures(spark: SparkSession, folder: str) -> DataFrame:
    """Seven prospect measures per customer; some are null, some zero."""
    spend = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.sum(cleanse.money("o_totalprice")).cast("double").alias("spend"),
            F.count(F.lit(1)).alias("orders"),
        )
    )
    key = F.col("c_custkey")
    return (
        table(spark, folder, "customer")
        .join(spend, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            "c_custkey",
            F.floor(F.col("c_acctbal") * 200).alias("net_worth"),
            F.floor(F.col("spend") / 20).alias("income"),
            (F.col("orders") % 10).alias("cards"),
            (key % 6).alias("children"),
            (18 + key % 60).alias("age"),
            F.when(key % 13 == 0, F.lit(0)).otherwise(450 + key * 7 % 400).alias("rating"),
            F.when(key % 11 != 0, key % 5).alias("cars"),
        )
    )


_MEASURES = """
SELECT c_custkey, CAST(floor(c_acctbal * 200) AS BIGINT) AS net_worth,
       CAST(floor(spend / 20) AS BIGINT) AS income, orders % 10 AS cards, c_custkey % 6 AS children,
       18 + c_custkey % 60 AS age, CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE 450 + c_custkey * 7 % 400 END AS rating,
       CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 5 END AS cars
FROM customer LEFT JOIN (
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS spend, count(*) AS orders
    FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
"""


def _nameplates(spark: SparkSession, folder: str, rules: NameplateRules) -> DataFrame:
    plate = nameplate("net_worth", "income", "cards", "children", "age", "rating", "cars", rules)
    return _measures(spark, folder).select("c_custkey", "income", plate.alias("nameplate"))


@query(f"""
SELECT c_custkey, income, concat_ws('+',
    CASE WHEN net_worth > 1000000 OR income > 200000 THEN 'HighValue' END,
    CASE WHEN children > 3 OR cards > 5 THEN 'Expenses' END,
    CASE WHEN age > 45 THEN 'Boomer' END,
    CASE WHEN income < 5000 OR rating < 600 OR net_worth < 100000 THEN 'MoneyAlert' END,
    CASE WHEN cars > 3 OR cards > 7 THEN 'Spender' END,
    CASE WHEN age > 25 OR net_worth > 1000000 THEN 'Inherited' END) AS nameplate
FROM ({_MEASURES})
""")
def marketing_nameplate(spark: SparkSession, folder: str) -> DataFrame:
    return _nameplates(spark, folder, PROSPECT_RULES)


@query(f"""
SELECT c_custkey, income, concat_ws('+',
    CASE WHEN net_worth > 1000000 OR income > 200000 THEN 'HighValue' END,
    CASE WHEN children > 3 OR cards > 5 THEN 'Expenses' END,
    CASE WHEN age > 45 THEN 'Boomer' END,
    CASE WHEN (income <> 0 AND income < 50000) OR (rating <> 0 AND rating < 600)
           OR (net_worth <> 0 AND net_worth < 100000) THEN 'MoneyAlert' END,
    CASE WHEN cars > 3 OR cards > 7 THEN 'Spender' END,
    CASE WHEN age <> 0 AND age < 25 AND net_worth > 1000000 THEN 'Inherited' END) AS nameplate
FROM ({_MEASURES})
""")
def marketing_nameplate_v2(spark: SparkSession, folder: str) -> DataFrame:
    return _nameplates(spark, folder, ENRICHMENT_RULES)


@query("""
WITH p AS (
    SELECT c_custkey,
           CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE '1' END AS country,
           CASE WHEN c_custkey % 3 <> 0 THEN CAST(100 + c_custkey % 900 AS VARCHAR) END AS area,
           CASE WHEN c_custkey % 5 = 0 THEN '' ELSE CAST(1000000 + c_custkey AS VARCHAR) END AS local,
           CASE WHEN c_custkey % 2 = 0 THEN 'x' || CAST(c_custkey % 50 AS VARCHAR) END AS ext
    FROM customer)
SELECT c_custkey, CASE
    WHEN local = '' THEN ''
    WHEN area IS NULL THEN local || coalesce(ext, '')
    WHEN coalesce(country, '') = '' THEN '(' || area || ') ' || local || coalesce(ext, '')
    ELSE '+' || country || ' (' || area || ') ' || local || coalesce(ext, '') END AS phone
FROM p
""")
def phone_format(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        "c_custkey",
        cleanse.phone(
            F.when(key % 4 == 0, "").when(key % 4 > 1, "1"),
            F.when(key % 3 != 0, text(100 + key % 900)),
            F.when(key % 5 == 0, "").otherwise(text(1_000_000 + key)),
            F.when(key % 2 == 0, F.concat(F.lit("x"), text(key % 50))),
        ).alias("phone"),
    )


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN NULL
                       WHEN left(c_mktsegment, 1) IN ('F', 'M') THEN left(c_mktsegment, 1)
                       ELSE 'U' END AS gender
FROM customer
""")
def gender_clean(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    code = F.when(key % 10 == 0, "").when(key % 17 != 0, F.lower(F.left("c_mktsegment", F.lit(1))))
    return table(spark, folder, "customer").select("c_custkey", cleanse.gender(code).alias("gender"))


@query("""
SELECT p_partkey, p_type, NOT (p_type LIKE 'A%' OR p_type LIKE 'BBB%' OR p_grade LIKE 'A%' OR p_grade LIKE 'BBB%') AS low_grade,
       p_grade
FROM (SELECT p_partkey, p_type, CASE p_size % 5 WHEN 0 THEN 'A' || left(p_type, 1) WHEN 1 THEN 'BBB' || left(p_type, 1)
             WHEN 2 THEN 'BB' WHEN 3 THEN '' ELSE p_type END AS p_grade FROM part)
""")
def low_grade_flag(spark: SparkSession, folder: str) -> DataFrame:
    initial, size = F.left("p_type", F.lit(1)), F.col("p_size") % 5
    grade = (
        F.when(size == 0, F.concat(F.lit("A"), initial))
        .when(size == 1, F.concat(F.lit("BBB"), initial))
        .when(size == 2, "BB").when(size == 3, "").otherwise(F.col("p_type"))
    )
    return table(spark, folder, "part").select(
        "p_partkey", "p_type", cleanse.low_grade(grade).alias("low_grade"), grade.alias("p_grade")
    )


@query("""
SELECT p_partkey, left(p_name, 3) AS head, substr(p_brand, 2) AS tail, p_name AS trimmed,
       contains(p_name, 'ring') AS has_ring, p_type LIKE '%Y' AS ends_y, length(p_name) AS name_length
FROM part
""")
def string_functions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey",
        F.left("p_name", F.lit(3)).alias("head"),
        cleanse.without_first("p_brand").alias("tail"),
        F.rtrim(F.concat("p_name", F.lit("   "))).alias("trimmed"),
        F.col("p_name").contains("ring").alias("has_ring"),
        F.col("p_type").endswith("Y").alias("ends_y"),
        F.length("p_name").alias("name_length"),
    )


@query("""
WITH t AS (
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%Y%m') || '99'
                            WHEN o_orderkey % 7 = 0 THEN 'unknown'
                            ELSE strftime(o_orderdate, '%Y%m%d') END AS written
    FROM orders),
    d AS (SELECT o_orderkey, written, CAST(try_strptime(written, '%Y%m%d') AS DATE) AS parsed FROM t)
SELECT o_orderkey, written, CAST(parsed AS VARCHAR) AS parsed,
       CAST(CAST(parsed - INTERVAL 100 YEAR AS DATE) AS VARCHAR) AS century_before
FROM d
""")
def date_functions(spark: SparkSession, folder: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    written = (
        F.when(key % 5 == 0, F.concat(F.date_format(day, "yyyyMM"), F.lit("99")))
        .when(key % 7 == 0, "unknown")
        .otherwise(F.date_format(day, "yyyyMMdd"))
    )
    parsed = cleanse.compact_date("written")
    return table(spark, folder, "orders").select("o_orderkey", written.alias("written")).select(
        "o_orderkey", "written", text(parsed).alias("parsed"),
        text(cleanse.century_before(parsed)).alias("century_before"),
    )


_CASTS = """
SELECT source, id, written,
       CASE WHEN regexp_full_match(trim(written), '[+-]?[0-9]+') THEN CAST(trim(written) AS BIGINT) END AS as_integer,
       CASE WHEN regexp_full_match(trim(written), '[+-]?[0-9]+') THEN CAST(trim(written) AS INT) END AS int_or_null,
       CAST(TRY_CAST(trim(written) AS DECIMAL(18, 2)) AS DOUBLE) AS as_decimal
"""


@query(f"""
{_CASTS}
FROM (SELECT 'events' AS source, event_id AS id,
             CASE k % 5 WHEN 0 THEN ' 00' || CAST(k AS VARCHAR) || ' ' WHEN 1 THEN CAST(k AS VARCHAR) || '.5'
                        WHEN 2 THEN 'junk' WHEN 3 THEN '' ELSE CAST(k AS VARCHAR) END AS written
      FROM ({EVENTS_WITH_K})
      UNION ALL
      SELECT 'part', p_partkey, '000' || CAST(p_size AS VARCHAR) FROM part)
""")
def safe_casts(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("k")
    from_events = events_with_k(spark, folder).select(
        F.lit("events").alias("source"),
        F.col("event_id").alias("id"),
        F.when(k % 5 == 0, F.concat(F.lit(" 00"), text(k), F.lit(" ")))
        .when(k % 5 == 1, F.concat(text(k), F.lit(".5")))
        .when(k % 5 == 2, "junk").when(k % 5 == 3, "").otherwise(text(k)).alias("written"),
    )
    from_part = table(spark, folder, "part").select(
        F.lit("part").alias("source"),
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("000"), text("p_size")).alias("written"),
    )
    return from_events.unionByName(from_part).select(
        "source", "id", "written",
        cleanse.to_integer("written").alias("as_integer"),
        cleanse.integer_or_null("written").alias("int_or_null"),
        cleanse.to_decimal("written", 18, 2).cast("double").alias("as_decimal"),
    )


@query("""
WITH b AS (SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS segment FROM customer)
SELECT c_custkey, nullif(segment, '') AS segment, coalesce(nullif(segment, ''), 'NONE') AS segment_or_none,
       nullif(segment, '') IS NOT NULL AS has_segment,
       CAST(CAST(coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0) AS DECIMAL(18, 2)) AS DOUBLE) AS balance_or_zero
FROM b
""")
def null_handling(spark: SparkSession, folder: str) -> DataFrame:
    segment = cleanse.blank_to_null(
        F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_mktsegment"))
    )
    balance = F.col("c_acctbal")
    return table(spark, folder, "customer").select(
        "c_custkey",
        segment.alias("segment"),
        cleanse.default(segment, "NONE").alias("segment_or_none"),
        segment.isNotNull().alias("has_segment"),
        amount(cleanse.default(F.when(balance >= 0, balance), 0.0)).alias("balance_or_zero"),
    )


@query("""
SELECT s_suppkey, s_name AS broker_name, TRUE AS is_current, 1 AS batch_id,
       CAST((SELECT CAST(min(o_orderdate) AS DATE) FROM orders) AS VARCHAR) AS effective_date,
       '9999-12-31' AS end_date
FROM supplier WHERE s_nationkey = 15
""")
def broker_dim(spark: SparkSession, folder: str) -> DataFrame:
    first = table(spark, folder, "orders").agg(F.to_date(F.min("o_orderdate"))).scalar()
    return (
        table(spark, folder, "supplier")
        .where(F.col("s_nationkey") == 15)
        .select(
            "s_suppkey",
            F.col("s_name").alias("broker_name"),
            F.lit(True).alias("is_current"),
            F.lit(1).alias("batch_id"),
            text(first).alias("effective_date"),
            F.lit("9999-12-31").alias("end_date"),
        )
    )


@query("""
SELECT p_partkey, p_brand, 1 AS batch_id,
       (SELECT CAST(strftime(max(o_orderdate), '%Y%m%d') AS INT) FROM orders) AS record_date_key
FROM part
""")
def batch_date_stamp(spark: SparkSession, folder: str) -> DataFrame:
    batch_date = table(spark, folder, "orders").agg(cleanse.date_key(F.max("o_orderdate"))).scalar()
    return table(spark, folder, "part").select(
        "p_partkey", "p_brand", F.lit(1).alias("batch_id"), batch_date.alias("record_date_key")
    )
