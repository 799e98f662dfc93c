"""Scans and sinks: each query writes or builds raw text from the tables and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import sinks
from ledgerloom.catalog.inputs import amount, text
from ledgerloom.catalog.registry import query
from ledgerloom.functions.cleanse import blank_to_null, money, to_decimal, to_integer
from ledgerloom.session import scratch_path, table
from ledgerloom.sources import readers

_ORDER_ROW = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS price,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, o_orderpriority
FROM orders
"""


@query(f"""
SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority || '|' || chr(92) || '|' || chr(10) || o_orderstatus || chr(92) END AS note FROM ({_ORDER_ROW})
""")
def scan_delimited(spark: SparkSession, folder: str) -> DataFrame:
    """A field with separators, a line end and backslashes, the last of them before a separator; or the null mark."""
    orders = table(spark, folder, "orders")
    note = F.concat("o_orderpriority", F.lit(r"\|\\\|\n"), "o_orderstatus", F.lit(r"\\"))
    lines = orders.select(
        F.concat_ws(
            "|", "o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.when(F.col("o_orderkey") % 3 != 0, note).otherwise(r"\N"), "o_orderpriority",
        ).alias("line")
    )
    schema = (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, price DECIMAL(18, 2), "
        "order_date DATE, note STRING, o_orderpriority STRING"
    )
    path = scratch_path(spark, "delimited")
    lines.write.text(path)
    rows = readers.read_rows(spark, path, schema, "|")
    return rows.where(F.size("rejected") == 0).drop("rejected").withColumns(
        {"price": F.col("price").cast("double"), "order_date": text("order_date")}
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
       concat_ws('; ', CASE WHEN o_orderkey % 5 = 0 THEN 'o_custkey = C' || o_custkey END, CASE WHEN o_orderkey % 7 = 0 THEN 'order_date = 1998-02-30' END,
                 CASE WHEN o_orderkey % 11 = 0 THEN '(fields) = 4' END) AS rejects
FROM orders
""")
def scan_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and what of them does not fit, from one pass over the lines."""
    key = F.col("o_orderkey")
    lines = table(spark, folder, "orders").select(
        F.concat_ws(
            "|", key, F.when(key % 5 == 0, F.concat(F.lit("C"), "o_custkey")).otherwise(text("o_custkey")),
            F.when(key % 7 == 0, "1998-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")), F.when(key % 11 == 0, "more"),
        ).alias("line")
    )
    rows = readers.typed_rows(lines, "line", "o_orderkey BIGINT, o_custkey BIGINT, order_date DATE", "|")
    told = F.transform("rejected", lambda r: F.concat(r.column_name, F.lit(" = "), r.written))
    return rows.select("o_orderkey", "o_custkey", text("order_date").alias("order_date"), F.array_join(told, "; ").alias("rejects"))


@query("""
SELECT 'customer_audit.csv' AS file_name, c_custkey AS id, c_name AS name,
       CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS DOUBLE) AS balance FROM customer
UNION ALL
SELECT 'supplier_audit.csv', s_suppkey, s_name, CAST(CAST(s_acctbal AS DECIMAL(18, 2)) AS DOUBLE) FROM supplier
""")
def scan_file_glob(spark: SparkSession, folder: str) -> DataFrame:
    batch = readers.batch_path(scratch_path(spark, "raw"), 1, 1)
    files = {
        "customer_audit.csv": ("customer", "c_custkey", "c_name", "c_acctbal"),
        "supplier_audit.csv": ("supplier", "s_suppkey", "s_name", "s_acctbal"),
        "part_other.csv": ("part", "p_partkey", "p_name", "p_retailprice"),
    }
    for file_name, (name, key, label, value) in files.items():
        rows = table(spark, folder, name).select(key, label, money(value).alias("balance"))
        rows.write.option("header", True).csv(batch + file_name)
    return readers.read_delimited(
        spark, batch + "*_audit.csv", "id BIGINT, name STRING, balance DECIMAL(18, 2)", ",", header=True
    ).select(
        F.element_at(F.split("_metadata.file_path", "/"), -2).alias("file_name"),
        "id", "name", F.col("balance").cast("double").alias("balance"),
    )


_LINES = {
    "CUS": {"id": (18, 28), "label": (28, 58), "number": (58, None)},
    "PRT": {"id": (18, 28), "number": (28, 40), "label": (40, None)},
    "ORD": {"label": (18, 19), "id": (19, 34), "number": (34, None)},
}


def _padded(stamp: str, kind: str, *parts) -> F.Column:
    return F.concat(F.rpad(F.lit(stamp), 15, " "), F.lit(kind), *parts)


@query("""
SELECT 'CUS' AS kind, c_custkey AS id, c_name AS label, CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS DOUBLE) AS number FROM customer
UNION ALL
SELECT 'PRT', p_partkey, p_name, CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS DOUBLE) FROM part
UNION ALL
SELECT 'ORD', o_orderkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) FROM orders
UNION ALL
SELECT 'unknown', NULL, '20170707-120000SUP' || s_name, NULL FROM supplier
""")
def scan_fixed_width_routed(spark: SparkSession, folder: str) -> DataFrame:
    stamp = "20170707-120000"
    customers = table(spark, folder, "customer").select(
        _padded(
            stamp, "CUS", F.lpad(text("c_custkey"), 10, "0"), F.rpad("c_name", 30, " "), text(money("c_acctbal"))
        ).alias("value")
    )
    parts = table(spark, folder, "part").select(
        _padded(
            stamp, "PRT", F.lpad(text("p_partkey"), 10, "0"), F.rpad(text(money("p_retailprice")), 12, " "), F.col("p_name")
        ).alias("value")
    )
    orders = table(spark, folder, "orders").select(
        _padded(
            stamp, "ORD", F.rpad("o_orderstatus", 1, " "), F.lpad(text("o_orderkey"), 15, "0"), text(money("o_totalprice"))
        ).alias("value")
    )
    others = table(spark, folder, "supplier").select(_padded(stamp, "SUP", F.col("s_name")).alias("value"))
    path = scratch_path(spark, "fixed-width")
    customers.unionByName(parts).unionByName(orders).unionByName(others).write.text(path)
    routed = readers.read_fixed_width(spark, path, _LINES, (15, 18))
    same = [
        rows.select(
            F.lit(kind).alias("kind"), to_integer("id").alias("id"), "label",
            to_decimal("number", 18, 2).cast("double").alias("number"),
        )
        for kind, rows in routed.items() if kind in _LINES
    ]
    unknown = routed[readers.UNKNOWN_KIND].select(
        F.lit("unknown").alias("kind"), F.lit(None).cast("bigint").alias("id"), F.col("unknown_line").alias("label"),
        F.lit(None).cast("double").alias("number"),
    )
    return same[0].unionByName(same[1]).unionByName(same[2]).unionByName(unknown)


@query("""
SELECT p_partkey, p_type, CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS DOUBLE) AS price, TRUE AS invalid_text
FROM part
""")
def tolerant_decode(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.concat(
        F.rpad(text("p_partkey"), 12, " ").cast("binary"),
        F.unhex(F.lit("FF")),
        F.rpad("p_type", 20, " ").cast("binary"),
        text(money("p_retailprice")).cast("binary"),
    )
    lines = table(spark, folder, "part").select(raw.cast("string").alias("value"))
    layout = {"p_partkey": (0, 12), "p_type": (13, 33), "price": (33, None)}
    sliced = readers.fixed_width(readers.flag_invalid(lines), "value", layout)
    return sliced.select(
        to_integer("p_partkey").alias("p_partkey"), "p_type",
        to_decimal("price", 18, 2).cast("double").alias("price"), "invalid_text",
    )


_ACTION = (
    "_type STRING, Customer STRUCT<_C_ID: BIGINT, Name: STRUCT<C_NAME: STRING, C_NICK: STRING>, "
    "Address: STRUCT<C_CTRY: STRING>, Account: ARRAY<STRUCT<_CA_ID: BIGINT, CA_NAME: STRING>>>"
)


@query("""
SELECT 'NEW' AS action, c_custkey, c_name AS name, '' AS nick, coalesce(CASE WHEN c_acctbal >= 0 THEN n_name END, 'NONE') AS country,
       c_custkey * 10 + a.i AS account_id, 'Account ' || a.i AS account_name
FROM customer JOIN nation ON n_nationkey = c_nationkey CROSS JOIN (VALUES (1), (2)) a(i)
""")
def scan_nested_xml(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    key = F.col("c_custkey")
    address = F.when(
        F.col("c_acctbal") >= 0, F.format_string("<Address><C_CTRY>%s</C_CTRY></Address>", F.col("n_name"))
    ).otherwise("")
    document = F.format_string(
        '<Action type="NEW"><Customer C_ID="%d"><Name><C_NAME>%s</C_NAME><C_NICK/></Name>%s'
        '<Account CA_ID="%d"><CA_NAME>Account 1</CA_NAME></Account>'
        '<Account CA_ID="%d"><CA_NAME>Account 2</CA_NAME></Account></Customer></Action>',
        key, F.col("c_name"), address, key * 10 + 1, key * 10 + 2,
    )
    documents = table(spark, folder, "customer").join(nations, "c_nationkey").select(document.alias("xml"))
    return (
        readers.xml_rows(documents, "xml", _ACTION, "Action")
        .withColumn("account", F.explode_outer("Customer.Account"))
        .select(
            F.col("_type").alias("action"),
            F.col("Customer._C_ID").alias("c_custkey"),
            F.col("Customer.Name.C_NAME").alias("name"),
            F.col("Customer.Name.C_NICK").alias("nick"),
            F.coalesce(blank_to_null("Customer.Address.C_CTRY"), F.lit("NONE")).alias("country"),
            F.col("account._CA_ID").alias("account_id"),
            F.col("account.CA_NAME").alias("account_name"),
        )
    )


@query("""
SELECT o_orderkey, o_orderkey || '|' || o_orderstatus || '|' || o_orderpriority AS line, o_orderpriority AS third,
       3 AS fields
FROM orders
""")
def split_join_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "orders").select(
        "o_orderkey", F.concat_ws("|", "o_orderkey", "o_orderstatus", "o_orderpriority").alias("line")
    )
    fields = readers.split_line("line", "|")
    return lines.select(
        "o_orderkey",
        readers.join_fields(fields, "|").alias("line"),
        F.get(fields, 2).alias("third"),
        F.size(fields).alias("fields"),
    )


@query(f"""
SELECT 'appended' AS stored_in, * FROM ({_ORDER_ROW})
UNION ALL
SELECT 'replaced' AS stored_in, * FROM ({_ORDER_ROW}) WHERE o_orderstatus <> 'F'
""")
def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", amount("o_totalprice").alias("price"),
        text(F.to_date("o_orderdate")).alias("order_date"), "o_orderpriority",
    )
    path = scratch_path(spark, "sink")
    finished, rest = orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'")
    schema = orders.schema
    sinks.create(finished, f"{path}/appended", schema)
    sinks.append(rest, f"{path}/appended", schema)
    sinks.create(finished, f"{path}/replaced", schema)
    sinks.overwrite(rest, f"{path}/replaced", schema)
    stored = [
        spark.read.schema(schema).parquet(f"{path}/{name}").withColumn("stored_in", F.lit(name))
        for name in ("appended", "replaced")
    ]
    return stored[0].unionByName(stored[1])
