"""Change-log replay: routing, grouping, carry-forward and cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import ACCOUNTS, CHANGE_LOG, accounts, change_log, raw_changes, text
from ledgerloom.catalog.registry import query
from ledgerloom.operators import changelog as log
from ledgerloom.operators.lookup import lookup_default
from ledgerloom.session import table

ORDER = ["ts", "event_id"]


@query(f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, op, count(*) AS actions
FROM ({CHANGE_LOG}) GROUP BY CAST(ts AS DATE), op
""")
def changelog_route(spark: SparkSession, folder: str) -> DataFrame:
    return (
        change_log(spark, folder)
        .groupBy(text(F.to_date("ts")).alias("day"), "op")
        .agg(F.count(F.lit(1)).alias("actions"))
    )


@query(f"""
SELECT user_id, count(*) AS updates, CAST(min(ts) AS VARCHAR) AS first_ts, CAST(max(ts) AS VARCHAR) AS last_ts
FROM ({CHANGE_LOG}) WHERE op <> 'NEW' GROUP BY user_id
""")
def changelog_group(spark: SparkSession, folder: str) -> DataFrame:
    return (
        change_log(spark, folder)
        .where(F.col("op") != "NEW")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("updates"),
            text(F.min("ts")).alias("first_ts"),
            text(F.max("ts")).alias("last_ts"),
        )
    )


CUSTOMER_REPLAY = f"""
WITH cl AS ({CHANGE_LOG})
SELECT user_id, event_id, op,
       nullif(last_value(tier IGNORE NULLS) OVER so_far, '') AS tier,
       last_value(CASE op WHEN 'NEW' THEN 'ACTIVE' WHEN 'INACT' THEN 'INACTIVE' END IGNORE NULLS)
           OVER so_far AS status,
       CAST(ts AS VARCHAR) AS start_ts,
       CAST(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS VARCHAR) AS end_ts,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
FROM cl
WINDOW so_far AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
"""


def _replayed(spark: SparkSession, folder: str, **scan) -> DataFrame:
    versions = log.replay(
        raw_changes(spark, folder), ["user_id"], ORDER, ["tier"],
        effective="ts", status_of={"NEW": "ACTIVE", "INACT": "INACTIVE"}, opening="NEW", **scan,
    )
    return versions.select(
        "user_id", "event_id", "op", "tier", "status",
        text("ts").alias("start_ts"), text("end_ts").alias("end_ts"), "is_current",
    )


@query(CUSTOMER_REPLAY)
def customer_replay(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder)


@query(CUSTOMER_REPLAY)
def customer_replay_segmented(spark: SparkSession, folder: str) -> DataFrame:
    """The way of large keys: every user of more than 30 changes is cut."""
    return _replayed(spark, folder, rows_per_task=30)


@query(f"""
WITH a AS (
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY account_id ORDER BY ts, event_id) = 1 THEN 'OPEN'
                   WHEN event_type = 'error' THEN 'CLOSE' ELSE 'UPD' END AS op
    FROM ({ACCOUNTS}))
SELECT account_id, event_id, op,
       nullif(last_value(tier IGNORE NULLS) OVER so_far, '') AS tier,
       last_value(CASE op WHEN 'OPEN' THEN 'ACTIVE' WHEN 'CLOSE' THEN 'INACTIVE' END IGNORE NULLS)
           OVER so_far AS status,
       coalesce(s_suppkey, -1) AS broker,
       CAST(ts AS VARCHAR) AS start_ts,
       CAST(lead(ts) OVER (PARTITION BY account_id ORDER BY ts, event_id) AS VARCHAR) AS end_ts,
       lead(ts) OVER (PARTITION BY account_id ORDER BY ts, event_id) IS NULL AS is_current
FROM a LEFT JOIN supplier ON s_suppkey = k
WINDOW so_far AS (PARTITION BY account_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def account_replay(spark: SparkSession, folder: str) -> DataFrame:
    op = F.when(F.col("event_type") == "error", "CLOSE").otherwise("UPD")
    versions = log.replay(
        accounts(spark, folder).withColumn("op", op), ["account_id"], ORDER, ["tier"],
        effective="ts", status_of={"OPEN": "ACTIVE", "CLOSE": "INACTIVE"}, opening="OPEN",
    )
    brokers = table(spark, folder, "supplier").select("s_suppkey")
    return lookup_default(versions, brokers, {"k": "s_suppkey"}, "s_suppkey", "broker").select(
        "account_id", "event_id", "op", "tier", "status", "broker",
        text("ts").alias("start_ts"), text("end_ts").alias("end_ts"), "is_current",
    )


@query(f"""
WITH a AS ({ACCOUNTS}),
     lives AS (SELECT account_id, user_id, min(ts) AS opened,
                      min(CASE WHEN event_type = 'error' THEN ts END) AS closed
               FROM a GROUP BY account_id, user_id),
     changes AS (SELECT DISTINCT user_id, ts FROM events WHERE event_type = 'signup'),
     points AS (SELECT account_id, user_id, a.ts
                FROM a JOIN lives USING (account_id, user_id) WHERE closed IS NULL OR a.ts <= closed
                UNION
                SELECT account_id, user_id, c.ts
                FROM lives JOIN changes c USING (user_id)
                WHERE c.ts > opened AND (closed IS NULL OR c.ts < closed))
SELECT account_id, CAST(p.ts AS VARCHAR) AS start_ts,
       CAST(lead(p.ts) OVER (PARTITION BY account_id ORDER BY p.ts) AS VARCHAR) AS end_ts,
       (SELECT count(*) FROM changes c WHERE c.user_id = p.user_id AND c.ts < p.ts) AS old_version,
       (SELECT count(*) FROM changes c WHERE c.user_id = p.user_id AND c.ts <= p.ts) AS new_version
FROM points p
""")
def cascade_versions(spark: SparkSession, folder: str) -> DataFrame:
    children = accounts(spark, folder).select("account_id", "user_id", "ts", "event_type")
    parents = table(spark, folder, "events").where(F.col("event_type") == "signup")
    versions = log.cascade(
        children, parents, "account_id", "user_id", "ts", F.col("event_type") == "error"
    )
    return versions.withColumns({c: text(c) for c in ("start_ts", "end_ts")})
