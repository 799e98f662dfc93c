"""Data-quality messages, domain and key checks, and reconciliation with audit rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_COLUMNS = ("batch_id", "message_source", "message_text", "message_type", "message_data")


def check(
    df: DataFrame,
    violated: Column,
    source: str,
    text: str,
    data: Column,
    *,
    kind: str = "Alert",
    batch: int = 1,
) -> DataFrame:
    """One message for each row on which ``violated`` is true; null counts as not violated."""
    return df.where(violated).select(
        F.lit(batch).alias("batch_id"),
        F.lit(source).alias("message_source"),
        F.lit(text).alias("message_text"),
        F.lit(kind).alias("message_type"),
        data.cast("string").alias("message_data"),
    )


def status_message(
    df: DataFrame, source: str, *, text: str = "Inserted rows", batch: int = 1
) -> DataFrame:
    """One status row that reports how many rows a load wrote."""
    return df.agg(F.count(F.lit(1)).alias("__rows")).select(
        F.lit(batch).alias("batch_id"),
        F.lit(source).alias("message_source"),
        F.lit(text).alias("message_text"),
        F.lit("Status").alias("message_type"),
        F.col("__rows").cast("string").alias("message_data"),
    )


def counted_message(
    spark: SparkSession, rows: int, source: str, *, text: str = "Inserted rows", batch: int = 1
) -> DataFrame:
    """The status row of a load whose rows were counted as they were written."""
    return spark.range(1).select(
        F.lit(batch).alias("batch_id"), F.lit(source).alias("message_source"), F.lit(text).alias("message_text"),
        F.lit("Status").alias("message_type"), F.lit(str(rows)).alias("message_data"),
    )


def stamped(messages: DataFrame, at: Column | None = None) -> DataFrame:
    """Put the message time in front; pass ``at`` to make a run repeatable."""
    return messages.select(
        (F.current_timestamp() if at is None else at).alias("message_time"), *MESSAGE_COLUMNS
    )


def union_messages(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def outside_domain(value: Column, allowed: Sequence) -> Column:
    """True where the value is missing or not among ``allowed``."""
    return ~F.coalesce(value.isin(*allowed), F.lit(False))


def duplicate_keys(df: DataFrame, key: Sequence[str], name: str = "copies") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def null_counts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """(column_name, nulls) for each required column, from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counted.unpivot([], list(required), "column_name", "nulls")


def long_form(df: DataFrame, data_set: str, measures: dict[str, Column]) -> DataFrame:
    """(data_set, attribute, value) with one row per aggregate, from one pass."""
    values = df.agg(*[c.cast("decimal(20,2)").alias(n) for n, c in measures.items()])
    return values.unpivot([], list(measures), "attribute", "value").select(
        F.lit(data_set).alias("data_set"), "attribute", "value"
    )


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected and actual long-form values side by side; a missing actual does not match."""
    return expected.select("data_set", "attribute", F.col("value").alias("expected")).join(
        actual.select("data_set", "attribute", F.col("value").alias("actual")),
        ["data_set", "attribute"],
        "left",
    ).withColumn("matches", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)))
