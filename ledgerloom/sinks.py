"""Writing tables: declared schema, append, start over, and staging between steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import scratch_path


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the declared order and type; a value that does not fit its type is null."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def create(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Write a new table; an existing one is an error."""
    (conform(df, schema) if schema else df).write.mode("errorifexists").parquet(path)


def append(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    (conform(df, schema) if schema else df).write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    (conform(df, schema) if schema else df).write.mode("overwrite").parquet(path)


def stage(df: DataFrame, label: str, *apart: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to shared scratch space and read it back, to cut lineage and recomputation.

    Rows are written apart by the columns ``apart``: a filter on them reads no other rows. ``codec`` replaces the session's.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**({"compression": codec} if codec else {})).partitionBy(*apart).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def divide(df: DataFrame, kept: Column, label: str) -> tuple[DataFrame, DataFrame]:
    """The rows where ``kept`` holds and the others, from one pass that writes them apart."""
    written = stage(df.withColumn("__kept", F.coalesce(kept, F.lit(False))), label, "__kept", codec="zstd")
    return written.where("__kept").drop("__kept"), written.where("NOT __kept").drop("__kept")


def layout(columns: str) -> T.StructType:
    """The schema of a column list such as ``id BIGINT, name STRING``."""
    return T.StructType.fromDDL(columns)
