"""A log of commits beside written data: what a writer finishes with, and a reader begins with.

The log is a small table. A commit appends one row in one file, which Spark moves into place when the write is done, so readers see
all of a commit or nothing. Writers of one log run one at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import sinks


def entries(spark: SparkSession, path: str, columns: str) -> DataFrame | None:
    """The rows of the log, with their ``number``; None before the first commit."""
    try:
        return spark.read.schema(f"number BIGINT, {columns}").parquet(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def record(spark: SparkSession, path: str, columns: str, *values) -> None:
    """Append a row with the next number."""
    log = entries(spark, path, columns)
    number = log.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] if log else 0
    row = spark.createDataFrame([(number + 1, *values)], f"number BIGINT, {columns}")
    sinks.append(row.coalesce(1), f"{path}/commits")
