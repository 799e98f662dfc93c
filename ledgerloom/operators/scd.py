"""Type 2 dimensions: versions with an effective date, an end date and a current flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.ordered import UNCUT, ordered_scan

OPEN_END = "9999-12-31"


def latest_per(df: DataFrame, grain: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row by ``order`` of each ``grain``; an aggregate, so combined before the shuffle."""
    rest = [c for c in df.columns if c not in grain]
    last = df.groupBy(*grain).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__last"))
    return last.select(*[F.col(c) if c in grain else F.col(f"__last.{c}") for c in df.columns])


def scd2(
    df: DataFrame,
    key: Sequence[str],
    effective: str,
    tie_break: Sequence[str],
    open_end: str = OPEN_END,
    *,
    end: str = "end_date",
    current: str = "is_current",
    **scan,
) -> DataFrame:
    """Close each version on the effective value of the next one of its key.

    Several rows of one key and effective value are one change: the last by ``tie_break`` stays,
    so no version has zero length. With a date as the effective value a key then has at most one
    row per calendar day, which one task always holds; finer values are scanned in segments.
    """
    versions = latest_per(df, [*key, effective], tie_break)
    if isinstance(df.schema[effective].dataType, T.DateType):
        scan.setdefault("cuts", UNCUT)
    closed = ordered_scan(versions, key, [effective], following={end: effective}, **scan)
    until = F.lit(open_end).cast(df.schema[effective].dataType)
    return closed.withColumn(current, F.col(end).isNull()).withColumn(
        end, F.coalesce(end, until)
    )
