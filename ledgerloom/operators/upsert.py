"""Keyed upserts as aggregates: every row of a key is combined map-side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    first: Sequence[str] = (),
    last: Sequence[str] = (),
    add: Sequence[str] = (),
    existing: DataFrame | None = None,
) -> DataFrame:
    """One row per key from rows arriving in ``order``.

    ``first`` columns keep the value of the first row, ``last`` columns take that of the last,
    ``add`` columns are summed. Rows of ``existing`` (an earlier result) come before all others.
    ``order`` must be unique within a key.
    """
    kept = [*first, *last, *add]
    rows = df.select(*key, *kept, F.struct(F.lit(1).alias("new"), *order).alias("__at"))
    if existing is not None:
        nothing = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in order]
        old = existing.select(*key, *kept, F.struct(F.lit(0).alias("new"), *nothing).alias("__at"))
        rows = old.unionByName(rows)
    aggregates = []
    if first:
        aggregates.append(F.min_by(F.struct(*first), "__at").alias("__first"))
    if last:
        aggregates.append(F.max_by(F.struct(*last), "__at").alias("__last"))
    aggregates += [F.sum(c).alias(c) for c in add]
    return rows.groupBy(*key).agg(*aggregates).select(
        *key,
        *[F.col(f"__first.{c}") for c in first],
        *[F.col(f"__last.{c}") for c in last],
        *add,
    )


def second_sighting(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, opened: str, closed: str
) -> DataFrame:
    """The first row of a key opens it with its ``value``; the last of any later rows closes it."""
    at = F.struct(*order)
    return df.groupBy(*key).agg(
        F.min_by(value, at).alias(opened),
        F.when(F.count(F.lit(1)) > 1, F.max_by(value, at)).alias(closed),
    )


def open_close(
    df: DataFrame,
    key: Sequence[str],
    at: Column | str,
    opened: Mapping[str, Column],
    closed: Mapping[str, Column],
) -> DataFrame:
    """One row per key: the earliest ``at`` where each ``opened`` test holds, the latest where each
    ``closed`` test holds, null where none does."""
    at = F.col(at) if isinstance(at, str) else at
    return df.groupBy(*key).agg(
        *[F.min(F.when(test, at)).alias(name) for name, test in opened.items()],
        *[F.max(F.when(test, at)).alias(name) for name, test in closed.items()],
    )


def update_from(
    df: DataFrame,
    candidates: DataFrame,
    on: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Overwrite ``columns`` for keys found among ``candidates`` (one row per key), keep the rest.

    A null in a matching candidate overwrites too.
    """
    new = candidates.select(
        *on, F.lit(True).alias("__found"), *[F.col(c).alias(f"__new_{c}") for c in columns]
    )
    joined = df.join(new, list(on), "left")
    return joined.select(
        *[
            F.when(F.col("__found"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in df.columns
        ]
    )
