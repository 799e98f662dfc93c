"""Replay of change logs into versions, with carry-forward, and the cascade from parent to child."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.ordered import ROWS_PER_TASK, find_cuts, ordered_scan, version_number
from ledgerloom.sinks import stage


def route(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    op: Column,
    *,
    opening: str = "NEW",
    name: str = "op",
    **scan,
) -> DataFrame:
    """Add the operation of each row: ``opening`` for the first row of a key, else ``op``."""
    numbered = version_number(df, key, order, "__nth", **scan)
    return numbered.withColumn(name, F.when(F.col("__nth") == 1, opening).otherwise(op)).drop("__nth")


def collapse_changes(
    df: DataFrame, grain: Sequence[str], order: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """One row per ``grain`` (a key and a day): each field's last non-null value within it.

    Combined map-side. What is left holds at most one row per key and calendar day.
    """
    at = F.struct(*order)
    return df.groupBy(*grain).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in fields]
    )


def replay(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    carried: Sequence[str],
    *,
    effective: str,
    status_of: Mapping[str, str] | None = None,
    op: str = "op",
    opening: str | None = None,
    status: str = "status",
    end: str = "end_ts",
    current: str = "is_current",
    **scan,
) -> DataFrame:
    """Turn a change log into versions in one pass per key.

    A null field is unchanged and takes the last value before it; a blank text is cleared and
    becomes null. ``status_of`` maps operations to a status; operations not in it keep the status.
    With ``opening`` the first row of a key counts as that operation, whatever it says. Each
    version ends at the ``effective`` value of the next; the last one is current.
    """
    values: dict[str, Column | str] = {c: c for c in carried}
    totals, first, after = {}, {}, {}
    if status_of:
        said = F.coalesce(*[F.when(F.col(op) == o, F.lit(s)) for o, s in status_of.items()])
        values[status] = said
    if opening:
        totals["__nth"] = F.lit(1)
        after[op] = F.when(F.col("__nth") == 1, opening).otherwise(F.col(op))
    if opening and status_of:
        # What the first row says about the status does not count.
        totals["__said"] = said.isNotNull().cast("int")
        first["__said_first"] = said.isNotNull().cast("int")
        after[status] = F.when(
            F.col("__said") == F.col("__said_first"), F.lit(status_of.get(opening))
        ).otherwise(F.col(status))
    versions = ordered_scan(
        df, key, order, carry=values, total=totals, opening=first, following={end: effective}, **scan
    )
    texts = [c for c in carried if isinstance(df.schema[c].dataType, T.StringType)]
    cleared = {c: F.nullif(F.col(c), F.lit("")) for c in texts}
    return versions.withColumns({**cleared, **after, current: F.col(end).isNull()}).drop(
        "__nth", "__said", "__said_first"
    )


def inherited_changes(
    lives: DataFrame,
    changes: DataFrame,
    parent_key: str,
    at: str,
    opened: str,
    closed: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Each parent change strictly inside the open life of each child; a null ``closed`` is open.

    One ordered scan over changes and lives finds the numbers of the first and last change inside each life; the range is
    expanded and meets the changes by number. So no pair is made that is not in the result, which has a row per child and change.
    ``lives`` is read twice and should be a written table.
    """
    numbered = stage(version_number(changes, [parent_key], [at], "__n", cuts=find_cuts(changes, [parent_key], [at], rows_per_task)), "changes")
    mine = lives.select(parent_key, F.struct(*lives.columns).alias("__life"), F.xxhash64(*lives.columns).alias("__spread"), opened, closed)
    # A change on the day of the opening is before the life, one on the day of the close after it.
    ends = mine.select(
        parent_key, "__life", "__spread",
        F.explode(F.array(F.struct(F.col(opened).alias("at"), F.lit(2).alias("kind")), F.struct(F.col(closed).alias("at"), F.lit(0).alias("kind")))).alias("e"),
    ).select(parent_key, "__life", "__spread", F.col("e.at").alias("__at"), F.col("e.kind").alias("__kind"), F.lit(None).cast("bigint").alias("__n"))
    marks = numbered.select(
        parent_key, F.lit(None).cast(mine.schema["__life"].dataType).alias("__life"), F.lit(0).cast("bigint").alias("__spread"),
        F.col(at).alias("__at"), F.lit(1).alias("__kind"), "__n",
    )
    both = ends.unionByName(marks).withColumn("__late", F.col("__at").isNull())
    seen = ordered_scan(both, [parent_key], ["__late", "__at", "__kind", "__spread"], carry={"__seen": "__n"}, rows_per_task=rows_per_task)
    count = F.coalesce("__seen", F.lit(0))
    ranges = seen.where(F.col("__kind") != 1).groupBy(parent_key, "__life").agg(
        F.max(F.when(F.col("__kind") == 2, count)).alias("__low"), F.max(F.when(F.col("__kind") == 0, count)).alias("__high")
    )
    return _expanded(ranges, numbered, parent_key).select("__life.*", *[c for c in changes.columns if c != parent_key])


def _expanded(ranges: DataFrame, numbered: DataFrame, parent_key: str) -> DataFrame:
    """The changes of each range, those after number ``__low`` up to ``__high``."""
    each = ranges.where(F.col("__high") > F.col("__low")).withColumn("__n", F.explode(F.sequence(F.col("__low") + 1, "__high")))
    return each.drop("__low", "__high").join(numbered, [parent_key, "__n"])


def cascade(
    children: DataFrame,
    parents: DataFrame,
    child_key: str,
    parent_key: str,
    at: str,
    closes: Column,
    *,
    start: str = "start_ts",
    end: str = "end_ts",
    old: str = "old_version",
    new: str = "new_version",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Cut child versions at their own changes and at their parent's.

    A child lives from its first row to the first row on which ``closes`` holds. Its change points
    are its own up to and including the close, and the parent's strictly in between. Each point
    carries the parent's version number before and after it (0 before the first change).
    """
    rows = children.select(child_key, parent_key, at, closes.alias("__closes"))
    child_cuts = find_cuts(rows, [child_key], [at], rows_per_task)
    scanned = ordered_scan(
        rows, [child_key], [at],
        total={"__closed": F.col("__closes").cast("int")}, cuts=child_cuts,
    )
    before = F.coalesce("__closed", F.lit(0)) - F.coalesce(F.col("__closes"), F.lit(False)).cast("int")
    own = stage(
        scanned.where(before == 0).groupBy(child_key, parent_key, at).agg(F.bool_or(F.coalesce("__closes", F.lit(False))).alias("__closes")), "own"
    )
    distinct = parents.select(parent_key, at).distinct()
    changes = stage(
        version_number(distinct, [parent_key], [at], "__n", cuts=find_cuts(parents, [parent_key], [at], rows_per_task)), "changes"
    )

    # Own points: the parent's version in force, from one scan over both along time.
    no_child = F.lit(None).cast(children.schema[child_key].dataType)
    both = own.withColumns({"__kind": F.lit(1), "__n": F.lit(None).cast("bigint")}).unionByName(
        changes.withColumns({child_key: no_child, "__kind": F.lit(0), "__closes": F.lit(None).cast("boolean")})
    )
    order = [at, "__kind", child_key]
    seen = ordered_scan(
        both, [parent_key], order,
        carry={"__seen": F.when(F.col("__kind") == 0, F.struct("__n", F.col(at).alias("at")))},
        cuts=find_cuts(own.withColumn("__kind", F.lit(1)), [parent_key], order, rows_per_task),
    ).where(F.col("__kind") == 1)
    count = F.coalesce("__seen.__n", F.lit(0))
    just_now = F.coalesce(F.col("__seen.at") == F.col(at), F.lit(False)).cast("int")
    own_points = stage(seen.select(child_key, parent_key, at, "__closes", (count - just_now).alias(old), count.alias(new)), "own-points")

    # A life is a range of the parent's versions: those after the one at its opening, before the one at its close.
    totals = changes.groupBy(parent_key).agg(F.max("__n").alias("__total"))
    ranges = own_points.groupBy(child_key, parent_key).agg(
        F.min(new).alias("__low"), F.max(F.when(F.col("__closes"), F.col(old))).alias("__high")
    ).join(totals, parent_key).withColumn("__high", F.coalesce("__high", "__total")).drop("__total")
    from_parent = _expanded(ranges, changes, parent_key).select(
        child_key, at, (F.col("__n") - 1).alias(old), F.col("__n").alias(new)
    )
    points = (
        own_points.select(child_key, at, old, new).unionByName(from_parent)
        .groupBy(child_key, F.col(at).alias(start))
        .agg(F.min(old).alias(old), F.max(new).alias(new))
    )
    return ordered_scan(
        stage(points, "cascade"), [child_key], [start], following={end: start}, rows_per_task=rows_per_task
    ).select(child_key, start, end, old, new)
