"""Ordered passes over the rows of a key.

``ordered_scan`` gives every row of a key what a window over that key would give: the last
non-null value so far, a running total or maximum, the first value, the neighbours' values. A plain window
puts all rows of a key into one task, which does not hold when one key owns a large share of the
table. So a key above ``rows_per_task`` is cut into segments along its order:

1. ``find_cuts`` samples the keys and, where some are large, a few of their rows per segment. The cut
   points of every large key, however many there are, are written as a table, one row per key.
2. Rows are windowed per (key, segment).
3. Each segment of a large key is rolled up to one row (partial aggregation first), and a window over
   those few rows (one per cut point and one per large key) gives what enters each segment; that is joined back.

The sample decides only where to cut, never the result: both ways give the same columns, types and rows, and
totals of binary fractions, whose sum depends on the order of adding, are refused. Small keys and small inputs take the one
window pass. The input is read again for the sample and the roll-up, so write an expensive input
to a table first (``sinks.stage``).

Numbers over a whole table (``surrogate_key``) take no window: the rows are sorted in ranges over all tasks, and the
numbers of a range begin where those of the ranges before it end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sinks import stage

ROWS_PER_TASK = 2_000_000
KEY_SAMPLE = 1_000  # sampled rows at which a key counts as large
SEGMENT_SAMPLE = 64  # sampled rows per segment

_POINT, _RANK, _SIZE, _CUTS, _SEGMENT = "__point", "__rank", "__size", "__cuts", "__segment"
_ALL, _PLACE, _ENTERED = "__all", "__place", "__entered"

Values = Mapping[str, "Column | str"]


@dataclass(frozen=True)
class Cuts:
    """Cut points of the keys too large for one task; ``table`` is None when there are none."""

    table: DataFrame | None = None
    depth: int = 0


UNCUT = Cuts()


def large_keys(df: DataFrame, key: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The keys that hold more than about ``rows_per_task`` rows, by a sample of the key columns."""
    fraction = min(1.0, KEY_SAMPLE / rows_per_task)
    sizes = _sampled(df.select(*key), fraction).groupBy(*key).agg(F.count(F.lit(1)).alias(_SIZE))
    return sizes.where(F.col(_SIZE) > rows_per_task * fraction).drop(_SIZE)


def together(df: DataFrame, key: Sequence[str], *, ranged: bool = False, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """The rows with each key in one task (``ranged``: and keys in order over the tasks), or None where a key is too large for one.

    Aggregates and windows by these keys and more then take no further shuffle. Where rows per key are many and groups few, an
    aggregate that combines before its own shuffle is the better way.
    """
    if not large_keys(df, key, rows_per_task).isEmpty():
        return None
    return df.repartitionByRange(*key) if ranged else df.repartition(*key)


def find_cuts(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> Cuts:
    """Cut each key of ``df`` that holds more than about ``rows_per_task`` rows.

    One pass over a sample of the key columns finds the large keys; only if there are any, a second
    sample of their rows gives the cut points.
    """
    if not key:
        df, key = df.withColumn(_ALL, F.lit(0)), [_ALL]
    large = large_keys(df, key, rows_per_task)
    if large.isEmpty():
        return UNCUT
    large = stage(large, "large-keys")
    fraction = min(1.0, SEGMENT_SAMPLE / rows_per_task)
    step = max(1, int(fraction * rows_per_task))
    cut_key = [f"__cut_{i}" for i in range(len(key))]
    keys = large.withColumnsRenamed(dict(zip(key, cut_key)))
    points = df.select(*key, F.struct(*order).alias(_POINT)).join(keys, _same_key(key, cut_key), "left_semi")
    table = stage(
        _sampled(points, fraction)
        .withColumn(_RANK, F.row_number().over(Window.partitionBy(*key).orderBy(_POINT)))
        .where(F.col(_RANK) % step == 0)
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(_POINT)).alias(_CUTS)),
        "cuts",
    )
    most = table.agg(F.max(F.size(_CUTS))).first()[0]
    return Cuts(table, most.bit_length()) if most else UNCUT


def _with_segment(df: DataFrame, order: Sequence[str], depth: int) -> DataFrame:
    """Add how many cut points of the key lie at or before the row, by binary search.

    Each halving is a projection of its own, so the position so far is computed once.
    """
    point, passed = F.struct(*order), F.col(_SEGMENT)
    df = df.withColumn(_SEGMENT, F.lit(0))
    for step in (2**j for j in reversed(range(depth))):
        reached = F.get(_CUTS, passed + (step - 1)) <= point
        df = df.withColumn(_SEGMENT, passed + F.when(reached, step).otherwise(0))
    return df


def _sampled(df: DataFrame, fraction: float) -> DataFrame:
    return df if fraction == 1.0 else df.sample(fraction, seed=11)


def _columns(values: Values | None) -> dict[str, Column]:
    return {
        name: F.col(value) if isinstance(value, str) else value
        for name, value in (values or {}).items()
    }


def _same_key(key: Sequence[str], other: Sequence[str]) -> Column:
    condition = F.lit(True)
    for mine, theirs in zip(key, other):
        condition = condition & F.col(mine).eqNullSafe(F.col(theirs))
    return condition


def _cell(value: Column) -> Column:
    """Wrap a value so that a missing row and a null value stay apart."""
    return F.struct(value.alias("v"))


def ordered_scan(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    *,
    carry: Values | None = None,
    total: Values | None = None,
    highest: Values | None = None,
    opening: Values | None = None,
    following: Values | None = None,
    preceding: Values | None = None,
    cuts: Cuts | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add columns computed along ``order`` (ascending, unique) within ``key``.

    carry      last non-null value up to the row
    total      running sum up to the row
    highest    largest value up to the row
    opening    value on the first row of the key
    following  value on the next row, null on the last
    preceding  value on the row before, null on the first

    An empty ``key`` means the whole table in one order. Pass ``cuts`` to reuse the cut points of
    an earlier scan, or ``UNCUT`` where the rows of a key are known to be few.
    """
    carry, total, highest, opening = _columns(carry), _columns(total), _columns(highest), _columns(opening)
    following, preceding = _columns(following), _columns(preceding)
    sums = df.select(*[F.sum(c).alias(n) for n, c in total.items()]).schema if total else []
    for field in sums:
        if isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType):
            raise TypeError(f"the running total {field.name} needs whole numbers or decimals")
    if cuts is None:
        cuts = find_cuts(df, key, order, rows_per_task)
    if cuts.table is None:
        return _one_pass(df, key, order, carry, total, highest, opening, following, preceding)
    if not key:
        df, key = df.withColumn(_ALL, F.lit(0)), [_ALL]
    found = _segmented(df, key, order, carry, total, highest, opening, following, preceding, cuts)
    return found.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in sums}).drop(_ALL)


def _one_pass(df, key, order, carry, total, highest, opening, following, preceding) -> DataFrame:
    here = Window.partitionBy(*key).orderBy(*order)
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {n: F.last(c, ignorenulls=True).over(so_far) for n, c in carry.items()}
    out |= {n: F.sum(c).over(so_far) for n, c in total.items()}
    out |= {n: F.max(c).over(so_far) for n, c in highest.items()}
    out |= {n: F.first(c).over(so_far) for n, c in opening.items()}
    out |= {n: F.lead(c).over(here) for n, c in following.items()}
    out |= {n: F.lag(c).over(here) for n, c in preceding.items()}
    return df.withColumns(out)


def _segmented(
    df, key, order, carry, total, highest, opening, following, preceding, cuts
) -> DataFrame:
    point = F.struct(*order)
    cut_key = [f"__cut_{i}" for i in range(len(key))]
    table = cuts.table.withColumnsRenamed(dict(zip(key, cut_key)))
    rows = _with_segment(
        df.join(table, _same_key(key, cut_key), "left"), order, cuts.depth
    )
    # Key and segment as one value that is never null: the rows of a segment meet in one place for the pass and for what enters it.
    names = [f"k{i}" for i in range(len(key))]
    rows = rows.withColumn(_PLACE, F.struct(*[F.col(k).alias(n) for k, n in zip(key, names)], F.col(_SEGMENT).alias("s")))

    # One row per segment of a large key, then what enters each segment.
    named = {}
    for i, value in enumerate(carry.values()):
        named[f"__c{i}"] = F.max_by(value, F.when(value.isNotNull(), point))
    for i, value in enumerate(total.values()):
        named[f"__t{i}"] = F.sum(value)
    for i, value in enumerate(highest.values()):
        named[f"__h{i}"] = F.max(value)
    for i, value in enumerate(opening.values()):
        named[f"__o{i}"] = F.min_by(_cell(value), point)
    for i, value in enumerate(following.values()):
        named[f"__f{i}"] = F.min_by(_cell(value), point)
    for i, value in enumerate(preceding.values()):
        named[f"__p{i}"] = F.max_by(_cell(value), point)
    rollup = (
        rows.where(F.col(_CUTS).isNotNull())
        .groupBy(F.col(_PLACE).alias(_ENTERED))
        .agg(F.count(F.lit(1)).alias("__n"), *[c.alias(n) for n, c in named.items()])
    )
    along = Window.partitionBy(*[f"{_ENTERED}.{n}" for n in names]).orderBy(f"{_ENTERED}.s")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    entering = {}
    for name in named:
        if name.startswith("__c"):
            entering[name] = F.last(name, ignorenulls=True).over(before)
        elif name.startswith("__t"):
            entering[name] = F.sum(name).over(before)
        elif name.startswith("__h"):
            entering[name] = F.max(name).over(before)
        elif name.startswith("__o"):
            entering[name] = F.first(name).over(before)
        elif name.startswith("__f"):
            entering[name] = F.lead(name).over(along)
        else:
            entering[name] = F.lag(name).over(along)
    entering_rows = rollup.withColumns(entering).drop("__n")

    # The pass inside each segment.
    here = Window.partitionBy(_PLACE).orderBy(*order)
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {}
    for i, value in enumerate(carry.values()):
        local[f"__lc{i}"] = F.last(value, ignorenulls=True).over(so_far)
    for i, value in enumerate(total.values()):
        local[f"__lt{i}"] = F.sum(value).over(so_far)
    for i, value in enumerate(highest.values()):
        local[f"__lh{i}"] = F.max(value).over(so_far)
    for i, value in enumerate(opening.values()):
        local[f"__lo{i}"] = F.first(_cell(value)).over(so_far)
    for i, value in enumerate(following.values()):
        local[f"__lf{i}"] = F.lead(_cell(value)).over(here)
    for i, value in enumerate(preceding.values()):
        local[f"__lp{i}"] = F.lag(_cell(value)).over(here)

    joined = rows.withColumns(local).join(entering_rows, F.col(_PLACE) == F.col(_ENTERED), "left")
    out = {}
    for i, name in enumerate(carry):
        out[name] = F.coalesce(f"__lc{i}", f"__c{i}")
    for i, name in enumerate(total):
        inner, outer = F.col(f"__lt{i}"), F.col(f"__t{i}")
        out[name] = F.coalesce(inner + outer, inner, outer)
    for i, name in enumerate(highest):
        out[name] = F.greatest(f"__lh{i}", f"__h{i}")
    for i, name in enumerate(opening):
        out[name] = F.coalesce(f"__o{i}", f"__lo{i}")["v"]
    for i, name in enumerate(following):
        out[name] = F.coalesce(f"__lf{i}", f"__f{i}")["v"]
    for i, name in enumerate(preceding):
        out[name] = F.coalesce(f"__lp{i}", f"__p{i}")["v"]
    helpers = [*cut_key, _CUTS, _SEGMENT, _PLACE, _ENTERED, *named, *local]
    return joined.withColumns(out).drop(*helpers)


def surrogate_key(df: DataFrame, order: Sequence[str], name: str, start: int = 1, *, ranged: bool = False) -> DataFrame:
    """Number all rows densely along ``order``, which must be unique for a repeatable key.

    The input is sorted in ranges and written once; the numbers come from the written rows, so they hold
    whatever is read again. With ``ranged`` the rows already lie in ranges of the first columns of ``order``, each value of
    them in one task (``together``), and are not shuffled for it.
    """
    at = "__at"
    placed = df if ranged else df.repartitionByRange(*order)
    ranges = stage(placed.sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright(at, 33), F.col(at).bitwiseAND((1 << 33) - 1)
    sizes = ranges.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    begins = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__begin"))
    return (
        ranges.withColumn("__range", part)
        .join(F.broadcast(begins), F.col("__range") == F.col("__part"))  # a row for each written range
        .withColumn(name, F.col("__begin") + place + F.lit(start).cast("bigint"))
        .drop(at, "__range", "__part", "__begin")
    )


def version_number(
    df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "version", **scan
) -> DataFrame:
    """Number the rows of each key from 1 along ``order``."""
    return ordered_scan(df, key, order, total={name: F.lit(1).cast("bigint")}, **scan)


def sort_position(
    df: DataFrame, column: Column, ties: Sequence[str], name: str = "position"
) -> DataFrame:
    """Position of each row when the table is sorted by ``column`` as text, ties by ``ties``."""
    keyed = df.withColumn("__text", column.cast("string"))
    return surrogate_key(keyed, ["__text", *ties], name).drop("__text")
