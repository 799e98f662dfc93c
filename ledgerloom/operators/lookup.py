"""Lookups from facts to reference tables and to versioned dimensions.

Plain lookups are plain equi-joins without hints: Catalyst broadcasts a table by its known size and AQE splits
a skewed probe side. Only the temporal lookup broadcasts, a dimension whose rows, versions per key and bytes it has counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.cleanse import starts_with_zero, time_text, to_integer
from ledgerloom.operators.ordered import UNCUT, find_cuts, ordered_scan
from ledgerloom.sinks import stage

SMALL_ROWS = 100_000
SMALL_VERSIONS = 64
SMALL_BYTES = 16_000_000
LEVELS = 16  # nested versions: powers of two of points that meet in one range


def _pairs(columns: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}


def star_lookup(fact: DataFrame, *lookups: tuple[DataFrame, str, str], how: str = "inner") -> DataFrame:
    """Join each (dimension, fact column, dimension column), one row per dimension key.

    The dimension's key column is dropped, its other columns are added.
    """
    for i, (dim, fact_column, dim_column) in enumerate(lookups):
        keyed = dim.withColumnRenamed(dim_column, f"__d{i}")
        fact = fact.join(keyed, F.col(fact_column) == F.col(f"__d{i}"), how).drop(f"__d{i}")
    return fact


def temporal_lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    at: str,
    start: str,
    end: str,
    bring: Sequence[str] | Mapping[str, str],
    *,
    tie: Sequence[str] = (),
    closed: bool = False,
    how: str = "left",
    flat: bool | Column = False,
    small_rows: int = SMALL_ROWS,
    small_versions: int = SMALL_VERSIONS,
    **scan,
) -> DataFrame:
    """Add the columns ``bring`` of the dimension version valid at ``at``.

    Valid means start <= at < end, or at <= end with ``closed``; a null end is open. Of several versions
    valid at ``at`` the one that started last wins (then by ``tie``), so a fact row has at most one match
    and is never multiplied. ``on`` and ``bring`` are names, or {fact name: dimension name} and
    {new name: dimension name}. The columns are those of the fact, then those of ``bring``.

    A small dimension (counted: few rows, few versions per key, few bytes) is broadcast and the fact is
    not shuffled. Any other is merged with the facts in one ordered scan per key: no fact row is
    paired with versions it does not match, and a key with very many facts is cut into segments.
    With ``flat`` the caller knows that the versions of a key do not overlap, as those of ``scd2`` and ``replay`` do not, and the
    dimension is not searched for nested ones; as a column of the dimension it says so of the keys where it holds.
    """
    on, bring = _pairs(on), _pairs(bring)
    spans = _spans(dim, on, start, end, bring, tie, closed, flat, small_rows, small_versions, scan)
    return _look_up(fact, spans, on, at, bring, how, scan)


def _look_up(fact: DataFrame, spans: tuple[list[str], DataFrame, bool], on: Mapping[str, str], at: str, bring: Sequence[str], how: str, scan) -> DataFrame:
    keys, dims, small = spans
    if small:
        found = _lookup_small(fact, dims, on, keys, at, how)
    else:
        found = _lookup_scan(fact, dims, on, keys, at, how, scan)
    kept = [c for c in fact.columns if c not in bring]
    return found.select(*kept, *[F.col(f"__row.{n}").alias(n) for n in bring])


@dataclass(frozen=True)
class Versions:
    """A versioned dimension and how facts look it up: see ``temporal_lookup``."""

    dim: DataFrame
    on: Sequence[str] | Mapping[str, str]
    start: str
    end: str
    bring: Sequence[str] | Mapping[str, str]
    tie: Sequence[str] = ()
    flat: bool = False


def temporal_lookups(fact: DataFrame, at: str, row_key: Sequence[str], *versions: Versions, small_rows: int = SMALL_ROWS, unique: bool = False, **scan) -> DataFrame:
    """``temporal_lookup`` of several dimensions at once, each with its own validity; facts without a match stay.

    Small dimensions are broadcast. For the others only what the lookups need (``row_key``, keys and day) passes through the ordered
    scans, and what they bring is joined to the facts once: however many large dimensions there are, the wide facts are shuffled once.
    ``row_key`` spreads the rows of that join and need not be unique; with ``unique`` the caller knows that it is one column of whole
    numbers that differ (written row numbers), and the join takes nothing else. ``fact`` is read twice, so it should be a written table.
    """
    needed, found = list(dict.fromkeys([*row_key, at])), []
    for v in versions:
        on, bring = _pairs(v.on), _pairs(v.bring)
        keys, dims, small = _spans(v.dim, on, v.start, v.end, bring, v.tie, False, v.flat, small_rows, SMALL_VERSIONS, scan)
        found.append((on, bring, keys, dims, small))
        needed += [] if small else [c for c in on if c not in needed]
    large = [x for x in found if not x[-1]]
    out = fact
    if large:
        narrow = fact.select(*needed) if unique else stage(fact.select(*needed).distinct(), "narrow")
        for i, (on, bring, keys, dims, _) in enumerate(large):
            narrow = narrow if i == 0 else stage(narrow, "narrow")
            # The keys of a dimension that is done are left out where the join does not take them.
            kept = [c for c in narrow.columns if not unique or c not in on or any(c in x[0] for x in large[i + 1 :])]
            seen = _lookup_scan(narrow, dims, on, keys, at, "left", scan)
            narrow = seen.select(*kept, *[F.col(f"__row.{n}").alias(f"__new_{n}") for n in bring])
        brought = [n for _, bring, *_ in large for n in bring]
        needed = list(row_key) if unique else needed
        theirs = narrow.select(*[F.col(c).alias(f"__at_{c}") for c in needed], *[f"__new_{n}" for n in brought])
        same = F.lit(True)
        for c in needed:
            same = same & F.col(c).eqNullSafe(F.col(f"__at_{c}"))
        out = fact.drop(*brought).join(theirs, same, "left").drop(*[f"__at_{c}" for c in needed]).withColumnsRenamed({f"__new_{n}": n for n in brought})
    for on, bring, keys, dims, small in found:
        if small:
            kept = [c for c in out.columns if c not in bring]
            out = _lookup_small(out, dims, on, keys, at, "left").select(*kept, *[F.col(f"__row.{n}").alias(n) for n in bring])
    return out.select(*[c for c in fact.columns if c in out.columns and not any(c in x[1] for x in found)], *[n for x in found for n in x[1]])


def _spans(dim, on, start, end, bring, tie, closed, flat, small_rows, small_versions, scan) -> tuple[list[str], DataFrame, bool]:
    """Key columns, spans (keys, __t, __end, __tie, __row) that do not overlap within a key, and whether they are small."""
    keys = [f"__k{i}" for i in range(len(on))]
    dims = dim.select(
        *[F.col(d).alias(k) for k, d in zip(keys, on.values())],
        _moment(F.col(start), 0, closed).alias("__t"),
        _moment(F.col(end), 1, closed).alias("__end"),
        F.struct(F.lit(0), *tie).alias("__tie"),
        F.struct(*[F.col(d).alias(n) for n, d in bring.items()]).alias("__row"),
        *([flat.alias("__flat")] if isinstance(flat, Column) else []),
    ).dropna(subset=[*keys, "__t"])
    known = F.coalesce("__flat", F.lit(False))
    dims = dims.where(F.col("__end").isNull() | (F.col("__end") > F.col("__t")))
    large = {n: v for n, v in scan.items() if n == "rows_per_task"}
    nested = F.lit(False)
    if isinstance(flat, Column):
        searched = _marked(dims.where(~known).drop("__flat"), keys, **large)
        dims = stage(searched.unionByName(dims.where(known).drop("__flat").withColumn("__inner", F.lit(False))), "marked")
        nested = F.bool_or("__inner")
    elif not flat:
        dims, nested = stage(_marked(dims, keys, **large), "marked"), F.bool_or("__inner")
    sizes = dims.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json("__row"))).alias("b"), nested.alias("nested")
    )
    rows, most, size, few, many = sizes.agg(
        F.sum("n"), F.max("n"), F.sum("b"), F.bool_or(F.col("nested") & (F.col("n") <= small_versions)), F.bool_or(F.col("nested") & (F.col("n") > small_versions))
    ).first()
    dims = dims.drop("__inner")
    if few or many:
        which = stage(sizes.where("nested").select(*keys, "n"), "nested")
        parts = [dims.join(which, keys, "left_anti")]
        if few:
            parts.append(_disjoint_few(dims.join(which.where(F.col("n") <= small_versions), keys, "left_semi"), keys))
        if many:
            parts.append(disjoint(dims.join(which.where(F.col("n") > small_versions), keys, "left_semi"), keys, **large))
        for part in parts[1:]:
            parts[0] = parts[0].unionByName(part)
        dims = stage(parts[0], "spans")
    return keys, dims, (rows or 0) <= small_rows and (most or 0) <= small_versions and (size or 0) <= SMALL_BYTES


def _moment(value: Column, after: int, closed: bool = True) -> Column:
    """A point of time; with ``closed`` that point or just after it, as what holds up to an end, that included, ends just after it."""
    return F.when(value.isNotNull(), F.struct(value.alias("t"), F.lit(after).alias("after"))) if closed else value


def _like(dims: DataFrame, value: Column) -> Column:
    """A point of time of a fact, to compare with those of the spans."""
    return _moment(value, 0, isinstance(dims.schema["__t"].dataType, T.StructType))


def disjoint(versions: DataFrame, keys: Sequence[str], levels: int = LEVELS, **scan) -> DataFrame:
    """Versions (keys, __t, __end, __tie, __row) cut into spans that do not overlap within a key, each with the
    version that started last of those valid in it.

    The distinct starts and ends of a key are numbered by an ordered scan. A version covers a range of these numbers, which is
    cut into at most two aligned ranges of each power of two; of the versions with one such range only the last counts, by an aggregate.
    A point then takes the last of what covers it: one aligned range of each size. So n versions make some n log n rows,
    none of them an array, and at most 2 ** ``levels`` points meet in one range: what covers more is first
    handed down to ranges of that size.
    """
    points = versions.select(*keys, F.explode(F.array("__t", "__end")).alias("__p")).where("__p IS NOT NULL").distinct()
    numbered = ordered_scan(points, keys, ["__p"], total={"__pos": F.lit(1).cast("bigint")}, following={"__to": "__p"}, **scan)
    points = stage(numbered, "points")
    top = (points.agg(F.max("__pos")).first()[0] or 0).bit_length()

    def position(of: str, name: str) -> DataFrame:
        return points.select(*keys, F.col("__p").alias(of), F.col("__pos").alias(name))

    begun = versions.join(position("__t", "__lo"), [*keys, "__t"])
    ended = begun.where("__end IS NOT NULL").join(position("__end", "__hi"), [*keys, "__end"])
    placed = ended.unionByName(begun.where("__end IS NULL").withColumn("__hi", F.lit(1 << top).cast("bigint")))
    ranges = []
    for k in range(top + 1):
        first, last = F.shiftright(F.col("__lo") + ((1 << k) - 1), k), F.shiftright("__hi", k)
        ranges.append(F.when((first < last) & (first % 2 == 1), _range(k, first)))
        ranges.append(F.when((first < last) & (last % 2 == 1), _range(k, last - 1)))
    version = F.struct("__t", "__tie", "__end", "__row").alias("__v")
    covered = placed.select(*keys, version, F.inline(F.filter(F.array(*ranges), lambda r: r.isNotNull())))
    latest = covered.groupBy(*keys, "__level", "__range").agg(F.max("__v").alias("__v"))

    if top > levels:
        latest = stage(latest, "ranges")
        parts = points.select(*keys, F.shiftright("__pos", levels).alias("__part")).distinct()
        wider = F.array(*[_range(k, F.shiftright("__part", k - levels)) for k in range(levels + 1, top + 1)])
        above = parts.select(*keys, "__part", F.inline(wider)).join(latest, [*keys, "__level", "__range"])
        down = above.select(*keys, F.lit(levels).alias("__level"), F.col("__part").alias("__range"), "__v")
        both = latest.where(F.col("__level") <= levels).unionByName(down)
        latest = both.groupBy(*keys, "__level", "__range").agg(F.max("__v").alias("__v"))

    around = F.array(*[_range(k, F.shiftright("__pos", k)) for k in range(min(top, levels) + 1)])
    met = points.select(*keys, "__p", "__to", F.inline(around)).join(latest, [*keys, "__level", "__range"])
    spans = met.groupBy(*keys, "__p", "__to").agg(F.max("__v").alias("__v"))
    return spans.select(*keys, F.col("__p").alias("__t"), F.col("__to").alias("__end"), F.col("__v.__tie").alias("__tie"), F.col("__v.__row").alias("__row"))


def _disjoint_few(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``disjoint`` for keys of few versions (counted by the caller): each key is one row with a short array."""
    version = F.struct("__t", "__tie", "__end", "__row")
    held = versions.groupBy(*keys).agg(F.collect_list(version).alias("__vs"))
    ends = F.filter(F.transform("__vs", lambda v: v["__end"]), lambda e: e.isNotNull())
    held = held.withColumn("__ps", F.array_sort(F.array_distinct(F.concat(F.transform("__vs", lambda v: v["__t"]), ends))))
    points = held.select(*keys, "__vs", "__ps", F.posexplode("__ps").alias("__i", "__p"))
    valid = F.filter("__vs", lambda v: (v["__t"] <= F.col("__p")) & (v["__end"].isNull() | (v["__end"] > F.col("__p"))))
    spans = points.select(*keys, "__p", F.get("__ps", F.col("__i") + 1).alias("__to"), F.array_max(valid).alias("__v")).where("__v IS NOT NULL")
    return spans.select(*keys, F.col("__p").alias("__t"), F.col("__to").alias("__end"), F.col("__v.__tie").alias("__tie"), F.col("__v.__row").alias("__row"))


def _range(level: int, number: Column) -> Column:
    """The range of 2 ** level positions of this number."""
    return F.struct(F.lit(level).alias("__level"), number.alias("__range"))


def _marked(versions: DataFrame, keys: Sequence[str], **scan) -> DataFrame:
    """Which versions end inside an earlier one before the next begins, or cannot be told from one by start and tie.

    Where no version does, the one that began last before a moment is the only one that can be found there, ended or not: what it
    leaves open up to the next start no earlier one fills. Versions that overlap otherwise (several histories under one key) need no cutting.
    """
    end = F.struct(F.col("__end").isNull().alias("open"), F.col("__end").alias("end"))
    point = F.struct("__t", "__tie")
    seen = ordered_scan(
        versions, keys, ["__t", "__tie"], highest={"__last": end}, preceding={"__prior": point}, following={"__next": "__t"}, **scan
    )
    left_open = F.col("__end").isNotNull() & (F.col("__next").isNull() | (F.col("__next") > F.col("__end")))
    inner = left_open & (F.col("__last") > end) | F.coalesce(F.col("__prior") == point, F.lit(False))
    return seen.withColumn("__inner", inner).drop("__last", "__prior", "__next")


def _lookup_small(fact, dims, on, keys, at, how) -> DataFrame:
    cut = ordered_scan(dims, keys, ["__t", "__tie"], following={"__next": "__t"}, cuts=UNCUT)
    cut = cut.drop("__tie")
    moment = _like(dims, F.col(at))
    condition = (moment >= F.col("__t")) & (F.col("__next").isNull() | (moment < F.col("__next")))
    condition = condition & (F.col("__end").isNull() | (moment < F.col("__end")))
    for name, key in zip(on, keys):
        condition = condition & (F.col(name) == F.col(key))
    return fact.join(F.broadcast(cut), condition, how)


def _lookup_scan(fact, dims, on, keys, at, how, scan) -> DataFrame:
    """Facts and versions in one ordered scan. The columns of the key, and the hash that tells facts of one moment apart (only cut
    points need it), do not go through the shuffle beside the key itself."""
    twice = {name: k for name, k in zip(on, keys) if fact.schema[name].dataType == dims.schema[k].dataType}
    facts = fact.select(
        *[c for c in fact.columns if c not in twice],
        *[F.col(name).alias(k) for name, k in zip(on, keys)],
        _like(dims, F.col(at)).alias("__t"),
        F.lit(1).alias("__kind"),
    )
    spread = F.xxhash64(*[c for c in facts.columns if c not in ("__t", "__kind")])
    order = ["__t", "__kind", "__tie", "__spread"]
    versions = dims.withColumn("__kind", F.lit(0))
    cuts = scan.get("cuts") or find_cuts(
        facts.withColumn("__spread", spread).unionByName(versions.withColumn("__spread", F.lit(0).cast("bigint")), allowMissingColumns=True),
        keys, order, **{n: v for n, v in scan.items() if n == "rows_per_task"},
    )
    if cuts.table is None:
        order = order[:-1]
    else:
        facts, versions = facts.withColumn("__spread", spread), versions.withColumn("__spread", F.lit(0).cast("bigint"))
    merged = facts.unionByName(versions, allowMissingColumns=True)
    version = F.when(F.col("__kind") == 0, F.struct("__row", "__end"))
    seen = ordered_scan(merged, keys, order, carry={"__seen": version}, cuts=cuts).where(F.col("__kind") == 1)
    valid = F.col("__seen").isNotNull() & F.col("__t").isNotNull()
    valid = valid & (F.col("__seen.__end").isNull() | (F.col("__t") < F.col("__seen.__end")))
    seen = seen.drop("__row").withColumn("__row", F.when(valid, F.col("__seen.__row")))
    seen = seen.withColumns({name: F.col(k) for name, k in twice.items()})
    return seen.where(valid) if how == "inner" else seen


def id_or_name_lookup(
    fact: DataFrame,
    dim: DataFrame,
    ref: str,
    id_column: str,
    name_column: str,
    bring: Sequence[str],
    *,
    at: str | None = None,
    start: str | None = None,
    end: str | None = None,
    tie: Sequence[str] = (),
    how: str = "inner",
) -> DataFrame:
    """Match references that begin with 0 by number and all others by right-trimmed name.

    Both kinds share one lookup, by a key that says which kind it is. With ``at`` the dimension is versioned by ``start``
    and ``end``, and of several rows with one name the latest start wins; without it, it must hold one row per number and per name.
    """
    if at is not None:
        return IdOrName(dim, id_column, name_column, bring, start, end, tie).look_up(fact, ref, at, how)
    rows = fact.withColumn("__ref", _reference(ref))
    rows, keyed, condition = _apart(rows, _by_number_and_name(dim, id_column, name_column).select("__tag", *bring), ["__ref"])
    found = rows.join(keyed, condition & (F.col("__ref") == F.col("__tag")), how).drop("__tag", "__apart", "__whole")
    return found.drop("__ref")


class IdOrName:
    """A versioned dimension made ready for ``id_or_name_lookup``, for several tables of facts.

    Where versions overlap they are searched and cut once. With ``flat_ids`` the caller knows that the versions of one number
    do not overlap, as those of ``scd2`` do not; then only those of one name are searched.
    """

    def __init__(
        self, dim: DataFrame, id_column: str, name_column: str, bring: Sequence[str], start: str, end: str, tie: Sequence[str] = (),
        flat_ids: bool = False,
    ):
        self.bring = _pairs(bring)
        flat = F.startswith("__tag", F.lit("#")) if flat_ids else False
        keyed = _by_number_and_name(dim, id_column, name_column)
        self.spans = _spans(keyed, {"__ref": "__tag"}, start, end, self.bring, tie, False, flat, SMALL_ROWS, SMALL_VERSIONS, {})

    def look_up(self, fact: DataFrame, ref: str, at: str, how: str = "inner") -> DataFrame:
        rows = fact.withColumn("__ref", _reference(ref))
        return _look_up(rows, self.spans, {"__ref": "__tag"}, at, self.bring, how, {}).drop("__ref")


def _reference(ref: str) -> Column:
    return F.when(starts_with_zero(ref), _tagged(to_integer(ref).cast("string"), True)).otherwise(_tagged(F.rtrim(ref), False))


def _by_number_and_name(dim: DataFrame, id_column: str, name_column: str) -> DataFrame:
    return dim.withColumn("__tag", F.explode(F.array(_tagged(F.col(id_column).cast("string"), True), _tagged(F.col(name_column), False))))


def _tagged(value: Column, number: bool) -> Column:
    """A key that tells numbers from names, so both are looked up at once."""
    return F.concat(F.lit("#" if number else "="), value)


def lookup_default(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    key: str,
    name: str,
    default: int = -1,
) -> DataFrame:
    """Add column ``name`` with the dimension's ``key``, or ``default`` where nothing matches."""
    pairs = {f"__d{i}": d for i, d in enumerate(on.values())}
    keyed = dim.select(*[F.col(d).alias(n) for n, d in pairs.items()], F.col(key).alias("__key"))
    fact, keyed, condition = _apart(fact, keyed, list(on))
    for fact_column, dim_column in zip(on, pairs):
        condition = condition & (F.col(fact_column) == F.col(dim_column))
    return (
        fact.join(keyed, condition, "left")
        .withColumn(name, F.coalesce("__key", F.lit(default)))
        .drop(*pairs, "__key", "__apart", "__whole")
    )


def _apart(fact: DataFrame, keyed: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame, Column]:
    """A join column that spreads the rows with a null key, which match nothing, over the tasks."""
    null = F.greatest(*[F.col(c).isNull() for c in columns]) if len(columns) > 1 else F.col(columns[0]).isNull()
    spread = F.when(null, F.xxhash64(*fact.columns)).otherwise(F.lit(0).cast("bigint"))
    keyed = keyed.withColumn("__whole", F.lit(0).cast("bigint"))
    return fact.withColumn("__apart", spread), keyed, F.col("__apart") == F.col("__whole")


def derived_key(columns: Sequence[Column | str]) -> Column:
    """The upper-cased concatenation of the columns, nulls as blank."""
    return F.upper(F.concat_ws("", *columns))


def enrich_on(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: Column,
    when: Column,
    bring: Sequence[str],
    prefer: Sequence[str],
) -> DataFrame:
    """Add ``bring`` from the row of ``right`` with the same derived key, only where ``when`` holds.

    Of several right rows with one key the first by ``prefer`` is taken, so no left row is
    multiplied. Left rows that take no part get a key of their own that matches nothing, so they
    spread over the tasks and do not pile up under null.
    """
    one = right.groupBy(right_key.alias("__right")).agg(
        F.min_by(F.struct(*bring), F.struct(*prefer)).alias("__row")
    )
    apart = F.concat(F.lit("\0"), F.xxhash64(*left.columns).cast("string"))
    keyed = left.withColumn("__left", F.when(when & left_key.isNotNull(), left_key).otherwise(apart))
    return (
        keyed.join(one, F.col("__left") == F.col("__right"), "left")
        .withColumns({c: F.col(f"__row.{c}") for c in bring})
        .drop("__left", "__right", "__row")
    )


def code_lookup(
    fact: DataFrame, codes: DataFrame, column: str, code: str, bring: Mapping[str, str]
) -> DataFrame:
    """Left lookup of one code column; call it again for a second column of the same table."""
    keyed = codes.select(F.col(code).alias("__code"), *[F.col(c).alias(n) for n, c in bring.items()])
    fact, keyed, condition = _apart(fact, keyed, [column])
    return fact.join(keyed, condition & (F.col(column) == F.col("__code")), "left").drop("__code", "__apart", "__whole")


def date_time_keys(
    fact: DataFrame,
    ts: str,
    dates: DataFrame,
    date_value: str,
    date_key: str,
    times: DataFrame | None = None,
    time_value: str | None = None,
    time_key: str | None = None,
    *,
    date_name: str = "date_key",
    time_name: str = "time_key",
    how: str = "inner",
) -> DataFrame:
    """Add the calendar key of the date part and, with ``times``, the clock key of the time part."""
    days = dates.select(F.col(date_value).alias("__day"), F.col(date_key).alias(date_name))
    fact = fact.join(days, F.to_date(ts) == F.col("__day"), how).drop("__day")
    if times is None:
        return fact
    clock = times.select(F.col(time_value).alias("__clock"), F.col(time_key).alias(time_name))
    return fact.join(clock, time_text(ts) == F.col("__clock"), how).drop("__clock")


def semi_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Left rows whose key exists on the right."""
    keys = right.select(F.col(right_on).alias("__right"))
    return left.join(keys, F.col(left_on) == F.col("__right"), "left_semi")


def merge_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """The inner join of two differently named tables on one column each."""
    return left.join(right, F.col(left_on) == F.col(right_on), "inner")
