"""How far the sources of a language are from each other, and by which terms: one-hot level products.

Terms are runs of letters A-Z (in lower case) and of all characters from U+0080. A language keeps the terms that ``least`` of its documents hold. A
group is a (language, source). A kept term of count c has the rate p = 1 + floor(SCALE * (c + PRIOR) / (N + PRIOR * V)) in a group; N is the group's
count over the V kept terms. The distance of two groups is the sum of |p - q| over all kept terms.

That sum is priced from joint tables. Each group has a column per count level above 0, which marks the terms of that count. The columns of two blocks of
groups, over a block of terms, are multiplied: the product holds how many terms have level l in one group and m in the other. Row and
column sums of the table give the terms that one of the two lacks, and what is left of V is lacked by both. Each entry counts times the difference of
its two rates. All of it is whole numbers: products are of at most ``PIECE`` terms, so exact in 32-bit floats. Terms come sorted by their
counts, so pieces of rare terms have few levels; pieces with too many are halved.

Null texts, languages and sources are read as empty. A group without terms has its distances too; a language without kept terms has distances of 0.
Repeated rows count each. An empty table gives no rows. The pairs of the sources of a language are the result itself, so they are all made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import slices, text_bytes
from ledgerloom.sinks import stage

LEAST = 30
PRIOR = 5
TOP = 50
#: Terms and groups of one product task, terms of one product, and the columns above which a product is halved.
TERMS = 16_384
GROUPS = 64
PIECE = 4_096
COLUMNS = 1_024

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def terms(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of the texts, and the text and the place among the distinct ones of each occurrence."""
    data, offsets = text_bytes(column)
    inside = _LETTER[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | begins[:-1]) if len(data) else inside)
    ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | begins[1:]) if len(data) else inside) + 1
    places = np.concatenate(([0], np.cumsum(ends - starts)))
    found = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[inside])]).dictionary_encode()
    return found.dictionary, np.searchsorted(offsets, starts, side="right") - 1, found.indices.to_numpy()


def counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 6_000_000):
                distinct, document, term = terms(part.column("text"))
                if not len(term):
                    continue
                lang, source = (part.column(c).dictionary_encode() for c in ("lang", "source"))
                group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
                width = len(distinct)
                pairs, times = np.unique(document * width + term, return_counts=True)
                keys, which = np.unique(group[pairs // width] * width + pairs % width, return_inverse=True)
                group = keys // width
                yield pa.RecordBatch.from_arrays(
                    [
                        lang.dictionary.take(pa.array(group // len(source.dictionary))),
                        source.dictionary.take(pa.array(group % len(source.dictionary))),
                        distinct.take(pa.array(keys % width)).cast(pa.string()),
                        pa.array(np.rint(np.bincount(which, times)).astype(np.int64)),
                        pa.array(np.bincount(which)),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )

    found = documents.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def rate(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(1e9 * (n + PRIOR) / (total + PRIOR * kept)), three digits at a time: no product overflows below 9e15."""
    of, left, out = total + PRIOR * kept, n + PRIOR, F.lit(1).cast("long")
    for digits in (1_000_000, 1_000, 1):
        out = out + F.call_function("div", left * 1_000, of) * digits
        left = left * 1_000 % of
    return out


def _rates(n: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """The same of arrays."""
    of, left, out = total + PRIOR * kept, n + PRIOR, 1
    for digits in (1_000_000, 1_000, 1):
        out = out + left * 1_000 // of * digits
        left = left * 1_000 % of
    return out


def _by_group(x: np.ndarray, group: np.ndarray, n: int, axis: int) -> np.ndarray:
    """Sums along an axis over columns of equal group; ``group`` is in order."""
    out = np.zeros((n, x.shape[1]) if axis == 0 else (x.shape[0], n), x.dtype)
    if len(group):
        starts = np.flatnonzero(np.concatenate(([True], np.diff(group) != 0)))
        if axis == 0:
            out[group[starts]] = np.add.reduceat(x, starts, axis=0)
        else:
            out[:, group[starts]] = np.add.reduceat(x, starts, axis=1)
    return out


def _columns(term: np.ndarray, group: np.ndarray, n: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One-hot columns of the (group, level) that occur, as a matrix over terms; the group and the level of each."""
    order = np.lexsort((n, group))
    new = np.concatenate(([True], (np.diff(group[order]) != 0) | (np.diff(n[order]) != 0))) if len(order) else np.zeros(0, bool)
    x = np.zeros((n_terms, int(new.sum())), np.float32)
    x[term[order], np.cumsum(new) - 1] = 1
    return x, group[order][new], n[order][new]


def _product(left: tuple, right: tuple, n_terms: int, totals: tuple[np.ndarray, np.ndarray], kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed differences over the terms that either of two groups holds, and the number of those, for all groups of two blocks."""
    (x, group_a, level_a), (y, group_b, level_b) = (_columns(*side, n_terms) for side in (left, right))
    a, b = len(totals[0]), len(totals[1])
    joint = np.rint(x.T @ y).astype(np.int64)
    p, q = _rates(level_a, totals[0][group_a], kept), _rates(level_b, totals[1][group_b], kept)
    p0, q0 = (_rates(np.zeros(len(t), np.int64), t, kept) for t in totals)
    n_a, n_b = x.sum(0).astype(np.int64), y.sum(0).astype(np.int64)
    there_b = _by_group(joint, group_b, b, 1)  # of each level of a: terms that each group of b holds too
    there_a = _by_group(joint, group_a, a, 0)
    price = _by_group(_by_group(joint * np.abs(p[:, None] - q), group_b, b, 1), group_a, a, 0)
    price += _by_group((n_a[:, None] - there_b) * np.abs(p[:, None] - q0), group_a, a, 0)
    price += _by_group((n_b - there_a) * np.abs(p0[:, None] - q), group_b, b, 1)
    held_a, held_b = _by_group(n_a[:, None], group_a, a, 0), _by_group(n_b[None, :], group_b, b, 1)
    return price, held_a + held_b - _by_group(there_b, group_a, a, 0)


def _task(key: tuple, rows: pa.Table, width: int, piece: int, most: int) -> pa.Table:
    """All pairs of groups of two blocks of ``width`` over a block of terms, in products of at most ``piece`` terms and about ``most`` columns.
    Rows without a term name the groups."""
    lang, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
    number, n, total = (rows.column(c).to_numpy() for c in ("number", "n", "total"))
    kept = rows.column("kept")[0].as_py()
    names = np.flatnonzero(n == 0)
    totals = []
    for block in (low, high):
        mine = names[number[names] // width == block]
        t = np.zeros(number[mine].max(initial=block * width - 1) - block * width + 1, np.int64)
        t[number[mine] - block * width] = total[mine]
        totals.append(t)
    price, held = (np.zeros((len(totals[0]), len(totals[1])), np.int64) for _ in range(2))
    there = np.flatnonzero(n > 0)
    if len(there):
        term = rows.column("term").take(pa.array(there)).combine_chunks().dictionary_encode().indices.to_numpy()
        rank = np.empty(term.max() + 1, np.int64)
        rank[np.argsort(np.bincount(term, n[there]), kind="stable")] = np.arange(len(rank))
        term = rank[term]
        order = np.argsort(term, kind="stable")
        term, group, level = term[order], number[there][order], n[there][order]
        at = 0
        while at < len(rank):
            size = min(piece, len(rank) - at)
            while True:
                a, b = np.searchsorted(term, [at, at + size])
                columns = len(np.unique(group[a:b] * (level[a:b].max(initial=0) + 1) + level[a:b]))
                if columns <= most or size <= 32:
                    break
                size //= 2
            sides = []
            for block in (low, high):
                mine = a + np.flatnonzero(group[a:b] // width == block)
                sides.append((term[mine] - at, group[mine] - block * width, level[mine]))
            more, count = _product(*sides, size, tuple(totals), kept)
            price += more
            held += count
            at += size
    i, j = np.indices(price.shape)
    i, j = i.ravel() + low * width, j.ravel() + high * width
    take = i < j
    return pa.table([pa.array([lang] * int(take.sum()), pa.string()), i[take], j[take], price.ravel()[take], held.ravel()[take]], ["lang", "a", "b", "price", "held"])


def distances(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of sources of a language, from (lang, term, number, n, total, kept) and the groups."""
    blocks = F.greatest(F.ceil(F.col("kept") / TERMS), F.lit(1)).cast("int")
    facts = kept.select("lang", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), "term", "number", "n", "total", "kept", "groups")
    named = groups.select("lang", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(None).cast("string").alias("term"), "number", F.lit(0).cast("long").alias("n"), "total", "kept", "groups")
    own = F.floor(F.col("number") / GROUPS).cast("int")
    sizes = GROUPS, PIECE, COLUMNS

    def task(key: tuple, rows: pa.Table) -> pa.Table:
        return _task(key, rows, *sizes)

    dealt = facts.unionByName(named).withColumn("other", F.explode(F.sequence(F.lit(0), F.floor((F.col("groups") - 1) / GROUPS).cast("int"))))
    tasks = dealt.select("lang", "block", F.least(own, "other").alias("low"), F.greatest(own, "other").alias("high"), "term", "number", "n", "total", "kept")
    priced = tasks.groupBy("lang", "block", "low", "high").applyInArrow(task, "lang string, a long, b long, price long, held long")
    pairs = priced.groupBy("lang", "a", "b").agg(F.sum("price").alias("price"), F.sum("held").alias("held"))
    side = lambda name: groups.select("lang", F.col("number").alias(name), F.col("source").alias(f"{name}_source"), F.col("total").alias(f"{name}_total"))
    named_pairs = pairs.join(side("a"), ["lang", "a"]).join(side("b"), ["lang", "b"]).join(groups.where("number = 0").select("lang", "kept"), "lang")
    nothing = F.lit(0).cast("long")
    apart = F.abs(rate(nothing, F.col("a_total"), F.col("kept")) - rate(nothing, F.col("b_total"), F.col("kept")))
    value = F.when(F.col("kept") == 0, nothing).otherwise(F.col("price") + (F.col("kept") - F.col("held")) * apart)
    found = named_pairs.select("lang", "a_source", "b_source", value.alias("value"))
    both = F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")), F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item")))
    return found.select("lang", F.explode(both).alias("x"), "value").select("lang", "x.source", "x.item", "value")


def audit(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): for each group all other sources of its language by distance (part ``pair``), and the ``top`` kept terms
    that it uses more than the language does by how much more (part ``term``)."""
    read = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    docs = documents.select(read(lang).alias("lang"), read(source).alias("source"), read(text).alias("text"))
    found = stage(counts(docs), "term-counts")
    of_lang = found.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs")
    kept = stage(found.drop("docs").join(of_lang, ["lang", "term"]), "kept-terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang", "term").agg(F.first("n_lang").alias("n_lang")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_lang").alias("total_lang"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    all_groups = docs.select("lang", "source").distinct()
    of_its_lang = Window.partitionBy("lang")
    groups = stage(
        all_groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select(
            "lang", "source", zero("total"), zero("kept"), zero("total_lang"),
            (F.row_number().over(of_its_lang.orderBy("source")) - 1).cast("long").alias("number"),
            F.count("*").over(of_its_lang).alias("groups"),
        ),
        "groups",
    )
    placed = kept.join(groups, ["lang", "source"])
    p, q = rate(F.col("n"), F.col("total"), F.col("kept")), rate(F.col("n_lang"), F.col("total_lang"), F.col("kept"))
    over = placed.select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where(F.col("value") > 0)

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(distances(placed, groups), "pair").unionByName(ranked(over, "term").where(F.col("rank") <= top))
