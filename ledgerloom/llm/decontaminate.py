"""Benchmark decontamination: SimHash of item-sized windows, and exact weighted-shingle similarity.

A text is contaminated by an item where some window of as many words as the item (the whole text, where it has fewer)
has a weighted Jaccard similarity of ``SIMILARITY`` or more to it, over distinct shingles of five words (the whole item, where it has fewer).
A shingle weighs log(1 + items / items that hold it); one that no item holds weighs as if one did.

Windows without enough shingles of the benchmark to reach the similarity are passed over. The others are
fingerprinted: 64 bits, each the sign of a sum over the window's words, from running sums. Fingerprints are looked up in a multi-index: the item's four
blocks of 16 bits, each with all values within ``BLOCK_RADIUS`` bits. Fingerprints within ``RADIUS`` bits agree with
the item in one block at least to that many bits, so none is missed. Candidates are verified on the shingles themselves.

The index is built from at most about ``ITEM_BYTES`` of text and ``ITEMS`` items at a time (an item takes some 40 KB of it); a larger benchmark
takes several passes, each written before the next index is built, so that driver and tasks hold one index. Items and holders are counted over the whole benchmark all the same, so passes change no similarity. Each
pass has the weights of all shingles that several items hold, 16 bytes each; others weigh as much as unknown ones.
Words are lower-cased in A-Z. Null and empty texts and items match nothing. Repeated items match each; repeated
documents give their rows each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import mix, schema_of, slices, words
from ledgerloom.operators.ordered import surrogate_key
from ledgerloom.sinks import stage

SHINGLE = 5
SIMILARITY = 0.8
BLOCK_RADIUS = 4
RADIUS = 4 * BLOCK_RADIUS + 3
ITEM_BYTES = 8_000_000
ITEMS = 2_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BITS = np.arange(64, dtype=np.uint64)


def _signs(hashes: np.ndarray) -> np.ndarray:
    return ((hashes[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BITS).sum(1, dtype=np.uint64)


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        out = out * _ODD + hashes[k : k + len(out)]
    return mix(out + np.uint64(size))


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


class Items:
    """The benchmark's shingles, weights, fingerprints and multi-index."""

    def __init__(self, ids: list, texts: list[str], shingle: int = SHINGLE, similarity: float = SIMILARITY, whole: tuple | None = None):
        """``whole``: the items of the whole benchmark, its shingles that several items hold (ascending), and how many do."""
        w = words(pa.array(texts, pa.large_string()))
        self.similarity = similarity
        self.several = whole is not None  # passes
        self.ids, self.hashes, self.sizes, self.sets = [], [], [], []
        for k, i in enumerate(ids):
            h = w.hashes[w.first[k] : w.first[k + 1]]
            if len(h):
                self.ids.append(i)
                self.hashes.append(h)
                self.sizes.append(len(h))
                self.sets.append(np.unique(_rolled(h, min(shingle, len(h)))))
        self.shingle_of = np.array([min(shingle, n) for n in self.sizes], np.int64)
        self.sizes = np.array(self.sizes, np.int64)
        every, holders = np.unique(np.concatenate(self.sets), return_counts=True) if self.sets else (np.zeros(0, np.uint64), np.zeros(0))
        total, shared, by = whole or (len(self.ids), every[holders > 1], holders[holders > 1])
        self.every, self.shared, self.weights = every, shared, np.log(1 + total / by)
        self.unknown = float(np.log(1 + total))
        self.totals = np.array([self.weight(s) for s in self.sets])
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(every >> np.uint64(42)).astype(np.int64)] = True
        self.prints = np.array([_packed(_signs(h).sum(0)[None])[0] for h in self.hashes], np.uint64)
        near = [np.uint16(sum(1 << b for b in c)) for r in range(BLOCK_RADIUS + 1) for c in combinations(range(16), r)]
        near = np.array(near, np.uint16)
        self.blocks = []
        for b in range(4):
            own = ((self.prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint16)
            values = (own[:, None] ^ near).ravel()
            order = np.argsort(values, kind="stable")
            self.blocks.append((np.searchsorted(values[order].astype(np.int32), np.arange(65537, dtype=np.int32)), np.repeat(np.arange(len(own), dtype=np.int32), len(near))[order]))
        #: By number of words: the items, and how many positions with a known shingle a window needs.
        heaviest = self.unknown or 1.0
        self.by_size = {}
        for n in np.unique(self.sizes):
            which = np.flatnonzero(self.sizes == n)
            self.by_size[int(n)] = which, max(1, int(np.ceil(similarity * self.totals[which].min() / heaviest - 1e-9)))

    def weight(self, shingles: np.ndarray) -> float:
        if not len(self.shared):
            return self.unknown * len(shingles)
        at = np.minimum(np.searchsorted(self.shared, shingles), len(self.shared) - 1)
        return float(np.where(self.shared[at] == shingles, self.weights[at], self.unknown).sum())

    def hits(self, rolled: np.ndarray) -> np.ndarray:
        """Positions whose shingle some item holds."""
        maybe = np.flatnonzero(self.filter[(rolled >> np.uint64(42)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.every, rolled[maybe]), len(self.every) - 1)
        return maybe[self.every[at] == rolled[maybe]]

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of every pair of fingerprints within the radius."""
        found = []
        for b, (starts, items) in enumerate(self.blocks):
            value = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            n = starts[value + 1] - starts[value]
            window = np.repeat(np.arange(len(prints)), n)
            item = items[np.repeat(starts[value] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
            close = _ones(prints[window] ^ self.prints[item]) <= RADIUS
            found.append(window[close].astype(np.int64) * len(self.prints) + item[close])
        both = np.unique(np.concatenate(found))
        return both // len(self.prints), both % len(self.prints)

    def matches(self, h: np.ndarray, hit: dict[int, np.ndarray]) -> list[tuple]:
        """(item id, first word, end, similarity) of the best window of each item in a text of words ``h``."""
        best: dict[int, tuple[float, int, int]] = {}
        sums = None
        for size, (which, least) in self.by_size.items():
            s = int(self.shingle_of[which[0]])
            if len(hit[s]) < least or len(h) < s:
                continue
            long = min(size, len(h))
            # windows that start near enough to a hit, by a running count of hits
            first = np.unique((hit[s][:, None] - np.arange(long - s + 1)).ravel())
            first = first[(first >= 0) & (first <= len(h) - long)]
            inside = np.searchsorted(hit[s], first + (long - s + 1)) - np.searchsorted(hit[s], first)
            first = first[inside >= least]
            if not len(first):
                continue
            if sums is None:
                sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(_signs(h), axis=0, dtype=np.int32)))
            window, item = self.near(_packed(sums[first + long] - sums[first]))
            same = self.sizes[item] == size
            for i, k in zip(first[window[same]].tolist(), item[same].tolist()):
                mine = np.unique(_rolled(h[i : i + long], s))
                common = self.weight(np.intersect1d(mine, self.sets[k], assume_unique=True))
                alike = common / (self.weight(mine) + self.totals[k] - common)
                if alike >= self.similarity - 1e-12 and (k not in best or alike > best[k][0]):
                    best[k] = alike, i, i + long
        return [(self.ids[k], a, b, x) for k, (x, a, b) in best.items()]

    def scan(self, column: pa.Array) -> list[list[tuple]]:
        """The matches of each text."""
        w = words(column)
        out: list[list[tuple]] = [[] for _ in range(len(w.first) - 1)]
        if not self.ids or not len(w.hashes):
            return out
        hits = {int(s): self.hits(_rolled(w.hashes, int(s))) for s in np.unique(self.shingle_of)}
        some = np.unique(np.concatenate(list(hits.values())))
        for d in np.unique(np.searchsorted(w.first, some, side="right") - 1).tolist():
            a, b = int(w.first[d]), int(w.first[d + 1])
            own = {s: x[np.searchsorted(x, a) : np.searchsorted(x, max(a, b - s + 1))] - a for s, x in hits.items()}
            out[d] = self.matches(w.hashes[a:b], own)
        return out


def _holders(rows: DataFrame, text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Items with words, the shingles that several of them hold, and how many do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                w = words(part.column(text))
                own = [w.hashes[a:b] for a, b in zip(w.first[:-1], w.first[1:]) if b > a]
                every = np.concatenate([np.unique(_rolled(h, min(SHINGLE, len(h)))) for h in own] or [np.zeros(0, np.uint64)])
                one = pa.nulls(len(own), pa.int64())  # an item counts as a null
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(every.view(np.int64)), one])], ["shingle"])

    counted = rows.select(text).mapInArrow(run, "shingle bigint").groupBy("shingle").count()
    found = counted.where("count > 1 OR shingle IS NULL").toArrow()
    shingle, n = found.column("shingle").combine_chunks(), found.column("count").to_numpy()
    item = shingle.is_null().to_numpy(zero_copy_only=False)
    shared = shingle.fill_null(0).to_numpy()[~item].astype(np.int64).view(np.uint64)
    order = np.argsort(shared)
    return int(n[item].sum()), shared[order], n[~item][order]


def _passes(benchmark: DataFrame, item: str, text: str, most: int, items: int = ITEMS) -> Iterator[Items]:
    """The benchmark in indexes of bounded size."""
    rows = benchmark.where(F.col(text).isNotNull()).select(item, text)
    size, count = rows.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
    n = max(-(-2 * size // most) if (size or 0) > most else 1, -(-count // items), 1)
    if n == 1:
        got = rows.orderBy(item, text).collect()  # at most ``most`` bytes of text
        yield Items([r[0] for r in got], [r[1] for r in got])
        return
    whole = _holders(rows, text)
    dealt = stage(surrogate_key(rows, [item, text], "__number").withColumn("__pass", F.col("__number") % n), "items")
    for k in range(n):
        got = dealt.where(F.col("__pass") == k).orderBy("__number").collect()  # about half of ``most`` bytes, ``items`` rows at most
        yield Items([r[0] for r in got], [r[1] for r in got], whole=whole)


def contaminated(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", most: int = ITEM_BYTES,
) -> DataFrame:
    """(key, item, first_word, end_word, similarity) of every item found in a document, its best window."""
    shape = schema_of(documents, [key], f"{item} bigint, first_word bigint, end_word bigint, similarity double")

    def one(items: Items) -> DataFrame:
        index = documents.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text):
                    found = [(d, *m) for d, ms in enumerate(index.value.scan(part.column(text))) for m in ms]
                    cols = list(zip(*found)) or [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [part.column(key).take(pa.array(cols[0], pa.int64())), *(pa.array(c, pa.int64()) for c in cols[1:4]), pa.array(cols[4], pa.float64())],
                        [key, item, "first_word", "end_word", "similarity"],
                    )

        found = documents.select(key, text).mapInArrow(run, shape)
        if items.several:
            found = stage(found, "contaminated")
            index.destroy()
        return found

    return reduce(DataFrame.unionAll, map(one, _passes(benchmark, item, item_text, most)))


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", most: int = ITEM_BYTES
) -> DataFrame:
    """The documents in which no item is found, in one pass over their texts for each index; passes meet in written tables,
    so that one index at a time is in memory."""
    share = documents.sparkSession.sparkContext.broadcast

    def one(rows: DataFrame, index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text):
                    yield part.filter(pa.array([not m for m in index.value.scan(part.column(text))], pa.bool_()))

        return rows.mapInArrow(run, documents.schema)

    index = None
    for x in _passes(benchmark, item, item_text, most):
        if index:
            documents = stage(documents, "decontaminated")
            index.destroy()
        index = share(x)
        documents = one(documents, index)
    return documents
