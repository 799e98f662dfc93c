"""N-gram Jaccard join with PartEnum signatures, and the classes of its links.

Words are lower-cased in A-Z; the set of a document is its distinct shingles of five words (with fewer, the whole sequence).
Two sets link when their Jaccard similarity is 4/5 or more. Sizes are cut into bands such that linked sets
lie in one band or in two neighbours; a window is two neighbouring bands, and a set takes part in the windows of its band. Linked sets of a window
with sizes up to ``r`` differ in at most ``k = 2r/9`` shingles. The domain is partitioned into ``k + 1 + spare`` parts: at
most ``k`` hold a difference, so ``spare + 1`` or more agree. The signatures of a set are the hashes of its non-empty parts. A set with
more than ``spare`` empty parts might agree in those alone: it takes part in a second partition too, and so on; what is left after
``SEEDS`` partitions also gives its prefix, which linked sets share. So every link has a common signature, at any size.

Linked sets agree in more signatures than one: in all parts but those of a difference and the empty ones. That bound, from
their sizes, is asked of each pair before its sets are compared (in full, on the shingles). First every set is compared with the
smallest id it shares most signatures with: copies meet in one class, so their groups are not paired. Then pairs of different classes are counted in
groups of at most ``SMALL`` equal signatures, so a signature takes part in a bounded number of them. Larger groups are not paired: those
that still hold several classes are compared whole, in blocks
of at most ``BLOCK`` sets, by lists of the sets that hold each shingle, and only links between classes come out. A pair that shares a
signature of a large group is compared there, any other has all its signatures counted: none is left out. Copies are one set from the start.

Null, empty and blank texts have an empty set and link with nothing. Rows of one id are one document: they are joined. A null id
links with nothing and has a null class. Ids are integers; a repeated id is compared by each of its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.graph import components, filter_of
from ledgerloom.llm.text import give_back, mix, shingles, slices, words
from ledgerloom.sinks import stage

SEEDS = 8
SPARE = 0.08
BLOCK = 2_048
SMALL = 64
PART = 50_000  # rows of groups counted at a time
STAR = 0.5  # share of the signatures asked of a link at which a set is compared with the smallest id it shares them with
DEALT = 8  # tasks that share the groups of one smallest id


def _edges(most: int = 1 << 40) -> np.ndarray:
    """First sizes of the bands: the sizes that link with a band reach into the next one at most."""
    out = [1, 2]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, 5 * (out[-1] - 1) // 4 + 1))
    return np.array(out, np.int64)


BANDS = _edges()


def _plan(window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts of each window (bands ``window`` and the next one), and how many of them may be empty."""
    k = 2 * (BANDS[window + 2] - 1) // 9
    spare = np.where(k > 0, np.maximum(1, np.ceil(SPARE * k)), 0).astype(np.int64)
    return k + 1 + spare, spare


def _level(h: np.ndarray, sizes: np.ndarray, window: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of one partition, the set of each, and which sets have too many empty parts. ``h``: the sets, one after another."""
    parts, spare = _plan(window)
    base = np.concatenate(([0], np.cumsum(parts)))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    salted = mix(h + np.uint64((2 * seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    part = ((salted >> np.uint64(32)) * parts[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64) + base[owner]
    total = np.zeros(base[-1], np.uint64)
    np.add.at(total, part, mix(salted ^ h))
    full = np.zeros(base[-1], bool)
    full[part] = True
    at = np.flatnonzero(full)
    whose = np.searchsorted(base, at, side="right") - 1
    label = (at - base[whose]).astype(np.uint64) + (window[whose].astype(np.uint64) << np.uint64(40)) + (np.uint64(seed) << np.uint64(56))
    empty = parts - np.bincount(whose, minlength=len(sizes))
    return mix(total[at] + mix(label)), whose, empty > spare


def signatures(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) for distinct shingles ``h``, the sets one after another from ``first`` (one more entry than sets)."""
    sizes = np.diff(first)
    band = np.searchsorted(BANDS, sizes, side="right") - 1
    found: list[np.ndarray] = []
    whose: list[np.ndarray] = []
    for step in (0, 1):
        keep = np.flatnonzero((sizes > 0) & (band >= step))
        for seed in range(SEEDS):
            if not len(keep):
                break
            place = np.repeat(first[keep] - np.concatenate(([0], np.cumsum(sizes[keep])[:-1])), sizes[keep]) + np.arange(sizes[keep].sum())
            s, w, again = _level(h[place], sizes[keep], band[keep] - step, seed)
            found.append(s)
            whose.append(keep[w])
            keep = keep[again]
        for d in keep:  # no partition suits: the prefix of the set in the order of the hashes
            own = np.sort(h[first[d] : first[d + 1]])
            own = own[: len(own) - -(-4 * len(own) // 5) + 1]
            found.append(mix(own + np.uint64(255)))
            whose.append(np.full(len(own), d))
    return (np.concatenate(found), np.concatenate(whose)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _span(band: np.ndarray) -> np.ndarray:
    """Most differences of linked sets in the window that begins at a band."""
    return 2 * (BANDS[band + 2] - 1) // 9


def agreements(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Signatures of the first partition that linked sets of sizes a and b share at least, if not more parts are empty than allowed."""
    a, b = np.minimum(a, b), np.maximum(a, b)
    low, high = (np.searchsorted(BANDS, x, side="right") - 1 for x in (a, b))
    differ = (a + b) // 9
    upper = np.maximum(1, _span(low) + 1 - differ)
    lower = np.where((low == high) & (low > 0), np.maximum(1, _span(np.maximum(low, 1) - 1) + 1 - differ), 0)
    return upper + lower


def least_agreements(n: np.ndarray) -> np.ndarray:
    """The same for a set of size n and whatever it may link with."""
    band = np.searchsorted(BANDS, n, side="right") - 1
    most, least = 5 * n // 4, -(-4 * n // 5)
    out = agreements(n, np.minimum(most, BANDS[band + 1] - 1))  # the largest of its own band
    out = np.where(most >= BANDS[band + 1], np.minimum(out, agreements(n, np.maximum(most, BANDS[band + 1]))), out)
    below = np.maximum(1, np.minimum(n, BANDS[band] - 1))
    return np.where(least < BANDS[band], np.minimum(out, agreements(below, n)), out)


def sparse(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which sets have more empty parts than allowed in a first partition."""
    sizes = np.diff(first)
    band = np.searchsorted(BANDS, sizes, side="right") - 1
    out = np.zeros(len(sizes), bool)
    for step in (0, 1):
        keep = np.flatnonzero((sizes > 0) & (band >= step))
        if len(keep):
            place = np.repeat(first[keep] - np.concatenate(([0], np.cumsum(sizes[keep])[:-1])), sizes[keep]) + np.arange(sizes[keep].sum())
            out[keep] |= _level(h[place], sizes[keep], band[keep] - step, 0)[2]
    return out


def shingle_sets(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and where each set begins."""
    w = words(column)
    h, first = shingles(w.hashes, w.first, size)
    sets = [np.unique(h[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    return (np.concatenate(sets) if sets else h), np.concatenate(([0], np.cumsum([len(s) for s in sets], dtype=np.int64)))


def _digests(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for each set."""
    total = np.concatenate((np.zeros((1, 2), np.uint64), np.cumsum(np.column_stack([mix(h), mix(h ^ np.uint64(0x5555555555555555))]), axis=0, dtype=np.uint64)))
    both = total[first[1:]] - total[first[:-1]]
    return mix(both[:, 0] + np.diff(first).astype(np.uint64)).astype(np.int64), mix(both[:, 1]).astype(np.int64)


def _sets(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(id, n, h1, h2, sparse, least) of every document; ``least``: the signatures it shares with any that it links with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, first = shingle_sets(part.column("text"))
                n, few = np.diff(first), sparse(h, first)
                least = np.where(few, 1, least_agreements(np.maximum(1, n)))
                cols = [part.column("id"), *(pa.array(x) for x in (n, *_digests(h, first), few, least))]
                yield pa.RecordBatch.from_arrays(cols, ["id", "n", "h1", "h2", "sparse", "least"])

    return documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id long, n long, h1 long, h2 long, sparse boolean, least long"
    )


def _signed(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(sig, id): of copies that meet in one batch, the smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, first = shingle_sets(part.column("text"))
                ids = part.column("id").to_numpy(zero_copy_only=False)
                h1, h2 = _digests(h, first)
                order = np.lexsort((ids, h2, h1))
                new = (np.diff(h1[order], prepend=~h1[order[:1]]) != 0) | (np.diff(h2[order], prepend=0) != 0) if len(order) else np.zeros(0, bool)
                alone = np.sort(order[new])
                sizes = np.diff(first)[alone]
                place = np.repeat(first[:-1][alone] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
                s, w = signatures(h[place], np.concatenate(([0], np.cumsum(sizes))))
                ids = ids[alone]
                for a in range(0, len(s), 200_000):
                    yield pa.RecordBatch.from_arrays([pa.array(s[a : a + 200_000].astype(np.int64)), pa.array(ids[w[a : a + 200_000]])], ["sig", "id"])

    rows = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    return rows.mapInArrow(run, "sig long, id long")


def _shared(signed: DataFrame) -> DataFrame:
    """(sig, id, first) of signatures that several ids have; ``first`` is the smallest. Runs of a sorted partition pass by, none is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head, opened = None, 0, False
        for batch in batches:
            sig, ids = batch.column("sig").to_numpy(), batch.column("id").to_numpy()
            if not len(sig):
                continue
            new = np.concatenate(([sig[0] != last], sig[1:] != sig[:-1]))
            run_of = np.cumsum(new) - 1 + (not new[0])  # 0 is the run carried over, if any
            starts = np.flatnonzero(new)
            heads = np.concatenate((np.array([] if new[0] else [head], np.int64), ids[starts]))
            first = heads[run_of]
            other = ids != first
            other[1:] &= ~((sig[1:] == sig[:-1]) & (ids[1:] == ids[:-1]))
            many = np.zeros(len(heads), bool)
            many[run_of[other]] = True
            out_sig, out_id, out_first = sig[other], ids[other], first[other]
            fresh = many.copy()
            if not new[0] and opened:
                fresh[0] = False
            values = np.concatenate((np.array([] if new[0] else [last], np.int64), sig[starts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((values[fresh], out_sig))), pa.array(np.concatenate((heads[fresh], out_id))), pa.array(np.concatenate((heads[fresh], out_first)))],
                ["sig", "id", "first"],
            )
            opened = bool(many[-1]) or (opened and len(heads) == 1 and not new[0])
            last, head = int(sig[-1]), int(heads[-1])
        give_back()

    parts = int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return signed.repartition(parts, "sig").sortWithinPartitions("sig", "id").mapInArrow(run, "sig long, id long, first long")


def _fits(pairs: DataFrame, bounds: DataFrame, share: float = 1.0) -> DataFrame:
    """The pairs (a, b, times) whose sizes allow a link and that share enough signatures for one, or ``share`` of that. An id with several
    texts (``many``) has no one size: its pairs stay."""

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, times = (batch.column(c).to_numpy() for c in ("n", "m", "times"))
            both, many = (np.array(batch.column(c).to_numpy(zero_copy_only=False), bool) for c in ("both", "many"))
            keep = (4 * np.maximum(n, m) <= 5 * np.minimum(n, m)) & (times >= share * np.where(both, 1, agreements(n, m)))
            yield batch.select(["a", "b"]).filter(pa.array(keep | many))

    one = bounds.select(F.col("id").alias("a"), "n", F.col("sparse").alias("s"), F.col("many").alias("x"))
    two = bounds.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("sparse").alias("t"), F.col("many").alias("y"))
    sized = pairs.join(one, "a").join(two, "b").select("a", "b", "n", "m", "times", (F.col("s") & F.col("t")).alias("both"), (F.col("x") | F.col("y")).alias("many"))
    return sized.mapInArrow(enough, "a long, b long")


def _pairs(groups: DataFrame, bounds: DataFrame) -> DataFrame:
    """Pairs (a, b) of ids of different classes that share enough signatures of small groups to link, from (sig, id, first, root). Groups with
    one smallest id come together, so most of a pair's signatures are counted in one task; parts of a task's rows are counted one after another."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: pa.Table) -> pa.RecordBatch:
            sig, ids, root = (rows.column(c).to_numpy() for c in ("sig", "id", "root"))
            names, place = np.unique(ids, return_inverse=True)
            begins = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
            size = np.diff(np.append(begins, len(sig)))
            rank = np.arange(len(sig)) - np.repeat(begins, size)
            keys = []
            for back in range(1, int(size.max())):  # each row with the one so many rows before it
                at = np.flatnonzero(rank >= back)
                at = at[root[at] != root[at - back]]
                keys.append(place[at - back] * len(names) + place[at])
            pairs, times = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(names[pairs // len(names)]), pa.array(names[pairs % len(names)]), pa.array(times)], ["a", "b", "times"])

        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if held.num_rows >= PART:
                sig = held.column("sig").to_numpy()
                before = np.flatnonzero(sig != sig[-1])
                if len(before):
                    end = int(before[-1]) + 1
                    yield flush(held.slice(0, end).combine_chunks())
                    held = held.slice(end).combine_chunks()
        if held is not None and held.num_rows:
            yield flush(held.combine_chunks())
        give_back()

    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = groups.select("sig", "id", "first", "root", F.pmod("sig", F.lit(DEALT)).alias("deal")).repartition(parts, "first", "deal").sortWithinPartitions("sig", "id")
    counted = rows.select("sig", "id", "root").mapInArrow(count, "a long, b long, times long").groupBy("a", "b").agg(F.sum("times").alias("times"))
    return _fits(counted, bounds)


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, from their texts."""
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("one")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("two")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "two", 4_000_000):
                (h, p), (g, q) = shingle_sets(part.column("one")), shingle_sets(part.column("two"))
                keep = []
                for i in range(part.num_rows):
                    x, y = h[p[i] : p[i + 1]], g[q[i] : q[i + 1]]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(5 * common >= 4 * (len(x) + len(y) - common) > 0)
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "one", "two").mapInArrow(run, "a long, b long")


def _compare(sets: list[np.ndarray], classes: list[int]) -> list[tuple[int, int]]:
    """Links between sets of different classes, one for each pair of classes that are joined here."""
    joined = {c: c for c in classes}

    def root(c: int) -> int:
        while joined[c] != c:
            c = joined[c]
        return c

    sizes = np.array([len(s) for s in sets])
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(number, kind="stable")
    lists = owner[order]
    begins = np.concatenate(([0], np.cumsum(np.bincount(number))))
    place = np.concatenate(([0], np.cumsum(sizes)))
    out = []
    largest = max(set(classes), key=classes.count)  # its sets have met if the others have met all
    for i in (k for k, c in enumerate(classes) if c != largest):
        own = number[place[i] : place[i + 1]]
        n = begins[own + 1] - begins[own]
        at = np.repeat(begins[own] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.bincount(lists[at], minlength=len(sets))
        for j in np.flatnonzero(5 * common >= 4 * (sizes + sizes[i] - common)).tolist():
            a, b = root(classes[i]), root(classes[j])
            if a != b:
                joined[max(a, b)] = min(a, b)
                out.append((classes[i], classes[j]))
    return out


def _between(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) of classes within groups (sig, n, id, root)."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    rows = rows.select("sig", "id", "root", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    rows = rows.select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "root").join(texts, "id")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sets, classes = None, [], []
        found: list[tuple[int, int]] = []
        for batch in batches:
            for part in slices(batch, "text", 4_000_000):
                h, first = shingle_sets(part.column("text"))
                for k, row in enumerate(zip(*(part.column(c).to_pylist() for c in ("sig", "i", "j", "root")))):
                    if row[:3] != key:
                        if len(set(classes)) > 1:
                            found += _compare(sets, classes)
                        key, sets, classes = row[:3], [], []
                    sets.append(h[first[k] : first[k + 1]].copy())
                    classes.append(row[3])
        if len(set(classes)) > 1:
            found += _compare(sets, classes)
        links = sorted(set(found))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    order = rows.select("sig", "i", "j", "id", "root", "text").repartition(parts, "sig", "i", "j").sortWithinPartitions("sig", "i", "j", "id")
    return order.mapInArrow(run, "a long, b long")


def _texts(documents: DataFrame, key: str, text: str, ids: DataFrame) -> DataFrame:
    """(id, text) of the ids and of few others, written once."""
    maybe = filter_of(ids, "id")
    rows = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return stage(rows.where(F.col("id").isNotNull() & F.col("text").isNotNull()).where(maybe(F.col("id"))), "texts")


def join(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, set_id, component_id) of every row: the size of its set, the smallest id with an equal set,
    and the smallest id that links reach."""

    def verified(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
        return stage(_linked(pairs, _texts(documents, key, text, ids)), "links")

    keys = stage(_sets(documents, key, text), "sets")
    equal = keys.where("n > 0 AND id IS NOT NULL").groupBy("h1", "h2").agg(F.min("id").alias("set_id"))
    sets = stage(
        keys.join(equal, ["h1", "h2"], "left").select("id", "n", "h1", "sparse", "least", F.when(F.col("n") > 0, F.col("set_id")).alias("set_id")), "classes"
    )
    named = sets.where("set_id IS NOT NULL AND id IS NOT NULL")
    # a set is known by its smallest id; an id with several rows, by the weakest of its bounds
    alone = stage(
        named.where("id = set_id").groupBy("id").agg(F.min("n").alias("n"), F.min("least").alias("least"), F.max("sparse").alias("sparse")), "alone"
    )
    several = named.groupBy("id").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("id")  # of several texts
    many = F.coalesce("many", F.lit(False))
    bounds = alone.join(several.withColumn("many", F.lit(True)), "id", "left").select(
        "id", "n", F.when(many, 1).otherwise(F.col("least")).alias("least"), "sparse", many.alias("many")
    )

    shared = stage(_shared(_signed(documents, key, text)).join(alone.select("id"), "id", "left_semi"), "groups")
    size = shared.groupBy("sig").agg(F.count_distinct("id").alias("n")).where("n > 1")
    groups = stage(shared.distinct().join(size, "sig").select("sig", "id", "first", "n"), "groups")

    # what links with the smallest id it shares most signatures with: copies of a group meet in one class, without their pairs
    star = groups.where("id <> first").groupBy("id", "first").agg(F.count("*").alias("times"))
    star = star.groupBy("id").agg(F.max_by(F.struct("first", "times"), F.struct("times", -F.col("first"))).alias("b"))
    star = stage(_fits(star.select(F.col("id").alias("a"), F.col("b.first").alias("b"), "b.times"), bounds, STAR), "pairs")
    equals = named.where("id <> set_id").select(F.col("id").alias("a"), F.col("set_id").alias("b"))
    known = components(verified(star).unionByName(equals))

    # of sets that share enough signatures to link at all, the pairs of small groups between classes
    enough = groups.groupBy("id").agg(F.count("*").alias("times")).join(bounds, "id").where("times >= least").select("id")
    classes = enough.join(known, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    live = stage(groups.join(classes, "id"), "live")
    pairs = stage(_pairs(live.where(F.col("n") <= SMALL), bounds), "pairs")
    if not pairs.isEmpty():
        known = components(known.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(verified(pairs)))

    # large groups where several classes are left
    rows = live.where(F.col("n") > SMALL).select("sig", "id").join(known, "id", "left").select("sig", "id", F.coalesce("root", "id").alias("root"))
    rows = stage(rows, "large")
    mixed = rows.groupBy("sig").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"),
    ).where("low <> high").groupBy("low", "high", "n", "x", "y").agg(F.min("sig").alias("sig")).select("sig", "n")  # equal groups once
    rows = stage(rows.join(mixed, "sig"), "mixed")
    more = stage(_between(rows, _texts(documents, key, text, rows.select("id"))), "links")
    whole = components(known.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(more))
    found = sets.join(whole, "id", "left")
    return found.select(
        F.col("id").cast(documents.schema[key].dataType).alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("set_id", "id").alias("set_id"), F.coalesce("root", "id").alias("component_id"),
    )


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that link, through others or not, with one of a smaller id; of rows with one id, the one of smallest text.
    Rows with a null id stay. Only rows that may go are shuffled."""
    found = stage(join(documents, key, text).where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), "component_id"), "components")
    gone = found.where("id <> component_id").select("id").distinct()
    repeated = found.groupBy("id").count().where("count > 1").select("id")
    maybe = filter_of(gone.unionByName(repeated), "id")
    rows = documents.withColumn("__id", F.col(key).cast("long"))
    sure = rows.where(F.col("__id").isNull() | ~maybe(F.coalesce("__id", F.lit(0))))
    doubtful = rows.where(F.col("__id").isNotNull() & maybe(F.coalesce("__id", F.lit(0))))
    order = Window.partitionBy("__id").orderBy(F.xxhash64(text), text)
    kept = doubtful.join(gone.withColumnRenamed("id", "__id"), "__id", "left_anti").withColumn("__n", F.row_number().over(order)).where("__n = 1")
    return sure.select(*documents.columns).unionByName(kept.select(*documents.columns))
