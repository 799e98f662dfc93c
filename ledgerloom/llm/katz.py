"""Katz backoff over words: Good-Turing discounted bigrams over unigrams, normalised exactly.

Words are lower-cased in A-Z; a text is its words and one end. With N tokens and V distinct tokens in training, a word or the end of count
c has the base probability (c + 1) / (N + V + 1); all unknown words together are one more outcome, of count 0. After a word or the
beginning ``h`` of count c(h), a follower seen r times has probability d(r) r / c(h), any other alpha(h) times its base
probability. d(r) is Katz's discount for r up to ``K`` from the counts of counts, and keeps r - ``KEPT`` of larger r (and of all r where counts of
counts give no discount between 0 and 1), so every history leaves some mass. alpha(h) shares just that mass out over what was not seen, so the
probabilities after any history sum to 1. After an unknown word, the base probability holds.

Tokens never meet as rows. A slice of documents sends, to each partition of the vocabulary, one packed list of the tokens it owns:
their words, the words before, and the documents. A partition has all tokens of its words, so it counts words and bigrams and returns, for each slice,
sums per document; for each history, counts of its followers by how often they were seen, to the history's partition; and the unseen bigrams, which
ask for alpha there. These tables are written, partitioned by kind, and read once each. Partitions grow in number with the
texts. Masses of frequent histories are worked out first and go to all tasks; bigrams that ask for them stay in the partition of their word, so
no partition has all that follows a frequent word. Words and bigrams that would fill a good part of a partition are counted beforehand (their number is bounded by that of the partitions),
shipped with the tasks, and their tokens dealt over several partitions.

Null and empty texts are one end. Repeated rows are scored and counted each; a null id counts as training unless it is held out. The input
must give the same rows when read again, as files do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import mix, slices, words
from ledgerloom.sinks import stage

K = 5
KEPT = 0.5
SLICE = 8_000_000
PARTITION_BYTES = 12_000_000
LEAST_PARTITIONS = 48
#: Sums travel as whole multiples of 1 / UNIT.
UNIT = float(1 << 30)
BEGIN, END = (np.uint64(x) for x in mix(np.array([1, 2], np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
_PAIR = np.uint64(0xD1B54A32D192ED03)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; unsigned 64-bit ones that ascend as differences."""
    parts = [np.array([len(arrays)], "<i4").tobytes()]
    for x in arrays:
        up = x.dtype == np.uint64 and len(x) > 0 and bool((x[1:] >= x[:-1]).all())
        if up:
            x = np.diff(x, prepend=np.uint64(0))
        raw = x.tobytes()
        if x.dtype.itemsize > 1:  # bytes of one weight together
            raw = np.frombuffer(raw, np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()
        head = f"{x.dtype.str}{int(up)}".encode()
        parts += [np.array([len(head), len(raw)], "<i4").tobytes(), head, raw]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(value: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(value), 4, []
    for _ in range(int(np.frombuffer(raw[:4], "<i4")[0])):
        a, b = np.frombuffer(raw[at : at + 8], "<i4").tolist()
        kind, up = np.dtype(raw[at + 8 : at + 7 + a].decode()), raw[at + 7 + a : at + 8 + a] == b"1"
        x = np.frombuffer(raw, np.uint8, b, at + 8 + a)
        x = np.frombuffer(x.reshape(kind.itemsize, -1).T.tobytes(), kind)
        out.append(np.cumsum(x, dtype=np.uint64) if up else x)
        at += 8 + a + b
    return out


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, the one before, document) of all tokens of a batch."""
    w = words(column)
    n = np.diff(w.first)
    doc = np.repeat(np.arange(len(n)), n + 1)
    token = np.full(len(doc), END)
    token[np.arange(len(w.hashes)) + np.repeat(np.arange(len(n)), n)] = w.hashes
    before = np.concatenate((token[:0], [BEGIN], token[:-1])) if len(token) else token
    before[np.cumsum(n + 1) - n - 1] = BEGIN
    return token, before, doc


def _pair(token: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(token + _PAIR * mix(before))


def _counts(values: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, where each value is among them, and the sum of weights of each."""
    distinct, place = np.unique(values, return_inverse=True)
    place = place.astype(np.int32)
    return distinct, place, np.bincount(place, weight, len(distinct)).astype(np.int64)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value of each wanted key in ascending ``keys``, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    there = keys[at] == wanted
    return np.where(there, values[at], 0), there


class Hot:
    """Exact training counts of the frequent words and bigrams. Their number is at most a few for each partition."""

    def __init__(self, words: tuple = ((), ()), pairs: tuple = ((), (), (), ()), total: int = 0):
        self.words, self.word_counts = np.array(words[0], np.uint64), np.array(words[1], np.int64)
        self.pairs, self.pair_counts = np.array(pairs[0], np.uint64), np.array(pairs[1], np.int64)
        self.pair_word, self.pair_before = np.array(pairs[2], np.uint64), np.array(pairs[3], np.uint64)
        self.total = total
        #: Frequent histories: the frequent words, and the beginning.
        self.histories = np.sort(np.append(self.words, BEGIN))

    def follows(self, before: np.ndarray) -> np.ndarray:
        """Whether each history is a frequent one."""
        return self.histories[np.minimum(np.searchsorted(self.histories, before), len(self.histories) - 1)] == before

    def part(self, token: np.ndarray, before: np.ndarray, doc: np.ndarray, slice_: int, parts: int) -> np.ndarray:
        """The partition of each token: of its word; for a frequent word, of the bigram; for a frequent bigram, any."""
        n = np.uint64(parts)
        out = mix(token) % n
        if len(self.words):
            _, hot = _lookup(self.words, self.word_counts, token)
            pair = _pair(token[hot], before[hot])
            _, again = _lookup(self.pairs, self.pair_counts, pair)
            out[hot] = np.where(again, mix(doc[hot].astype(np.uint64) + np.uint64(slice_ * 1_000_003)), mix(pair)) % n
        return out.astype(np.int64)


def _parts_of(documents: DataFrame, key: str, text: str, held: Column) -> DataFrame:
    return documents.select(F.col(key).alias("key"), F.coalesce(held, F.lit(False)).alias("held"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _frequent(rows: DataFrame, parts: int) -> Hot:
    """Words and bigrams of a fourth of a partition's share of the tokens or more: those that reach it in some slice are counted in all."""
    share = 4 * parts

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                token, before, _ = tokens(part.column("text"))
                one = np.ones(len(token))
                w, _, n = _counts(token, one)
                pair, at, m = _counts(_pair(token, before), one)
                first = np.zeros(len(pair), np.int64)
                first[at] = np.arange(len(token))
                many, often = np.flatnonzero(n * share >= len(token)), np.flatnonzero(m * share >= len(token))
                nothing = np.zeros(len(many), np.uint64)
                cols = (np.concatenate(x).astype(np.int64) for x in ((w[many], pair[often]), (nothing, token[first[often]]), (nothing, before[first[often]])))
                kind = np.repeat([0, 1], [len(many), len(often)])
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), *(pa.array(c) for c in cols)], ["kind", "id", "word", "before"])

    shape = "kind int, id long, word long, before long"
    seen = rows.select("text").mapInArrow(candidates, shape).groupBy("kind", "id").agg(F.count("*").alias("slices"), F.first("word").alias("word"), F.first("before").alias("before"))
    # a slice has at most 2 * share of them; of what any slice found, the commonest are kept: others stay in one partition
    found = seen.orderBy(F.desc("slices"), "kind", "id").limit(8 * share).toPandas()
    names = [np.sort(found["id"][found["kind"] == k].to_numpy(np.int64).view(np.uint64)) for k in (0, 1)]
    share_names = rows.sparkSession.sparkContext.broadcast(names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(len(x), np.int64) for x in share_names.value]
        n = 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                token, before, doc = tokens(part.column("text"))
                train = ~part.column("held").to_numpy(zero_copy_only=False)[doc]
                n += int(train.sum())
                for k, values in enumerate((token[train], _pair(token, before)[train])):
                    if len(share_names.value[k]):
                        at = np.minimum(np.searchsorted(share_names.value[k], values), len(total[k]) - 1)
                        total[k] += np.bincount(at[share_names.value[k][at] == values], minlength=len(total[k]))
        kind = np.repeat([0, 1, 2], [len(total[0]), len(total[1]), 1])
        ids = np.concatenate((*share_names.value, np.zeros(1, np.uint64))).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(ids), pa.array(np.concatenate((*total, [n])))], ["kind", "id", "n"])

    got = rows.select("held", "text").mapInArrow(count, "kind int, id long, n long").groupBy("kind", "id").agg(F.sum("n").alias("n")).toPandas()
    total = int(got["n"][got["kind"] == 2].sum())
    got = got[(got["n"] * share >= total) & (got["kind"] < 2)].merge(found[["kind", "id", "word", "before"]], on=["kind", "id"])
    got["id"] = got["id"].to_numpy(np.int64).view(np.uint64)
    got = got.sort_values("id")
    w, p = got[got["kind"] == 0], got[got["kind"] == 1]
    p = p[np.isin(p["word"].to_numpy(np.int64).view(np.uint64), w["id"].to_numpy(np.uint64))]
    as_hash = lambda x: x.to_numpy(np.int64).view(np.uint64)
    return Hot((w["id"].to_numpy(np.uint64), w["n"]), (p["id"].to_numpy(np.uint64), p["n"], as_hash(p["word"]), as_hash(p["before"])), total)


def _dealt(rows: DataFrame, parts: int, hot) -> DataFrame:
    """(part, slice, packed) for each slice and partition; the documents of a slice go with one of them."""
    schema = pa.schema([("part", pa.int32()), ("slice", pa.int64()), ("packed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_ = TaskContext.get().partitionId() << 24
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                token, before, doc = tokens(part.column("text"))
                held = part.column("held").to_numpy(zero_copy_only=False)
                of = hot.value.part(token, before, doc, slice_, parts)
                order = np.lexsort((before, token, of))
                ends = np.searchsorted(of[order], np.arange(parts + 1))
                keys = part.column("key").cast(pa.int64())
                table = (np.array(keys.fill_null(0)), np.array(keys.is_null()), held, np.bincount(doc, minlength=len(held)).astype(np.int64))
                out = []
                for p in range(parts):
                    at = order[ends[p] : ends[p + 1]]
                    mine = p == slice_ % parts
                    if not len(at) and not mine:
                        continue
                    t = token[at]
                    new = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1]))) if len(t) else np.zeros(0, np.int64)
                    known, place = np.unique(before[at], return_inverse=True)
                    small = np.uint16 if max(len(known), len(held)) < 65536 else np.uint32
                    times = np.diff(np.append(new, len(t))).astype(np.uint32)
                    cell = pack(t[new], times, known, place.astype(small), doc[at].astype(small), np.packbits(held), np.array([len(held)]), *(table if mine else ()))
                    out.append((p, slice_, cell))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                slice_ += 1

    return rows.mapInArrow(run, "part int, slice long, packed binary")


def _by_part(keys: np.ndarray, parts: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Rows with the hash ``keys`` packed by partition of the key, in its order."""
    part = (mix(keys ^ _PAIR) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((keys, part))
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(ends)).tolist():
        at = order[ends[p] : ends[p + 1]]
        yield p, pack(keys[at], *(c[at] for c in columns))


def _counted(group: pa.Table, parts: int, hot: Hot) -> pa.Table:
    """What a partition says: sums for the documents of each slice (kind 0), followers of histories (1), unseen bigrams (2), counts (3),
    followers of frequent histories (5)."""
    group = group.sort_by("slice")
    mine = int(group.column("part")[0].as_py())
    names = group.column("slice").to_pylist()
    cells = [unpack(x.as_py()) for x in group.column("packed")]
    sizes = np.array([int(c[6][0]) for c in cells])
    base = np.cumsum(sizes) - sizes
    token = np.concatenate([np.repeat(c[0], c[1]) for c in cells])
    before = np.concatenate([c[2][c[3]] for c in cells])
    doc = np.concatenate([(c[4] + b).astype(np.int32) for c, b in zip(cells, base)])
    held = np.concatenate([np.unpackbits(c[5], count=n).astype(bool) for c, n in zip(cells, sizes)])
    train = ~held[doc]
    w, at, n = _counts(token, train)
    known, there = _lookup(hot.words, hot.word_counts, w)
    own = int(((n > 0) & ~there).sum())  # distinct words that are counted here alone
    c = np.where(there, known, n).astype(np.int64)[at]
    del at
    pair, which, m = _counts(_pair(token, before), train)
    known, there = _lookup(hot.pairs, hot.pair_counts, pair)
    r = np.where(there, known, m)[which]
    # each bigram seen in training once, for its history
    first = np.zeros(len(pair), np.int64)
    first[which] = np.arange(len(token))
    alone = first[(m > 0) & ~there]
    del pair, which, first
    total = int(sizes.sum())
    one = lambda x, weight=None: np.bincount(doc[x], weight, total)
    seen = r > 0
    score = np.where(seen, np.log10(np.where(r > K, r - KEPT, np.maximum(r, 1))), np.log10(c + 1.0)) - np.where((token != END) & (c > 0), np.log10(np.maximum(c, 1)), 0.0)
    sums = [np.bincount(doc, np.log10(c + 1.0), total), np.bincount(doc, score, total), one(c > 0), one(~seen), *(one(r == x) for x in range(1, K + 1))]
    del score
    rows: list[tuple[int, int, bytes]] = []
    for s, b, k, cell in zip(names, base, sizes, cells):
        small = [x[b : b + k].astype(np.uint32) for x in sums[2:]]
        exact = [np.round(x[b : b + k] * UNIT).astype(np.int64) for x in sums[:2]]
        rows.append((0, s, pack(*exact, *small, *cell[7:])))
    h, follower, times = before[alone], c[alone] + 1, r[alone]
    if mine == 0 and len(hot.pairs):
        h, times = np.concatenate((h, hot.pair_before)), np.concatenate((times, hot.pair_counts))
        follower = np.concatenate((follower, _lookup(hot.words, hot.word_counts, hot.pair_word)[0] + 1))
        keep = times > 0
        h, times, follower = h[keep], times[keep], follower[keep]
    name, place = np.unique(h, return_inverse=True)
    tally = [np.bincount(place[times == x], minlength=len(name)).astype(np.uint32) for x in range(1, K + 1)]
    large = times > K
    tally += [np.bincount(place[large], minlength=len(name)).astype(np.uint32), np.bincount(place[large], times[large], len(name)).astype(np.uint64), np.bincount(place, follower, len(name)).astype(np.uint64)]
    frequent = hot.follows(name)
    for kind, which in ((1, ~frequent), (5, frequent)):
        rows += [(kind, p, x) for p, x in _by_part(name[which], parts, *(x[which] for x in tally))]
    asks = np.flatnonzero(~seen)
    slice_of = np.repeat(np.arange(len(names)), sizes)[doc[asks]]
    near = (doc[asks] - base[slice_of]).astype(np.uint32)
    slice_of = slice_of.astype(np.uint32)
    h = before[asks]
    frequent = hot.follows(h)
    if frequent.any():
        here = np.flatnonzero(frequent)
        here = here[np.argsort(h[here], kind="stable")]
        rows.append((2, mine, pack(h[here], slice_of[here], near[here], np.array(names))))
    rows += [(2, p, pack(*unpack(x), np.array(names))) for p, x in _by_part(h[~frequent], parts, slice_of[~frequent], near[~frequent])]
    of_pairs = np.concatenate((m[~there], hot.pair_counts if mine == 0 else m[:0]))
    rows.append((3, 0, pack(np.concatenate(([own], [int((of_pairs == x).sum()) for x in range(1, K + 2)])).astype(np.int64))))
    kinds, to, packed = zip(*rows)
    return pa.table([pa.array(kinds, pa.int32()), pa.array(to, pa.int64()), pa.array(packed, pa.binary())], ["kind", "to", "packed"])


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """What is kept of r = 1 ... K, r d(r), from how many bigrams were seen 1 ... K + 1 times."""
    n = [0, *counts_of_counts]
    kept = np.arange(1, K + 1) - KEPT
    if n[1] > 0 and 1 - (K + 1) * n[K + 1] / n[1] > 0:
        whole = (K + 1) * n[K + 1] / n[1]
        for r in range(1, K + 1):
            if n[r]:
                d = ((r + 1) * n[r + 1] / (r * n[r]) - whole) / (1 - whole)
                kept[r - 1] = r * d if 0 < d < 1 else r - KEPT
    return kept


def _masses(histories: list[list[np.ndarray]], kept: np.ndarray, outcomes: int) -> tuple[np.ndarray, np.ndarray]:
    """Histories, ascending, and log10 of alpha(h) c(h) of each, from what partitions say of their followers."""
    if not histories:
        return np.zeros(0, np.uint64), np.zeros(0)
    name, place = np.unique(np.concatenate([x[0] for x in histories]), return_inverse=True)
    column = lambda k: np.bincount(place, np.concatenate([x[k] for x in histories]).astype(float), len(name))
    mass = sum((r + 1 - kept[r]) * column(r + 1) for r in range(K)) + KEPT * column(K + 1)
    return name, np.log10(mass) - np.log10(1 - column(K + 3) / outcomes)


def _left(group: pa.Table, kept: np.ndarray, outcomes: int, frequent: tuple[np.ndarray, np.ndarray]) -> pa.Table:
    """log10 of alpha(h) c(h) summed over the unseen bigrams of each document, packed by slice."""
    histories = [unpack(x.as_py()) for k, x in zip(group.column("kind").to_pylist(), group.column("packed")) if k == 1]
    asked = [unpack(x.as_py()) for k, x in zip(group.column("kind").to_pylist(), group.column("packed")) if k == 2]
    name, log = _masses(histories, kept, outcomes)
    total: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for h, slice_of, near, names in asked:
        value = _lookup(name, log, h)[0] + _lookup(*frequent, h)[0]  # no history is in both
        for k in np.unique(slice_of).tolist():
            here = slice_of == k
            docs, at = np.unique(near[here], return_inverse=True)
            total.setdefault(int(names[k]), []).append((docs, np.bincount(at, value[here], len(docs))))
    rows = [(4, s, pack(np.concatenate([d for d, _ in x]), np.concatenate([v for _, v in x]))) for s, x in total.items()]
    kinds, to, packed = zip(*rows) if rows else ((), (), ())
    return pa.table([pa.array(kinds, pa.int32()), pa.array(to, pa.int64()), pa.array(packed, pa.binary())], ["kind", "to", "packed"])


def score(documents: DataFrame, held: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; rows where ``held`` is true are not learned from."""
    rows = _parts_of(documents, key, text, held)
    spark = documents.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_PARTITIONS, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 2), math.ceil(size / PARTITION_BYTES))
    hot = _frequent(rows, parts)
    share = spark.sparkContext.broadcast(hot)
    dealt = _dealt(rows, parts, share)
    counted = stage(
        dealt.groupBy("part").applyInArrow(lambda group: _counted(group, parts, share.value), "kind int, to long, packed binary"), "katz"
    )
    sums = [unpack(bytes(x[0]))[0] for x in counted.where("kind = 3").select("packed").collect()]  # a few numbers of each partition
    known = np.sum(sums, axis=0) if sums else np.zeros(K + 2, np.int64)
    outcomes = hot.total + int(known[0]) + int((hot.word_counts > 0).sum()) + 1
    kept = discounts(known[1:].tolist())
    first = int(rows.where("NOT held").count())
    begin = math.log10(first) if first else 0.0
    per = np.log10(outcomes)
    log_kept = np.log10(kept)

    def of_frequent(group: pa.Table) -> pa.Table:
        name, log = _masses([unpack(x.as_py()) for x in group.column("packed")], kept, outcomes)
        return pa.table([pa.array(name.view(np.int64)), pa.array(log)], ["h", "log"])

    got = counted.where("kind = 5").groupBy("to").applyInArrow(of_frequent, "h long, log double").toPandas()  # one row of each at most
    names, logs = got["h"].to_numpy(np.int64).view(np.uint64), got["log"].to_numpy(float)
    order = np.argsort(names)
    frequent = spark.sparkContext.broadcast((names[order], logs[order]))
    left = counted.where("kind IN (1, 2)").groupBy("to").applyInArrow(
        lambda group: _left(group, kept, outcomes, frequent.value), "kind int, to long, packed binary"
    )

    def whole(group: pa.Table) -> pa.Table:
        sums: list[np.ndarray] | None = None
        ids = extra = None
        late = []
        for kind, packed in zip(group.column("kind").to_pylist(), group.column("packed")):
            x = unpack(packed.as_py())
            if kind == 4:
                late.append(x)
                continue
            if len(x) > 4 + K:
                ids, x = x[4 + K :], x[: 4 + K]
            sums = [a.astype(float) for a in x] if sums is None else [a + b for a, b in zip(sums, x)]
        missing, null, held, n = ids
        extra = np.zeros(len(n))
        for docs, value in late:
            np.add.at(extra, docs, value)
        base = sums[0] / UNIT - n * per
        value = sums[1] / UNIT + sum(sums[4 + r] * (log_kept[r] - np.log10(r + 1)) for r in range(K)) - sums[3] * per - begin + extra
        columns = [pa.array(missing, mask=null), pa.array(held), pa.array(n), pa.array(sums[2].astype(np.int64)), pa.array(np.full(len(n), hot.total)), pa.array(base), pa.array(value)]
        return pa.table(columns, ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    together = counted.where("kind = 0").unionByName(left)
    shape = "key long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return together.groupBy("to").applyInArrow(whole, shape).withColumnRenamed("key", key)
