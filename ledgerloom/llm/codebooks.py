"""Vector codes by product quantisation, with codebooks refined by ball k-means.

Each component x becomes the whole number floor(scale * x), and a vector is cut into ``parts`` equal consecutive parts (a shorter
vector has zeros at its end, as has the last part where the length is no multiple). The codebook of a part position starts as that
part of the first ``entries`` rows in the order of the key. A round assigns each part to its nearest entry (squared Euclidean
distance, ties to the lower index) and moves each entry to the floor of the mean of its parts; an entry without parts stays.

The parts of an entry are a ball around it. After a move, the balls of a batch are measured again: another entry can hold nearer
parts only within twice the ball's radius, and those entries are its neighbours. Parts nearer to their entry than half the way to the
next entry are the ball's stable core and stay. The others lie in rings between half the ways to one neighbour and to the next:
a part is compared with the neighbours up to its ring alone. A ball that did not move, nor any neighbour of it, stays whole. All
of it is strict, so ties come out as in a full search, and all distances are exact whole numbers.

A round is one pass: it reads rows and their codes, and writes the rows with new codes and, per task, the sums of each entry. Spark adds the
sums, and the driver gets one row per entry, as many as ``parts * entries`` whatever the input. Rows whose vector is null or
holds null or non-finite components take no part. Null keys come last in the order, rows of equal keys are ordered by their vectors; repeated
rows are rows of their own. Components must be below 2 ** 26 in size after scaling, and a part has 512 of them at most; more is an error. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sinks import stage

#: Products of components of this size add up without a rounding in 64-bit floats (``_FLOAT``) or integers.
LARGEST = 1 << 26
LONGEST = 512
_FLOAT = 1 << 20
_RINGS = 4


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def _whole(vector: str, scale: int, size: int) -> Column:
    """Whole components, filled with zeros up to ``size``."""
    x = F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size(x)))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` and ``b``."""
    large = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) >= _FLOAT
    product = a @ b.T if large else np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return (a * a).sum(1)[:, None] - 2 * product + (b * b).sum(1)


class Balls:
    """The entries of one part position, their distances from each other, and which have moved in the last round."""

    def __init__(self, entries: np.ndarray, moved: np.ndarray | None = None):
        self.entries = entries
        self.moved = np.ones(len(entries), bool) if moved is None else moved
        between = _squares(entries, entries)
        np.fill_diagonal(between, -1)  # an entry comes first among its own neighbours
        self.near = np.argsort(between, axis=1, kind="stable")[:, 1:]
        self.ways = np.take_along_axis(between, self.near, 1)

    def assign(self, x: np.ndarray, codes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row of ``x`` and its squared distance; ``codes``: the nearest before the last move."""
        if codes is None:
            codes, far = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
            for at in range(0, len(x), 4096):
                d = _squares(x[at : at + 4096], self.entries)
                codes[at : at + 4096] = d.argmin(1)
                far[at : at + 4096] = d.min(1)
            return codes, far
        off = x - self.entries[codes]
        far = (off * off).sum(1)
        if len(self.entries) == 1:
            return codes, far
        radius = np.full(len(self.entries), -1, np.int64)
        np.maximum.at(radius, codes, far)
        neighbours = (self.ways <= 4 * radius[:, None]).sum(1)
        live = self.moved.copy()  # balls that moved, or have a neighbour that did
        for e in np.flatnonzero((radius >= 0) & ~live):
            live[e] = self.moved[self.near[e, : neighbours[e]]].any()
        shell = np.flatnonzero(live[codes] & (4 * far >= self.ways[codes, 0]))
        codes, far = codes.copy(), far.copy()
        shell = shell[np.lexsort((far[shell], codes[shell]))]
        edges = np.flatnonzero(np.concatenate(([True], np.diff(codes[shell]) != 0, [True]))) if len(shell) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            e = int(codes[shell[a]])
            for ring in np.array_split(shell[a:b], min(_RINGS, b - a)):
                reach = np.searchsorted(self.ways[e], 4 * far[ring], side="right")  # neighbours up to the ring
                rivals = np.sort(np.append(self.near[e, : reach.max()], e))  # in order of index: argmin takes the lower at ties
                d = _squares(x[ring], self.entries[rivals])
                best = d.argmin(1)
                codes[ring], far[ring] = rivals[best], d[np.arange(len(ring)), best]
        return codes, far


def _rows(column: pa.Array, width: int, dtype: type) -> np.ndarray:
    """A binary column of equal widths as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def _binary(x: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    x = np.ascontiguousarray(x)
    width = x.shape[1] * x.itemsize
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * width), pa.py_buffer(x)])


def _pass(state: DataFrame, books: list[Balls], length: int, dtype: type, first: bool, last: bool) -> DataFrame:
    """Rows with new codes; rows of sums (part, entry, count first) unless it is the last pass, which gives errors."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b.entries), length + 1), np.int64) for b in books]
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held, n = batch, batch.num_rows
            x = _rows(batch.column("vector"), parts * length, dtype).astype(np.int64)
            before = None if first else _rows(batch.column("codes"), parts, np.uint8).astype(np.int64)
            codes, error = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
            for p, balls in enumerate(books):
                mine = x[:, p * length : (p + 1) * length]
                found, far = balls.assign(mine, None if before is None else before[:, p])
                codes[:, p] = found
                error += far
                if not last:
                    order = np.argsort(found, kind="stable")
                    starts = np.flatnonzero(np.concatenate(([True], np.diff(found[order]) != 0)))
                    which = found[order[starts]]
                    sums[p][which, 1:] += np.add.reduceat(mine[order], starts, axis=0)
                    sums[p][which, 0] += np.diff(np.append(starts, n))
            row = batch.column("row")
            if last:
                yield pa.RecordBatch.from_arrays([row, _binary(codes), pa.array(error)], ["row", "codes", "error"])
            else:
                nothing = pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([row, batch.column("vector"), _binary(codes), *nothing], names)
        if held is not None and not last:
            used = [(p, e) for p in range(parts) for e in np.flatnonzero(sums[p][:, 0])]
            n = len(used)
            arrays = [pa.nulls(n, held.column("row").type), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
            arrays += [pa.array([p for p, _ in used], pa.int32()), pa.array([int(e) for _, e in used], pa.int32())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([sums[p][e] for p, e in used], pa.list_(pa.int64()))], names)

    names = ["row", "vector", "codes", "part", "entry", "sums"]
    of_row = T.StructField("row", state.schema["row"].dataType, True)  # null in the rows of sums
    more = "codes binary, error long" if last else "vector binary, codes binary, part int, entry int, sums array<bigint>"
    return state.mapInArrow(run, T.StructType([of_row, *T.StructType.fromDDL(more).fields]))


def encode(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
    keep: list[str] | None = None, code: str = "code", error: str = "error",
) -> tuple[DataFrame, np.ndarray]:
    """The columns ``keep`` (all but the vector, unless given) of the usable rows with a code of a byte for each part and the squared distance to what
    it stands for; and the codebooks, as (part, entry, component). A column of ``vectors`` named like a result is left out. ``entries`` is 256 at most."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256, as a code has a byte for each part")
    keep = [c for c in (keep if keep is not None else [c for c in vectors.columns if c != vector]) if c not in (code, error)]
    kept = vectors.where(usable(vector))
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    measured = kept.agg(F.max(F.size(vector)), F.max(F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double")))))).first()
    if measured[0] is not None and measured[1] is not None and scale * measured[1] >= LARGEST:
        raise ValueError(f"components above {LARGEST // scale} in size cannot be encoded exactly")
    length = max(1, -(-(measured[0] or 0) // parts))
    if length > LONGEST:
        raise ValueError(f"parts of more than {LONGEST} components cannot be encoded exactly")
    whole = kept.select(row.alias("row"), F.col(f"`{key}`").alias("key"), _whole(vector, scale, parts * length).alias("x"))
    starts = [r["x"] for r in whole.select("key", "x").orderBy(F.asc_nulls_last("key"), "x").limit(entries).collect()]  # one row per entry
    books = np.array(starts, np.int64).reshape(len(starts), parts, length).transpose(1, 0, 2)
    result = [F.col(f"row.`{c}`") for c in keep]
    if not starts:
        return whole.select(*result, F.lit(b"").alias(code), F.lit(0).cast("long").alias(error)).limit(0), books

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(dtype)
                yield pa.RecordBatch.from_arrays([batch.column("row"), _binary(x)], ["row", "vector"])

    dtype = np.int16 if scale * measured[1] < 32_767 else np.int32
    state = whole.select("row", "x").mapInArrow(pack, T.StructType([whole.schema["row"], T.StructField("vector", T.BinaryType())]))
    moved: list[np.ndarray | None] = [None] * parts
    for n in range(rounds):
        done = stage(_pass(state, [Balls(b, m) for b, m in zip(books, moved)], length, dtype, n == 0, False), f"codes-{n}")
        state = done.where(F.col("part").isNull()).select("row", "vector", "codes")
        sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(length + 1)]
        found = done.where(F.col("part").isNotNull()).groupBy("part", "entry").agg(*sums).collect()  # one row per entry
        old, books = books, books.copy()
        for f in found:
            books[f["part"], f["entry"]] = np.array(f[3:], np.int64) // f["s0"]
        moved = list((old != books).any(2))
    done = _pass(state, [Balls(b, m) for b, m in zip(books, moved)], length, dtype, rounds == 0, True)
    return done.select(*result, F.col("codes").alias(code), F.col("error").alias(error)), books
