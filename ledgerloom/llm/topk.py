"""Exact top-k by inner product with an impact-ordered index, score at a time.

Vectors are dealt into blocks of about ``BLOCK``. A posting is one component of one vector that is not 0; its impact is the component's size, quantised
to ``LEVELS`` levels of about as many postings each. The index of a block holds posting segments, one for each (level, dimension) that occurs: the places of the vectors and their
components. Queries take the segments by descending level, many queries together; a segment costs its postings and no more, and is skipped
by queries of 0 in its dimension. The segments of the levels before the first proof is tried are taken as one matrix product where they hold a good part of
the block (``DENSE``). What has been added to a score so far, and the norm of the query times that of the vector's postings still to come, bound it
from above; the exact scores of the k vectors ahead bound the k-th best from below. A query stops as soon as these bounds prove that few vectors (a
share ``FEW``, or 4 k) can be among its k best; the segments of lower impact are then never touched, and the possible members are scored
again exactly from their whole vectors.
Queries meet the blocks in chunks, every block every chunk; each gives its k best, and the k best of those are the result.

Components are whole numbers below 2 ** 20 in size, at most 8192 of them, so that all sums are exact; others are an error. Rows with a null id, a
null vector or a null or non-finite component take no part; a shorter vector has zeros at its end. Ids name rows: a query meets no row of
its own id, and repeated query rows are one query. Ties go to the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4_096
CHUNK = 2_048
LEVELS = 16
TOGETHER = 256
FEW = 1 / 8
LARGEST, LONGEST = 2**20, 8_192
#: Bounds are not looked at while more than this share of the vectors' norm is to come.
UNTRIED = 0.3
#: Of many open queries about so many try their proof first; if none has one, the others wait for the next level.
PROBE = 16
#: Segments taken together are a matrix product if they hold at least this share of the block's components.
DENSE = 1 / 8


def whole_numbers(vector: str, scale: int = 64) -> Column:
    """floor(scale * x) of each component, or null where the vector takes no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(usable, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def _matrix(vectors: pa.ChunkedArray | pa.Array, dims: int = 0) -> np.ndarray:
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.array(vectors.value_lengths())
    if sizes.max(initial=0) > LONGEST or np.abs(vectors.flatten().to_numpy()).max(initial=0) >= LARGEST:
        raise ValueError(f"vectors must have at most {LONGEST} components, all below {LARGEST} in size")
    out = np.zeros((len(vectors), max(dims, int(sizes.max(initial=0)))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = vectors.flatten().to_numpy()
    return out


class Segments:
    """The index of one block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, levels: int = LEVELS):
        order = np.argsort(ids, kind="stable")  # ties go to the smaller id, so to the smaller place
        self.ids, self.rows = ids[order], rows[order]
        place, dim = np.nonzero(self.rows)
        value = self.rows[place, dim].astype(np.float64)
        size = np.abs(value)
        # levels of about as many postings each, so that a few very large components do not make one level of the rest
        level = np.searchsorted(np.quantile(size, np.arange(1, levels) / levels) if len(size) else size, size, side="right")
        order = np.lexsort((place, dim, -level))
        self.place, self.value, level, dim = place[order], value[order], level[order], dim[order]
        begins = np.flatnonzero(np.diff(level, prepend=-1) | np.diff(dim, prepend=-1))
        #: (level, dimension, first posting, end) by descending level
        self.segments = list(zip(level[begins].tolist(), dim[begins].tolist(), begins.tolist(), [*begins[1:].tolist(), len(level)]))
        self.squares = (self.rows.astype(np.float64) ** 2).sum(1)
        # the levels before the first proof is tried
        whole, untried, self.head = self.squares.sum(), self.squares.sum(), 0
        ends = np.array([end for *_, end in self.segments])
        for number in np.flatnonzero(np.diff(level[ends - 1], append=-1)) if len(ends) else []:
            begin = self.segments[self.head][2]
            untried -= (self.value[begin : ends[number]] ** 2).sum()
            self.head = int(number) + 1
            if untried <= UNTRIED**2 * whole:
                break
        self.first = int(ends[self.head - 1]) if self.head else 0
        self.dense = None
        if self.first > DENSE * self.rows.size:
            self.dense = np.zeros(self.rows.shape)
            self.dense[self.place[: self.first], dim[: self.first]] = self.value[: self.first]
        self.touched = 0  # postings that queries took

    def best(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the k best for each query; ``own``: the ids of the queries."""
        n, dims = self.rows.shape
        q = np.zeros((len(queries), dims), np.int64)
        q[:, : queries.shape[1]] = queries[:, :dims]
        out: list = [None] * len(q)
        exact = q.astype(np.float64)
        norm = np.sqrt((exact**2).sum(1))
        open_ = np.arange(len(q))
        added = np.where(self.ids[:, None] == own, -np.inf, 0.0)  # a row per vector: a segment adds to whole rows
        rest = self.squares.copy()  # squared norms of the postings to come
        whole, begun = self.squares.sum(), 0
        if self.dense is not None:
            self.touched += int((np.count_nonzero(self.dense, axis=0) * np.count_nonzero(exact, axis=0)).sum())
            added += self.dense @ exact.T  # whole numbers below 2 ** 53: exact in any order
            rest -= (self.dense**2).sum(1)
            begun = self.head - 1  # its last segment has been taken, and its proof is still to be tried
        for number, (level, dim, at, end) in enumerate(self.segments[begun:], begun):
            if self.dense is None or number >= self.head:
                place, value, weight = self.place[at:end], self.value[at:end], exact[open_, dim]
                self.touched += (end - at) * int(np.count_nonzero(weight))
                if weight.any():
                    added[place] += np.outer(value, weight)
                rest[place] -= value * value  # whole numbers below 2 ** 53: exact
            last = number + 1 == len(self.segments)
            if not last and (self.segments[number + 1][0] == level or rest.sum() > UNTRIED**2 * whole):
                continue  # within a level, or far from any proof
            step = len(open_) // PROBE
            if not last and step > 3 and not self._close(q, norm, open_[::step], added[:, ::step], rest, k, last, out).any():
                continue
            proved = self._close(q, norm, open_, added, rest, k, last, out)
            if proved.any():
                open_, added = open_[~proved], added[:, ~proved]
                if not len(open_):
                    return out
        self._close(q, norm, open_, added, rest, k, True, out)  # a block of zeros has no segments
        return out

    def _close(self, q: np.ndarray, norm: np.ndarray, open_: np.ndarray, added: np.ndarray, rest: np.ndarray, k: int, last: bool, out: list) -> np.ndarray:
        """Answer the open queries that have their proof (all, after the last segment); which these are."""
        n = len(rest)
        ahead = np.ascontiguousarray(added.T)
        possible = ahead > -np.inf
        if n > k:
            # the exact scores of the k first so far: the k-th best of all is no less than the least of them
            first = np.argpartition(ahead, n - k, axis=1)[:, n - k :]
            scores = np.einsum("qkd,qd->qk", self.rows[first].astype(np.float64), q[open_].astype(np.float64))
            scores[~np.take_along_axis(possible, first, 1)] = -np.inf
            ahead += (norm[open_] * (1 + 1e-9))[:, None] * np.sqrt(rest)
            possible &= ahead >= scores.min(1)[:, None]
        proved = (possible.sum(1) <= max(4 * k, FEW * n)) | last
        for i in np.flatnonzero(proved):
            at = np.flatnonzero(possible[i])
            scores = (self.rows[at].astype(np.float64) @ q[open_[i]].astype(np.float64)).astype(np.int64)  # sums below 2 ** 53
            top = np.lexsort((at, -scores))[:k]
            out[open_[i]] = self.ids[at[top]], scores[top]
        return proved


def search(vectors: DataFrame, queries: Column, k: int, key: str = "vec_id", vector: str = "vector", block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, key, score) of the k best rows for each row where ``queries`` holds."""
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<bigint>").alias("v"), queries.alias("asks")
    )
    counts = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    blocks, chunks = max(1, math.ceil(counts["n"] / block)), max(1, math.ceil(counts["q"] / chunk))
    spread = lambda n: F.pmod(F.xxhash64("id", F.hash("v")), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def build(group: pa.Table) -> pa.Table:
        v = _matrix(group.column("v"))
        return pa.table({"block": group.column("block").slice(0, 1), "ids": [np.asarray(group.column("id")).tobytes()], "v": [v.tobytes()], "dims": pa.array([v.shape[1]], pa.int32())})

    def ask(index: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if index.num_rows and asked.num_rows:
            dims = index.column("dims")[0].as_py()
            ids = np.frombuffer(index.column("ids")[0].as_py(), np.int64)
            segments = Segments(ids, np.frombuffer(index.column("v")[0].as_py(), np.int64).reshape(len(ids), dims))
            own, version, q = asked.column("id").to_numpy(), asked.column("version").to_numpy(), _matrix(asked.column("v"))
            for at in range(0, len(own), TOGETHER):
                part = slice(at, at + TOGETHER)
                for a, b, (found, scores) in zip(own[part].tolist(), version[part].tolist(), segments.best(q[part], own[part], k)):
                    for c, x in zip(out, ([a] * len(found), [b] * len(found), found.tolist(), scores.tolist())):
                        c += x
        return pa.table([pa.array(c, pa.int64()) for c in out], ["query_id", "version", "id", "score"])

    index = rows.select("id", "v", spread(blocks).alias("block")).groupBy("block").applyInArrow(build, "block int, ids binary, v binary, dims int")
    asked = rows.where("asks").select("id", "v").distinct().select("id", "v", F.xxhash64("v").alias("version"), spread(chunks).alias("chunk"))
    met = (
        index.select("*", every(chunks).alias("chunk")).groupBy("block", "chunk")
        .cogroup(asked.select("*", every(blocks).alias("block")).groupBy("block", "chunk"))
        .applyInArrow(ask, "query_id long, version long, id long, score long")
    )
    place = F.row_number().over(Window.partitionBy("query_id", "version").orderBy(F.desc("score"), "id"))
    return met.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
