"""Connected components, and a filter of fixed size for sets of ids."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sinks import stage

FILTER_BITS = 25


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id in ``edges`` (a, b): the smallest id that its edges reach. Null ends and loops are no edges.

    Each round hooks an id to its smallest neighbour below, follows the hooks to their roots by pointer
    doubling, and contracts the edges. Every step is a written table: no step repeats another, and nothing is gathered
    on the driver but counts. Minima combine before the shuffle, and joins with a hot root have one row on the other side."""
    labels = None
    while True:
        edges = stage(
            edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
        )
        if edges.isEmpty():
            break
        hooks = stage(edges.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("root")), "hooks")
        while True:
            above = hooks.select(F.col("id").alias("root"), F.col("root").alias("above"))
            moved = stage(hooks.join(above, "root", "left").select("id", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "hooks")
            hooks = moved.select("id", "root")
            if moved.where("moved").isEmpty():
                break
        if labels is None:
            roots = edges.select(F.col("a").alias("id")).distinct().join(hooks, "id", "left_anti")
            labels = stage(hooks.unionByName(roots.withColumn("root", F.col("id"))), "labels")
        else:
            labels = stage(_moved(labels, hooks, "root"), "labels")
        edges = _moved(_moved(edges, hooks, "a"), hooks, "b")
    return labels if labels is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("root"))


def _moved(rows: DataFrame, hooks: DataFrame, column: str) -> DataFrame:
    to = hooks.select(F.col("id").alias(column), F.col("root").alias("__to"))
    return rows.join(to, column, "left").withColumn(column, F.coalesce("__to", column)).drop("__to").select(*rows.columns)


def filter_of(ids: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test that every id passes and few others do: one bit of 2 ** FILTER_BITS for each of two hashes. Its size does not
    grow with the ids; with very many of them it passes more that are none, which a join sorts out."""
    bits = ids.select(F.explode(F.array(*(F.shiftrightunsigned(F.xxhash64(column, F.lit(k)), 64 - FILTER_BITS) for k in (1, 2)))).alias("bit"))
    word = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    found = word.toPandas()
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    table[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint64)
    share = ids.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def passes(first: pd.Series, second: pd.Series) -> pd.Series:
        out = np.ones(len(first), bool)
        for s in (first, second):
            bit = s.to_numpy(np.int64)
            out &= (share.value[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) > 0
        return pd.Series(out)

    def test(value: Column) -> Column:
        return passes(*(F.shiftrightunsigned(F.xxhash64(value, F.lit(k)), 64 - FILTER_BITS) for k in (1, 2)))

    return test
