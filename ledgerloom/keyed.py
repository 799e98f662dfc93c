"""A stored table of one row per key that takes upserts without being written anew.

Rows are dealt to buckets by a hash of the key. An upsert reads only the buckets its keys fall into, merges them and writes them
to a new folder; a row in the commit log then says which write holds which bucket. Buckets that were not touched stay
in the files they are in, and a write that fails is never seen. A reader takes each bucket from its last write.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import commits
from ledgerloom.operators.upsert import upsert

_LOG = "write STRING, buckets ARRAY<INT>"
_BUCKET = "bucket"


class KeyedTable:
    """The table at ``path``. ``first`` columns keep the value of a key's first row, ``last`` take that of the last, ``add`` are
    summed, as in ``upsert``. Upserts must be given in the order of their rows; the number of buckets cannot change."""

    def __init__(
        self, spark: SparkSession, path: str, key: Sequence[str], first: Sequence[str] = (), last: Sequence[str] = (),
        add: Sequence[str] = (), buckets: int = 256,
    ):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets
        self.first, self.last, self.add = list(first), list(last), list(add)

    def _placed(self) -> dict[str, list[int]]:
        """The buckets of each write that readers take from it: as many in all as there are buckets."""
        log = commits.entries(self.spark, self.path, _LOG)
        if log is None:
            return {}
        latest = log.select("number", "write", F.explode("buckets").alias(_BUCKET)).groupBy(_BUCKET).agg(F.max_by("write", "number").alias("write"))
        return {r["write"]: sorted(r[_BUCKET]) for r in latest.groupBy("write").agg(F.collect_list(_BUCKET).alias(_BUCKET)).collect()}

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """All rows, or those of some buckets; None before the first write."""
        parts = []
        for write, held in self._placed().items():
            wanted = held if buckets is None else sorted(set(held) & set(buckets))
            if wanted:
                parts.append(self.spark.read.parquet(f"{self.path}/data/{write}").where(F.col(_BUCKET).isin(wanted)))
        return reduce(DataFrame.unionByName, parts).drop(_BUCKET) if parts else None

    def upsert(self, df: DataFrame, order: Sequence[str]) -> list[int]:
        """Merge the rows of ``df``, which come after all stored ones; gives the buckets that were written."""
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast(T.IntegerType())
        touched = sorted(r[0] for r in df.select(bucket).distinct().collect())
        if not touched:
            return []
        merged = upsert(df, self.key, list(order), self.first, self.last, self.add, self.read(touched))
        write = uuid.uuid4().hex
        # Rebalancing gives a bucket of usual size one file and splits a large one.
        merged.withColumn(_BUCKET, bucket).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/data/{write}")
        commits.record(self.spark, self.path, _LOG, write, touched)
        return touched
