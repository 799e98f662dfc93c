"""Where a warehouse keeps its tables: a folder per run under a shared path, and the committed run.

A load writes all its tables into a new run folder and commits that run last, so a load that fails midway leaves the
tables of the run before it as they were, and one that succeeds replaces them all at once: a table it did not write is gone.
Loads of one warehouse run one at a time.
Folders of runs that are no longer read can be removed by whoever owns the space.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from threading import Lock
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom import commits, sinks
from ledgerloom.operators import quality
from ledgerloom.operators.lookup import SMALL_ROWS
from ledgerloom.sources import readers
from ledgerloom.sources.schemas import FINWIRE, FINWIRE_TABLES, TARGETS

T = TypeVar("T")
ROUTED = "S_FinWire"
#: Targets written in the pass that finds which of their rows a lookup does not match; those are beside them, for the report.
MATCHED = ("Financial", "FactCashBalances", "FactWatches")
TOLD_AT_ONCE = 6  # kinds of messages that one plan finds
_KEPT, _SHOWN = "__kept", "__shown"


def _told(columns: Sequence[str]) -> Column:
    return F.concat_ws(", ", *[F.concat(F.lit(f"{c} = "), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in columns])


class Store:
    """Tables of one run of a warehouse. Every step reads its inputs from written tables, so a lost executor
    costs a re-read of files and no step carries the lineage of those before it."""

    def __init__(self, spark: SparkSession, path: str, batch: int = 1, message_time=None, run: str | None = None):
        self.spark = spark
        self.root = path.rstrip("/")
        self.run = run or uuid.uuid4().hex
        self.path = f"{self.root}/runs/{self.run}"
        self.batch = batch
        self.message_time = message_time
        self.messages: list[DataFrame] = []
        #: (data_set, attribute, value) counted while tables were written.
        self.measured: list[tuple[str, str, int]] = []
        #: Rows of the tables that this run has written.
        self.rows: dict[str, int] = {}
        self._lock = Lock()
        self._prepared: dict[str, object] = {}

    @classmethod
    def committed(cls, spark: SparkSession, path: str, batch: int = 1) -> Store | None:
        """The last committed run, or None."""
        log = commits.entries(spark, path.rstrip("/"), "run STRING")
        run = log.agg(F.max_by("run", "number")).first()[0] if log else None
        return cls(spark, path, batch, run=run) if run else None

    def commit(self) -> None:
        """Make this run the one that readers see."""
        commits.record(self.spark, self.root, "run STRING", self.run)

    def table(self, name: str) -> DataFrame:
        """A table; the record types of the fixed-width files are parts of one."""
        for kind, table in FINWIRE_TABLES.items():
            if table == name:
                return readers.of_kind(self.table(ROUTED), kind, FINWIRE[kind], "invalid_text", readers.REJECTED)
        if name in MATCHED:
            return self._divided(name).where(_KEPT).drop(_KEPT, _SHOWN)
        return self.spark.read.parquet(f"{self.path}/{name}")

    def reference(self, name: str) -> DataFrame:
        """A table of codes, days or times for lookups, with a broadcast hint where this run counted few rows."""
        return F.broadcast(self.table(name)) if self.rows.get(name, SMALL_ROWS + 1) <= SMALL_ROWS else self.table(name)

    def _divided(self, name: str) -> DataFrame:
        """A target written by ``save_matched``, with the rows that are not part of it."""
        layout = sinks.layout(f"{TARGETS[name]}, {_SHOWN} STRING, {_KEPT} BOOLEAN")
        return self.spark.read.schema(layout).parquet(f"{self.path}/{name}")

    def save(
        self, name: str, df: DataFrame, *, measures: Mapping[tuple[str, str], str] | None = None, apart: str | None = None
    ) -> DataFrame:
        """Write a table, in its declared layout if it has one, and report the rows written.

        ``measures`` {(data_set, attribute): SQL aggregate} of whole numbers are taken from the rows as they are written. Rows are
        written apart by the column ``apart``. Values in a column ``rejected`` are reported.
        """
        if name in MATCHED:
            raise ValueError(f"{name} is written by save_matched")
        if name in TARGETS:
            df = sinks.conform(df, sinks.layout(TARGETS[name]))
        measures = dict(measures or {})
        seen = Observation(f"{name}-{self.run}")
        counted = [F.count(F.lit(1)).alias("rows"), *(F.expr(c).cast("bigint").alias(f"m{i}") for i, c in enumerate(measures.values()))]
        written = df.observe(seen, *counted).write.mode("overwrite").option("compression", "zstd")
        written.partitionBy(*([apart] if apart else [])).parquet(f"{self.path}/{name}")
        found = seen.get
        written = self.table(name)
        with self._lock:
            self.rows[name] = found["rows"]
            self.measured += [(*key, found[f"m{i}"]) for i, key in enumerate(measures)]
            if name in TARGETS:
                self.report(quality.counted_message(self.spark, found["rows"], name, batch=self.batch))
            if readers.REJECTED in df.columns:
                self.report(self.rejects(name, written))
        return written

    def save_matched(self, name: str, df: DataFrame, found: Column, text: str, *shown: str) -> DataFrame:
        """Write the rows where ``found`` holds as one of the targets ``MATCHED``; each other row is reported with the columns ``shown``.

        One pass writes both: ``matched`` and ``save`` would write the kept rows twice.
        """
        kept = F.coalesce(found, F.lit(False))
        rows = df.withColumns({_KEPT: kept, _SHOWN: F.when(~kept, _told(shown))})
        rows = sinks.conform(rows, sinks.layout(f"{TARGETS[name]}, {_SHOWN} STRING, {_KEPT} BOOLEAN"))
        seen = Observation(f"{name}-{self.run}")
        written = rows.observe(seen, F.count_if(F.col(_KEPT)).alias("rows")).write.mode("overwrite").option("compression", "zstd")
        written.partitionBy(_KEPT).parquet(f"{self.path}/{name}")
        rest = self._divided(name).where(~F.col(_KEPT))
        with self._lock:
            self.report(
                quality.counted_message(self.spark, seen.get["rows"], name, batch=self.batch),
                quality.check(rest, F.lit(True), name, text, F.col(_SHOWN), batch=self.batch),
            )
        return self.table(name)

    def rejects(self, source: str, rows: DataFrame) -> DataFrame:
        """A message for each value that did not fit: the column and what was written."""
        each = rows.where(F.size(readers.REJECTED) > 0).select(F.explode(readers.REJECTED).alias("r"))
        data = F.concat("r.column_name", F.lit(" = "), "r.written")
        return quality.check(each, F.lit(True), source, "Value does not fit", data, batch=self.batch)

    def prepared(self, label: str, make: Callable[[], T]) -> T:
        """What ``make`` gives, made once in this run."""
        with self._lock:
            if label not in self._prepared:
                self._prepared[label] = make()
            return self._prepared[label]

    def matched(self, target: str, df: DataFrame, found: Column, text: str, *shown: str) -> DataFrame:
        """The rows where ``found`` holds; each other row is reported with the columns ``shown``. One pass writes both."""
        rows, rest = sinks.divide(df, found, f"matched-{target}")
        self.report(quality.check(rest, F.lit(True), target, text, _told(shown), batch=self.batch))
        return rows

    def report(self, *messages: DataFrame) -> None:
        """Note quality or status messages; they read written tables only, and ``flush`` writes them."""
        self.messages += messages

    def flush(self) -> None:
        """Append the noted messages to the message table, all with one time.

        A few are written at a time: a plan over all tables of a load takes more of the driver's memory than any step.
        """
        noted, self.messages = self.messages, []
        if not noted:
            return
        at = self.message_time
        if at is None:
            at = F.timestamp_micros(F.lit(self.spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]))
        layout = sinks.layout(TARGETS["DImessages"])
        for i in range(0, len(noted), TOLD_AT_ONCE):
            stamped = quality.stamped(quality.union_messages(*noted[i : i + TOLD_AT_ONCE]), at)
            sinks.append(stamped.toDF(*layout.names), f"{self.path}/DImessages", layout)

    def start_over(self) -> None:
        """Begin the run with an empty message table."""
        layout = sinks.layout(TARGETS["DImessages"])
        sinks.create(self.spark.createDataFrame([], layout), f"{self.path}/DImessages", layout)
