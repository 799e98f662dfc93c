"""Sessions and shared scratch space."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "ledgerloom", cpus: int = 8) -> SparkSession:
    """A session for one machine. On a cluster, take the session the cluster gives."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for written tables: in the shared folder of ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a new temporary folder. A cluster session is refused,
    as no machine-local folder is seen by all executors.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return f"{tempfile.mkdtemp(prefix='ledgerloom-')}/{label}"
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


@contextlib.contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Let Spark split generated methods that the virtual machine would not compile for their length (8,000 bytes)."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def counted_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Let joins be broadcast by what Spark measured while it shuffled, or by a hint, and not by the size of files.

    A packed file can be over a hundred times smaller than its rows, which a broadcast gathers on the driver. The limit for measured
    sizes is that of the session.
    """
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {name: spark.conf.get(name, None) for name in (planned, measured)}
    spark.conf.set(measured, before[measured] or spark.conf.get(planned))
    spark.conf.set(planned, "-1")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
