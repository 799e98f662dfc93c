"""Documents made ready for training: quality, near duplicates, benchmark leaks, secrets, tokens.

Each stage takes all documents that the one before kept. The first three drop documents, the fourth replaces secrets in texts by
a mark (and counts the characters anew), the last encodes the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontaminate, partenum, quality, secrets
from ledgerloom.llm.queries import multi_vocabulary
from ledgerloom.session import table
from ledgerloom.sinks import stage

#: Documents of smaller probability of good quality go.
LEAST_QUALITY = 0.5
#: Rows of the batches in which texts go to Python workers and back: one batch is held by the executor and by the worker.
BATCH_ROWS = 2_000


def _small_batches(spark: SparkSession) -> None:
    """Set the session to batches of ``BATCH_ROWS`` rows at most; the stages run when their results are written, so it stays set."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier does not reject."""
    _small_batches(spark)
    scored = quality.score(docs, table(spark, sf_dir, "labels"), out="__quality")
    return scored.where(F.col("__quality") >= LEAST_QUALITY).select(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked documents, the one of smallest id."""
    _small_batches(spark)
    return partenum.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    _small_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark."""
    _small_batches(spark)
    return secrets.redact(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, as little-endian 32-bit integers, with digests of the text and of the decoded ids."""
    _small_batches(spark)
    vocabulary = multi_vocabulary()
    named = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    decoded = bpe.decode(bpe.encode(named, *vocabulary), *vocabulary)
    return decoded.withColumns(
        {"n_tokens": (F.octet_length("ids") / 4).cast("long"), "decoded_sha256": F.sha2("decoded", 256)}
    ).drop("decoded")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", tokens),
]

#: SQL cannot express the classifier, the signatures or the encoding: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
