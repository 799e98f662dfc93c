"""The full historical load of one batch, in dependency order."""

from __future__ import annotations

import contextlib
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import quality
from ledgerloom.plans import dimensions, facts, staging
from ledgerloom.plans.store import Store
from ledgerloom.session import counted_broadcasts, short_methods
from ledgerloom.sources.readers import batch_path
from ledgerloom.sources.schemas import TARGET_KEYS

# Each step reads tables written by the steps before it.
STEPS = {
    "DimCompany": dimensions.load_company,
    "Financial": dimensions.load_financial,
    "DimSecurity": dimensions.load_security,
    "Prospect": dimensions.load_prospect,
    "DimBroker": dimensions.load_broker,
    "DimCustomer": dimensions.load_customer,
    "DimAccount": dimensions.load_account,
    "DimTrade": facts.load_trade,
    "FactCashBalances": facts.load_cash_balances,
    "FactHoldings": facts.load_holdings,
    "FactWatches": facts.load_watches,
}


def check_targets(store: Store) -> None:
    """Report keys that occur twice and key columns that are null."""
    for name, key in TARGET_KEYS.items():
        table = store.table(name)
        text = F.concat_ws(", ", *[F.concat(F.lit(f"{c} = "), F.col(c).cast("string")) for c in key])
        twice = quality.check(
            quality.duplicate_keys(table, key), F.lit(True), name, "Duplicate key", text, batch=store.batch
        )
        nulls = quality.check(
            quality.null_counts(table, key), F.col("nulls") > 0, name, "Null in key",
            F.concat("column_name", F.lit(": "), F.col("nulls").cast("string")), batch=store.batch,
        )
        store.report(quality.union_messages(twice, nulls))


def audit_differences(store: Store, actual: DataFrame) -> DataFrame:
    """Audit rows of the batch beside actual (data_set, attribute, value) rows."""
    expected = store.table("Audit").where(F.col("BatchID") == store.batch).select(
        F.col("DataSet").alias("data_set"),
        F.col("AT_Attribute").alias("attribute"),
        F.coalesce("AT_Value", "DValue").alias("value"),
    )
    return quality.reconcile(expected, actual)


def check_audit(store: Store) -> DataFrame:
    """Compare what was counted while tables were written with the Audit rows; the result is a table, differences are reported."""
    actual = store.spark.createDataFrame(store.measured, "data_set STRING, attribute STRING, value BIGINT")
    compared = store.save("AuditResult", audit_differences(store, actual.withColumn("value", F.col("value").cast("decimal(20, 5)"))))
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    store.report(
        quality.check(
            compared, ~F.col("matches"), "Audit", "Audit difference",
            F.concat("data_set", F.lit("."), "attribute", F.lit(": expected "), written("expected"), F.lit(", found "), written("actual")),
            batch=store.batch,
        )
    )
    return compared


def finish(store: Store) -> None:
    """Write the messages, then let readers see the run."""
    store.flush()
    store.commit()


def run(
    spark: SparkSession,
    raw: str,
    scale: int | str,
    out: str,
    batch: int = 1,
    message_time: Column | None = None,
) -> tuple[Store, dict[str, float]]:
    """Load ``<raw>/<scale>/Batch<batch>/`` into tables under ``out``, in place of those of the run before.

    Returns the store and the seconds of each step. ``out`` must be a path all executors share. Nothing is replaced before the last step
    is done: ``Store.committed`` gives the tables of the last run that came to its end. A load that fails leaves its messages in its own run.
    """
    store = Store(spark, out, batch, message_time)
    folder = batch_path(raw, scale, batch)
    seconds = {}

    def timed(name: str, step, *arguments) -> None:
        began = time.monotonic()
        step(*arguments)
        seconds[name] = time.monotonic() - began

    with counted_broadcasts(spark):
        timed("start over", store.start_over)
        try:
            timed("reference", staging.load_reference, store, folder)
            with short_methods(spark):  # wide rows of text
                timed("staging", staging.load_staging, store, folder)
            for name, step in STEPS.items():
                timed(name, step, store)
            check_targets(store)
            check_audit(store)
        except BaseException:
            with contextlib.suppress(Exception):  # the step's own error is the one to see
                store.flush()
            raise
        timed("messages", finish, store)
    return store, seconds
