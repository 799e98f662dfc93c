"""Raw files to reference and staging tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.cleanse import compact_date, integer_or_null, iso_date, to_boolean, to_decimal, to_integer
from ledgerloom.operators import quality
from ledgerloom.operators.lookup import merge_join
from ledgerloom.plans.store import ROUTED, Store
from ledgerloom.sources import readers
from ledgerloom.sources import schemas as layouts

SIDE_BY_SIDE = 4


def amount(digits: int):
    return lambda value: to_decimal(value, digits, 2)


#: What the text fields of the fixed-width records must fit; the dimension loads type them.
FINWIRE_CASTS = {
    "CMP": {"PTS": compact_date, "CIK": to_integer, "FOUNDING_DATE": compact_date},
    "SEC": {
        "PTS": compact_date, "SH_OUT": to_integer, "FIRST_TRADE_DATE": compact_date,
        "FIRST_TRADE_EXCHANGE": compact_date, "DIVIDEN": amount(10),
    },
    "FIN": {
        "PTS": compact_date, "YEAR": to_integer, "QUARTER": to_integer, "QTR_START_DATE": compact_date,
        **dict.fromkeys(("REVENUE", "EARNINGS", "INVENTORY", "ASSETS", "LIABILITIES"), amount(15)),
        **dict.fromkeys(("EPS", "DILUTED_EPS", "MARGIN"), amount(10)),
        "SH_OUT": to_integer, "DILUTED_SH_OUT": to_integer,
    },
}


def _count(condition: str | None = None) -> str:
    return "count(1)" if condition is None else f"count_if({condition})"


#: Counts taken while a staging table is written: {table: {(data set, attribute): SQL aggregate}}.
MEASURES = {
    "S_Broker": {("DimBroker", "HR_BROKERS"): _count(f"EmployeeJobCode = {layouts.JOB_CODE_BROKER}")},
    "S_Prospect": {("Prospect", "P_RECORDS"): _count()},
    "S_Cash_Balances": {("FactCashBalances", "CT_RECORDS"): _count()},
    "S_Watches": {("FactWatches", "WH_RECORDS"): _count(), ("FactWatches", "WH_ACTIVE"): _count("W_ACTION = 'ACTV'")},
    "S_Fact_Holding": {("FactHoldings", "HH_RECORDS"): _count()},
    "S_DailyMarketHistory": {("FactMarketHistory", "DM_RECORDS"): _count()},
    "S_Trade": {("DimTrade", "T_Records"): _count(), ("DimTrade", "T_CanceledTrades"): _count("T_ST_ID = 'CNCL'")},
    ROUTED: {
        (data_set, f"FW_{kind}"): _count(f"{readers.KIND} = '{kind}'")
        for data_set, kind in (("DimCompany", "CMP"), ("DimSecurity", "SEC"), ("Financial", "FIN"))
    },
    "S_Customer": {
        **{("DimCustomer", f"C_{kind}"): _count(f"CA_INDEX = 0 AND ActionType = '{kind}'") for kind in layouts.CUSTOMER_ACTIONS},
        **{("DimAccount", f"CA_{kind}"): _count(f"ActionType = '{kind}'") for kind in ("ADDACT", "UPDACCT", "CLOSEACCT")},
    },
}


def delimited_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the fixed delimited files as typed rows, with what does not fit in ``rejected``."""
    file, sep, columns = {**layouts.REFERENCE_FILES, **layouts.STAGING_FILES}[name]
    return readers.read_rows(spark, folder + file, columns, sep, dict.fromkeys(layouts.FLAGS.get(name, ()), to_boolean))


def batch_date(spark: SparkSession, folder: str, batch: int) -> DataFrame:
    return readers.read_batch_date(spark, folder + "BatchDate.txt").select(
        F.lit(batch).alias("batch_number"), "batch_date"
    )


def audit(spark: SparkSession, folder: str) -> DataFrame:
    return readers.read_delimited(spark, folder + "*_audit.csv", layouts.AUDIT, ",", header=True)


def finwire(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all fixed-width files, of any type."""
    lines = readers.read_lines(spark, folder + "FINWIRE*", name_has="FINWIRE", name_lacks="audit")
    return readers.routed_fixed_width(
        readers.flag_invalid(lines), "value", layouts.FINWIRE, layouts.FINWIRE_TYPE, FINWIRE_CASTS
    )


def customer_actions(spark: SparkSession, file: str) -> DataFrame:
    """Customer management actions, one row per action and account (one row if it has none).

    An absent field is null, a present but empty one is blank. ``ACTION_SEQ`` follows the file,
    ``CA_INDEX`` numbers the accounts of an action from 0.
    """
    actions = readers.read_xml_records(
        spark, file, layouts.ACTION_TAG, layouts.ACTION, order="ACTION_SEQ"
    )
    fields = []
    for group, names in layouts.CUSTOMER_GROUPS.items():
        prefix = f"Customer.{group}." if group else "Customer._"
        fields += [F.col(prefix + name).alias(name) for name in names]
    for phone in layouts.PHONES:
        fields += [
            F.col(f"Customer.ContactInfo.{phone}.{part}").alias(f"{phone}_{part}")
            for part in layouts.PHONE_PARTS
        ]
    flat = actions.select(
        F.col("_ActionType").alias("ActionType"),
        F.col("_ActionTS").alias("ActionTS"),
        F.col("_ActionTS").try_cast("timestamp_ntz").alias("ACTION_AT"),
        iso_date("_ActionTS").alias("ACTION_DAY"),
        "ACTION_SEQ",
        F.col("Customer._C_ID").alias("written_id"),
        to_integer("Customer._C_ID").alias("C_ID"),
        *fields,
        F.posexplode_outer("Customer.Account").alias("CA_INDEX", "account"),
    )
    # An action is on as many rows as it has accounts: its own values are reported once.
    first = F.coalesce("CA_INDEX", F.lit(0)) == 0
    once = {
        "C_ID": (F.col("written_id"), F.col("C_ID")), "ActionTS": (F.col("ActionTS"), F.col("ACTION_DAY")),
        "C_DOB": (F.col("C_DOB"), iso_date("C_DOB")),
    }
    checks = {name: (F.when(first, written), typed) for name, (written, typed) in once.items()} | {
        name: (F.col(f"account.{path}"), cast(f"account.{path}"))
        for name, path, cast in (("CA_ID", "_CA_ID", to_integer), ("CA_TAX_ST", "_CA_TAX_ST", integer_or_null), ("CA_B_ID", "CA_B_ID", to_integer))
    }
    return flat.select(
        "*",
        to_integer("account._CA_ID").alias("CA_ID"),
        F.col("account._CA_TAX_ST").alias("CA_TAX_ST"),
        F.col("account.CA_B_ID").alias("CA_B_ID"),
        F.col("account.CA_NAME").alias("CA_NAME"),
        readers.rejected(checks).alias(readers.REJECTED),
    ).drop("account", "written_id").withColumn("CA_INDEX", F.coalesce("CA_INDEX", F.lit(0)))


def trade_joined(store: Store) -> DataFrame:
    """Every step of a trade's history with the trade: made when asked for, as no other table of the load reads it.

    Both sides grow with the trades and their files are packed, so by the size of those neither may go to the driver.
    """
    trades, history = (store.table(name).drop(readers.REJECTED) for name in ("S_Trade", "S_Trade_History"))
    return merge_join(history, trades.hint("merge"), "TH_T_ID", "T_ID")


def _save_all(store: Store, tables: dict[str, DataFrame]) -> None:
    """Write independent tables side by side: most are too small to fill a cluster alone."""
    def save(item: tuple[str, DataFrame]) -> None:
        name, rows = item
        store.save(name, rows, measures=MEASURES.get(name), apart=readers.KIND if name == ROUTED else None)

    with ThreadPoolExecutor(max_workers=SIDE_BY_SIDE) as pool:
        list(pool.map(save, tables.items()))


def load_reference(store: Store, folder: str) -> None:
    spark = store.spark
    tables = {name: delimited_table(spark, folder, name) for name in layouts.REFERENCE_FILES}
    tables |= {"batch_date": batch_date(spark, folder, store.batch), "Audit": audit(spark, folder)}
    _save_all(store, tables)


def load_staging(store: Store, folder: str) -> None:
    spark = store.spark
    tables = {ROUTED: finwire(spark, folder), "S_Customer": customer_actions(spark, folder + "CustomerMgmt.xml")}
    tables |= {name: delimited_table(spark, folder, name) for name in layouts.STAGING_FILES}
    _save_all(store, tables)
    for name in layouts.FINWIRE_TABLES.values():
        store.report(
            quality.check(
                store.table(name), F.col("invalid_text"), name, "Invalid bytes in line", F.col("PTS"),
                batch=store.batch,
            )
        )
    code = F.coalesce(readers.field_at(F.col("unknown_line"), *layouts.FINWIRE_TYPE), F.lit(""))
    unknown = store.table(ROUTED).where(F.col(readers.KIND) == readers.UNKNOWN_KIND).groupBy(code.alias("code")).count()
    store.report(
        quality.check(
            unknown, F.lit(True), ROUTED, "Unknown record type",
            F.concat(F.lit("type = "), "code", F.lit(", lines = "), F.col("count").cast("string")), batch=store.batch,
        )
    )
