"""Trade dimension and fact loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import sinks
from ledgerloom.operators import lookup as look
from ledgerloom.operators import upsert as ups
from ledgerloom.operators.ordered import ROWS_PER_TASK, UNCUT, ordered_scan, together
from ledgerloom.plans.store import Store
from ledgerloom.sources import schemas as layouts

ROW = "row_number"  # differs for each row of a written table


def trade_lifecycle(trades: DataFrame, history: DataFrame, how: str = "inner") -> DataFrame:
    """Trades that have a history, with the time they were created and the time they were closed; with ``how`` left all
    trades, and whether they have one in ``has_history``.

    A market order is created when submitted, any other when it becomes pending; completion or
    cancellation closes it. The history is reduced to one row per trade before the join.
    """
    step = F.col("TH_ST_ID")
    steps = ups.open_close(
        history, ["TH_T_ID"], "TH_DTS",
        opened={"submitted": step == "SBMT", "pending": step == "PNDG"},
        closed={"closed": step.isin("CMPT", "CNCL")},
    )
    market = F.col("T_TT_ID").isin(*layouts.MARKET_ORDERS)
    return (
        trades.join(steps, F.col("T_ID") == F.col("TH_T_ID"), how)
        .withColumn("created", F.least("pending", F.when(market, F.col("submitted"))))
        .withColumns({"has_history": F.col("TH_T_ID").isNotNull()} if how == "left" else {})
        .drop("TH_T_ID", "submitted", "pending")
    )


def _clock(store: Store, rows: DataFrame, ts: str, prefix: str) -> DataFrame:
    return look.date_time_keys(
        rows, ts, store.reference("DimDate"), "DateValue", "SK_DateID",
        store.reference("DimTime"), "TimeValue", "SK_TimeID",
        date_name=f"SK_{prefix}DateID", time_name=f"SK_{prefix}TimeID", how="left",
    )


def load_trade(store: Store) -> None:
    statuses = store.reference("StatusType").select("ST_ID", F.col("ST_NAME").alias("Status"))
    types = store.reference("TradeType").select("TT_ID", F.col("TT_NAME").alias("Type"))
    trades = look.star_lookup(
        trade_lifecycle(store.table("S_Trade"), store.table("S_Trade_History"), how="left"),
        (statuses, "T_ST_ID", "ST_ID"),
        (types, "T_TT_ID", "TT_ID"),
        how="left",
    )
    trades = _clock(store, _clock(store, trades, "created", "Create"), "closed", "Close")
    trades = store.matched(
        "DimTrade", trades.withColumns({"day": F.to_date(F.coalesce("created", "T_DTS")), ROW: F.monotonically_increasing_id()}),
        F.col("has_history") & F.col("Status").isNotNull() & F.col("Type").isNotNull(),
        "Trade without history, status or type", "T_ID", "T_ST_ID", "T_TT_ID", "has_history",
    )
    # Each dimension is looked up with its own validity; a trade outside it keeps its row.
    trades = look.temporal_lookups(
        trades, "day", [ROW],
        look.Versions(
            store.table("DimSecurity"), {"T_S_SYMB": "Symbol"}, "EffectiveDate", "EndDate", ["SK_SecurityID", "SK_CompanyID"], flat=True
        ),
        look.Versions(
            store.table("DimAccount"), {"T_CA_ID": "AccountID"}, "EffectiveDate", "EndDate",
            ["SK_AccountID", "SK_CustomerID", "SK_BrokerID"], flat=True,
        ),
        unique=True,
    )
    store.save(
        "DimTrade",
        trades.select(
            F.col("T_ID").alias("TradeID"),
            "SK_BrokerID", "SK_CreateDateID", "SK_CreateTimeID", "SK_CloseDateID", "SK_CloseTimeID",
            "Status", "Type",
            F.col("T_IS_CASH").alias("CashFlag"),
            "SK_SecurityID", "SK_CompanyID",
            F.col("T_QTY").alias("Quantity"),
            F.col("T_BID_PRICE").alias("BidPrice"),
            "SK_CustomerID", "SK_AccountID",
            F.col("T_EXEC_NAME").alias("ExecutedBy"),
            F.col("T_TRADE_PRICE").alias("TradePrice"),
            F.col("T_CHRG").alias("Fee"),
            F.col("T_COMM").alias("Commission"),
            F.col("T_TAX").alias("Tax"),
            F.lit(store.batch).alias("BatchID"),
        ),
    )


def daily_balances(cash: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Net amount and balance of each account at the end of each day with a transaction.

    Accounts have few transactions a day, so rows are shuffled once, by account, and not as sums by account and day before that;
    with an account too large for one task they are.
    """
    rows = cash.select(F.col("CT_CA_ID").alias("AccountID"), F.to_date("CT_DTS").alias("day"), "CT_AMT")
    placed = together(rows, ["AccountID"], rows_per_task=rows_per_task)
    days = (rows if placed is None else placed).groupBy("AccountID", "day").agg(F.sum("CT_AMT").alias("net"))
    return ordered_scan(days, ["AccountID"], ["day"], total={"Cash": "net"}, cuts=UNCUT)


def cash_totals(cash: DataFrame) -> DataFrame:
    """One row per account: the date of its first transaction and the sum of all."""
    rows = cash.select(
        F.col("CT_CA_ID").alias("AccountID"), "CT_DTS", "CT_NAME",
        F.to_date("CT_DTS").alias("first_day"), F.col("CT_AMT").alias("Cash"),
    )
    return ups.upsert(rows, ["AccountID"], ["CT_DTS", "CT_NAME"], first=["first_day"], add=["Cash"])


def load_cash_balances(store: Store) -> None:
    accounts = store.table("DimAccount").where("IsCurrent").select(
        F.col("AccountID").alias("account"), "SK_AccountID", "SK_CustomerID"
    )
    balances = look.star_lookup(
        daily_balances(store.table("S_Cash_Balances")), (accounts, "AccountID", "account"), how="left"
    )
    keyed = look.date_time_keys(
        balances, "day", store.reference("DimDate"), "DateValue", "SK_DateID", date_name="SK_DateID", how="left"
    )
    store.save_matched(
        "FactCashBalances", keyed.withColumn("BatchID", F.lit(store.batch)), F.col("SK_AccountID").isNotNull() & F.col("SK_DateID").isNotNull(),
        "Balance without account or date", "AccountID", "day",
    )


def load_holdings(store: Store) -> None:
    trades = store.table("DimTrade").select(
        F.col("TradeID").alias("CurrentTradeID"),
        "SK_CustomerID", "SK_AccountID", "SK_SecurityID", "SK_CompanyID",
        F.col("SK_CloseDateID").alias("SK_DateID"),
        F.col("SK_CloseTimeID").alias("SK_TimeID"),
        F.col("TradePrice").alias("CurrentPrice"),
    )
    history = store.table("S_Fact_Holding").select(
        F.col("HH_H_T_ID").alias("TradeID"),
        F.col("HH_T_ID").alias("CurrentTradeID"),
        F.col("HH_BEFORE_QTY").alias("before"),
        F.col("HH_AFTER_QTY").alias("CurrentHolding"),
    )
    rows = history.join(trades.withColumn("known", F.lit(True)), "CurrentTradeID", "left").withColumn("nth", F.col("CurrentTradeID"))
    rows = store.matched("FactHoldings", rows, F.col("known"), "Holding without trade", "TradeID", "CurrentTradeID")
    holdings = ups.upsert(
        rows, ["TradeID"], ["nth", "before", "CurrentHolding"],
        first=[
            "CurrentTradeID", "SK_CustomerID", "SK_AccountID", "SK_SecurityID", "SK_CompanyID",
            "SK_DateID", "SK_TimeID",
        ],
        last=["CurrentPrice", "CurrentHolding"],
    )
    store.save("FactHoldings", holdings.withColumn("BatchID", F.lit(store.batch)))


def watch_spans(watches: DataFrame) -> DataFrame:
    """When each customer first watched each security and last stopped; a watch placed again later is not stopped."""
    action = F.col("W_ACTION")
    spans = ups.open_close(
        watches, ["W_C_ID", "W_S_SYMB"], "W_DTS",
        opened={"placed": action == "ACTV"}, closed={"removed": action == "CNCL", "again": action == "ACTV"},
    )
    lasting = F.col("again").isNull() | (F.col("removed") >= F.col("again"))
    return spans.withColumn("removed", F.when(lasting, F.col("removed"))).drop("again")


def load_watches(store: Store) -> None:
    watches = watch_spans(store.table("S_Watches")).withColumn("day", F.to_date(F.coalesce("placed", "removed")))
    watches = look.temporal_lookups(
        sinks.stage(watches.withColumn(ROW, F.monotonically_increasing_id()), "watches"), "day", [ROW],
        look.Versions(store.table("DimCustomer"), {"W_C_ID": "CustomerID"}, "EffectiveDate", "EndDate", ["SK_CustomerID"], flat=True),
        look.Versions(store.table("DimSecurity"), {"W_S_SYMB": "Symbol"}, "EffectiveDate", "EndDate", ["SK_SecurityID"], flat=True),
        unique=True,
    )
    dates = store.reference("DimDate")
    for ts, name in (("placed", "SK_DateID_DatePlaced"), ("removed", "SK_DateID_DateRemoved")):
        watches = look.date_time_keys(
            watches, ts, dates, "DateValue", "SK_DateID", date_name=name, how="left"
        )
    store.save_matched(
        "FactWatches", watches.withColumn("BatchID", F.lit(store.batch)), F.col("SK_CustomerID").isNotNull() & F.col("SK_SecurityID").isNotNull(),
        "Watch without customer or security", "W_C_ID", "W_S_SYMB", "day",
    )
