"""A raw batch derived from the Parquet tables: the files a full load reads.

Customers are the companies and the customers, suppliers the employees, parts the securities, orders
the trades and most changes, lineitems the cash and market rows, events the watches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import events_with_k, text
from ledgerloom.functions.cleanse import clock_text, money
from ledgerloom.session import table
from ledgerloom.sources.schemas import FINWIRE

STATUS_TYPES = (
    ("ACTV", "Active"), ("CMPT", "Completed"), ("CNCL", "Canceled"), ("PNDG", "Pending"),
    ("SBMT", "Submitted"), ("INAC", "Inactive"),
)
TRADE_TYPES = (
    ("TMB", "Market Buy", "0", "1"), ("TMS", "Market Sell", "1", "1"), ("TLB", "Limit Buy", "0", "0"),
)
OPENED = "1994-06-01"
NO_COMPANY = 3
#: The files are written packed, as they are several times the tables they come from. A packed file goes to one task, so each is small.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000}


def _lines(*fields: Column | str, sep: str = "|") -> Column:
    """A delimited line; nulls are written as the null mark."""
    written = [F.col(f) if isinstance(f, str) else f for f in fields]
    return F.concat_ws(sep, *[F.coalesce(f.cast("string"), F.lit("\\N")) for f in written])


def _record(kind: str, **values: Column) -> Column:
    """A fixed-width line of one record type."""
    parts = []
    for name, (start, end) in FINWIRE[kind].items():
        value = F.lit(kind) if name == "REC_TYPE" else values.get(name, F.lit(""))
        parts.append(value if end is None else F.rpad(value.cast("string"), end - start, " "))
    return F.concat(*parts)


def _padded(number: Column | str, width: int) -> Column:
    return F.lpad(text(number), width, "0")


def _at(day: Column | str, number: Column | str) -> Column:
    """A moment of the day that differs for every number."""
    return F.expr(f"timestampadd(MICROSECOND, {number}, {day})")


def _actions(customers: DataFrame, orders: DataFrame, brokers: int) -> DataFrame:
    key, order = text("c_custkey"), text("o_orderkey")

    def action(kind: str, at: Column | str, customer: Column | str, body: Column, **attributes) -> Column:
        extra = [F.concat(F.lit(f' {n}="'), v, F.lit('"')) for n, v in attributes.items()]
        return F.concat(
            F.lit(f'<TPCDI:Action ActionType="{kind}" ActionTS="'),
            F.translate(text(at), " ", "T"), F.lit('"><Customer C_ID="'), text(customer),
            F.lit('"'), *extra, F.lit(">"), body, F.lit("</Customer></TPCDI:Action>"),
        )

    def wrap(tag: str, *inner: Column) -> Column:
        return F.concat(F.lit(f"<{tag}>"), *inner, F.lit(f"</{tag}>"))

    def account(number: Column, attributes: Column, *inner: Column) -> Column:
        return F.concat(
            F.lit('<Account CA_ID="'), number, F.lit('"'), attributes, F.lit(">"), *inner, F.lit("</Account>")
        )

    opened = action(
        "NEW", F.lit(f"{OPENED} 08:00:00").cast("timestamp_ntz"), "c_custkey",
        F.concat(
            wrap("Name", wrap("C_L_NAME", F.col("c_mktsegment")), wrap("C_F_NAME", F.col("c_name"))),
            wrap(
                "Address", wrap("C_ADLINE1", F.concat(F.lit("Street "), text("c_nationkey"))),
                wrap("C_ZIPCODE", key),
            ),
            wrap(
                "ContactInfo", wrap("C_PRIM_EMAIL", F.concat(F.lit("c"), key, F.lit("@x"))),
                wrap("C_PHONE_1", wrap("C_AREA_CODE", text(100 + F.col("c_nationkey"))), wrap("C_LOCAL", key)),
            ),
            wrap("TaxInfo", wrap("C_NAT_TX_ID", F.concat(F.lit("N"), _padded("c_nationkey", 2)))),
            account(
                key, F.concat(F.lit(' CA_TAX_ST="'), text(F.col("c_custkey") % 4), F.lit('"')),
                wrap("CA_B_ID", text(F.col("c_custkey") % brokers)), wrap("CA_NAME", F.concat(F.lit("Account "), key)),
            ),
        ),
        C_GNDR=F.left("c_mktsegment", F.lit(1)), C_TIER=text(1 + F.col("c_custkey") % 3), C_DOB=F.lit("1970-01-01"),
    )
    at = _at("o_orderdate", "o_orderkey")
    email = F.when(F.col("o_orderkey") % 3 == 1, "<C_PRIM_EMAIL/>").when(
        F.col("o_orderkey") % 3 == 2, F.concat(F.lit("<C_PRIM_EMAIL>o"), order, F.lit("@x</C_PRIM_EMAIL>"))
    ).otherwise("")
    mine = text("o_custkey")
    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    change = (
        F.when(status == "P", action("UPDCUST", at, "o_custkey", wrap("ContactInfo", email), C_TIER=text(F.col("o_orderkey") % 5)))
        .when((status == "F") & (priority == "5-LOW") & (price > 400_000), action("INACT", at, "o_custkey", F.lit("")))
        .when(
            (status == "O") & (priority == "1-URGENT"),
            action("UPDACCT", at, "o_custkey", account(mine, F.lit(""), wrap("CA_NAME", F.concat(F.lit("Renamed "), order)))),
        )
        .when(
            (status == "O") & (priority == "5-LOW") & (price > 400_000),
            action("CLOSEACCT", at, "o_custkey", account(mine, F.lit(""))),
        )
    )
    changes = orders.select(change.alias("line")).where("line IS NOT NULL")
    return customers.select(opened.alias("line")).unionByName(changes)


def _companies(customers: DataFrame, orders: DataFrame) -> DataFrame:
    def company(day: Column, rating: Column) -> Column:
        return _record(
            "CMP", PTS=day, COMPANY_NAME=F.col("c_name"), CIK=_padded("c_custkey", 10), STATUS=F.lit("ACTV"),
            INDUSTRY_ID=_padded("c_nationkey", 2), SP_RATING=rating, FOUNDING_DATE=F.lit("19500101"),
            DESCRIPTION=F.col("c_mktsegment"),
        )

    first = customers.select(company(F.lit("19940101-000000"), F.lit("A")).alias("line"))
    digit = F.col("o_orderkey") % 4
    rating = F.when(digit == 0, "AA").when(digit == 1, "BBB").when(digit == 2, "BB").otherwise("")
    finished = orders.where("o_orderstatus = 'F'").join(customers, F.col("c_custkey") == F.col("o_custkey"))
    moment = F.expr("timestampadd(SECOND, o_orderkey % 86400, o_orderdate)")
    later = finished.select(company(F.date_format(moment, "yyyyMMdd-HHmmss"), rating).alias("line"))
    return first.unionByName(later)


def _securities(parts: DataFrame, companies: int) -> DataFrame:
    """Some name a company that is not there."""
    company = F.col("p_partkey") % (companies + NO_COMPANY)
    ref = F.when(F.col("p_partkey") % 2 == 0, _padded(company, 10)).otherwise(
        F.concat(F.lit("Customer#"), _padded(company, 9))
    )

    def security(day: str, status: str) -> Column:
        return _record(
            "SEC", PTS=F.lit(f"{day}-120000"), SYMBOL=F.concat(F.lit("S"), text("p_partkey")),
            ISSUE_TYPE=F.lit("COMMON"), STATUS=F.lit(status), NAME=F.col("p_name"), EX_ID=F.lit("NYSE"),
            SH_OUT=text(F.col("p_size") * 1000), FIRST_TRADE_DATE=F.lit("19900101"),
            FIRST_TRADE_EXCHANGE=F.lit("19900102"), DIVIDEN=text(F.col("p_size") + 0.25),
            COMPANY_NAME_OR_CIK=ref,
        )

    first = parts.select(security("19940701", "ACTV").alias("line"))
    later = parts.where("p_size > 25").select(security("19980101", "INAC").alias("line"))
    return first.unionByName(later)


def _financials(orders: DataFrame) -> DataFrame:
    """Some earnings per share are not numbers."""
    day, key, price = F.col("o_orderdate"), F.col("o_orderkey"), F.col("o_totalprice")
    return orders.where("o_orderstatus = 'O'").select(
        _record(
            "FIN", PTS=F.date_format(day, "yyyyMMdd-HHmmss"), YEAR=text(F.year(day)), QUARTER=text(F.quarter(day)),
            QTR_START_DATE=F.date_format(F.trunc(day, "quarter"), "yyyyMMdd"),
            POSTING_DATE=F.date_format(day, "yyyyMMdd"), REVENUE=text(money(price)), EARNINGS=text(F.floor(price)),
            EPS=F.when(key % 7 == 0, "n/a").otherwise(text(key % 100)), DILUTED_EPS=text(key % 90), MARGIN=F.lit("0.25"),
            INVENTORY=text(key), ASSETS=text(key * 2), LIABILITIES=text(key * 3), SH_OUT=text(key), DILUTED_SH_OUT=text(key + 1),
            CO_NAME_OR_CIK=_padded("o_custkey", 10),
        ).alias("line")
    )


def _trades(orders: DataFrame) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return orders.select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").alias("day"),
        F.when(status == "F", "CMPT").when(status == "P", "CNCL").otherwise("SBMT").alias("status"),
        F.when(priority == "1-URGENT", "TMB").when(priority == "2-HIGH", "TMS").otherwise("TLB").alias("type"),
        money(F.col("o_totalprice") / 1000).alias("price"),
        (1 + F.col("o_orderkey") % 100).alias("quantity"),
    )


def _history(trades: DataFrame) -> DataFrame:
    def step(name: str, hours: int) -> Column:
        at = F.expr(f"timestampadd(HOUR, {hours}, day)")
        return F.struct(at.alias("at"), F.lit(name).alias("step"))

    status = F.col("status")
    steps = F.array(
        F.when(F.col("type") == "TLB", step("PNDG", 9)),
        step("SBMT", 10),
        F.when(status.isin("CMPT", "CNCL"), F.struct(F.expr("timestampadd(HOUR, 40, day)").alias("at"), status.alias("step"))),
    )
    return trades.select("o_orderkey", F.explode(F.array_compact(steps)).alias("s")).select("o_orderkey", "s.at", "s.step")


def write_batch(spark: SparkSession, tables: str, folder: str) -> None:
    """Write the files of one batch under ``folder``, each as a folder of part files."""
    customers, orders = table(spark, tables, "customer"), table(spark, tables, "orders")
    parts, suppliers = table(spark, tables, "part"), table(spark, tables, "supplier")
    lines, nations = table(spark, tables, "lineitem"), table(spark, tables, "nation")
    events = events_with_k(spark, tables)
    n_customers = customers.count()
    regions = table(spark, tables, "region")
    trades = _trades(orders)
    last_day = events.agg(F.to_date(F.max("ts"))).scalar()
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit("1994-01-01")), last_day)).alias("day")
    )
    second = F.col("id")
    status_rows = spark.createDataFrame(STATUS_TYPES, "a string, b string")
    type_rows = spark.createDataFrame(TRADE_TYPES, "a string, b string, c string, d string")
    nation_id = _padded("n_nationkey", 2)
    price = money("l_extendedprice")
    amounts = lines.select("l_orderkey", "l_shipdate", F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("amount"))
    cash = amounts.join(orders.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    kind = F.col("event_type")
    symbol_of_order = F.concat(F.lit("S"), text("o_custkey"))
    files = {
        "BatchDate.txt": orders.agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("line")),
        "Date.txt": days.select(
            _lines(
                F.date_format("day", "yyyyMMdd"), "day", F.lit("d"), F.year("day"), F.lit("y"), F.quarter("day"),
                F.lit("q"), F.month("day"), F.lit("m"), F.weekofyear("day"), F.lit("w"), F.dayofweek("day"),
                F.lit("n"), F.year("day"), F.lit("f"), F.quarter("day"), F.lit("f"), F.lit("false"),
            ).alias("line")
        ),
        "Time.txt": spark.range(24 * 60 * 60).select(
            _lines(
                second, clock_text(second), F.floor(second / 3600), F.lit("h"), F.floor(second / 60) % 60, F.lit("m"),
                second % 60, F.lit("s"), F.lit("true"), F.lit("1"),
            ).alias("line")
        ),
        "Industry.txt": nations.join(regions, F.col("r_regionkey") == F.col("n_regionkey")).select(
            _lines(nation_id, "n_name", F.left("r_name", F.lit(4))).alias("line")
        ),
        "StatusType.txt": status_rows.select(_lines("a", "b").alias("line")),
        "TradeType.txt": type_rows.select(_lines("a", "b", "c", "d").alias("line")),
        "TaxRate.txt": nations.select(
            _lines(F.concat(F.lit("N"), nation_id), "n_name", F.concat(F.lit("0."), nation_id)).alias("line")
        ),
        "HR.csv": suppliers.select(
            _lines(
                "s_suppkey", "s_nationkey", "s_name", F.lit("Smith"), F.lit("M"),
                F.when(F.col("s_suppkey") % 3 != 0, 314).otherwise(310), F.lit("B"), F.lit("O"), F.lit("5"), sep=",",
            ).alias("line")
        ),
        "Prospect.csv": customers.select(
            _lines(
                F.concat(F.lit("AG"), text("c_custkey")), F.lower("c_mktsegment"), "c_name", F.lit(""), F.lit("M"),
                F.concat(F.lit("Street "), text("c_nationkey")), F.lit(""), "c_custkey", F.lit("City"), F.lit("ST"),
                F.lit("US"), F.lit("5"), F.col("c_custkey") * 1000, F.col("c_custkey") % 5, F.col("c_custkey") % 6,
                F.lit("M"), 18 + F.col("c_custkey") % 60, 450 + F.col("c_custkey") % 400, F.lit("O"), F.lit(r"Co\, Ltd"),
                F.col("c_custkey") % 10, F.floor(F.col("c_acctbal") * 200), sep=",",
            ).alias("line")
        ),
        "CustomerMgmt.xml": _actions(customers, orders, n_customers),
        "FINWIRE1994Q1": _companies(customers, orders)
        .unionByName(_securities(parts, n_customers)).unionByName(_financials(orders))
        .unionByName(nations.select(F.concat(F.rpad(F.lit(""), 15, " "), F.lit("XYZ"), "n_name").alias("line"))),
        "Trade.txt": trades.select(
            _lines(
                "o_orderkey", "day", "status", "type", F.lit("1"), symbol_of_order, "quantity", F.col("quantity") + 0.5, "o_custkey",
                F.lit("Exec"), F.when(F.col("status") == "CMPT", F.col("price")), F.lit("1.50"), F.lit("2.25"),
                F.lit("0.75"),
            ).alias("line")
        ),
        "TradeHistory.txt": _history(trades).select(_lines("o_orderkey", "at", "step").alias("line")),
        "HoldingHistory.txt": trades.select(
            _lines(
                F.col("o_orderkey") - F.col("o_orderkey") % 10, "o_orderkey", F.lit(0), "quantity"
            ).alias("line")
        ),
        "CashTransaction.txt": cash.select(
            _lines("o_custkey", "l_shipdate", "amount", F.lit(r"cash\|in")).alias("line")
        ),
        "DailyMarket.txt": lines.select(
            _lines(
                F.to_date("l_shipdate"), F.concat(F.lit("S"), text("l_partkey")), price, price, price,
                F.when(F.col("l_linenumber") == 7, "n/a").otherwise(text(F.col("l_quantity").cast("bigint"))),
            ).alias("line")
        ),
        "WatchHistory.txt": events.where(kind.isin("view", "error")).select(
            _lines(
                "user_id", F.concat(F.lit("S"), text("k")), "ts", F.when(kind == "view", "ACTV").otherwise("CNCL")
            ).alias("line")
        ),
    }
    for name, rows in files.items():
        rows.write.options(**PACKED).text(folder + name)
    status = lambda value: F.count_if(F.col("o_orderstatus") == value)
    priority, dear = F.col("o_orderpriority"), F.col("o_totalprice") > 400_000
    views, errors = F.count_if(kind == "view"), F.count_if(kind.isin("view", "error"))
    rows = F.count(F.lit(1))
    # Counted apart from the files; the last one counts what no load counts.
    counts = [
        (suppliers, "DimBroker", "HR_BROKERS", F.count_if(F.col("s_suppkey") % 3 != 0)),
        (customers, "Prospect", "P_RECORDS", rows),
        (lines, "FactCashBalances", "CT_RECORDS", rows),
        (lines, "FactMarketHistory", "DM_RECORDS", rows),
        (events, "FactWatches", "WH_RECORDS", errors),
        (events, "FactWatches", "WH_ACTIVE", views),
        (orders, "FactHoldings", "HH_RECORDS", rows),
        (orders, "DimTrade", "T_Records", rows),
        (orders, "DimTrade", "T_CanceledTrades", status("P")),
        (orders, "Financial", "FW_FIN", status("O")),
        (parts, "DimSecurity", "FW_SEC", rows + F.count_if(F.col("p_size") > 25)),
        (orders, "DimCompany", "FW_CMP", F.lit(n_customers) + status("F")),
        (customers, "DimCustomer", "C_NEW", rows),
        (orders, "DimCustomer", "C_UPDCUST", status("P")),
        (orders, "DimCustomer", "C_INACT", F.count_if((F.col("o_orderstatus") == "F") & (priority == "5-LOW") & dear)),
        (orders, "DimAccount", "CA_UPDACCT", F.count_if((F.col("o_orderstatus") == "O") & (priority == "1-URGENT"))),
        (orders, "DimAccount", "CA_CLOSEACCT", F.count_if((F.col("o_orderstatus") == "O") & (priority == "5-LOW") & dear)),
        (customers, "DimTrade", "T_InvalidCharge", F.lit(0)),
    ]
    audit = [
        df.groupBy().agg(n.alias("Value")).select(
            F.lit(data_set).alias("DataSet"), F.lit(1).alias("BatchID"), F.lit(None).cast("date").alias("Date"),
            F.lit(attribute).alias("Attribute"), F.col("Value").cast("bigint").alias("Value"), F.lit(None).cast("int").alias("DValue"),
        )
        for df, data_set, attribute, n in counts
    ]
    reduce(DataFrame.unionByName, audit).write.option("header", True).csv(folder + "Batch_audit.csv")
