"""The full load over a raw batch derived from the tables, one query per target table.

The batch is written and loaded once per session and folder; each query reads one target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.batch_files import write_batch
from ledgerloom.catalog.inputs import text
from ledgerloom.catalog.registry import query
from ledgerloom.plans import load, staging
from ledgerloom.plans.store import Store
from ledgerloom.session import counted_broadcasts, scratch_path
from ledgerloom.sources.readers import batch_path

_LOADED: dict[tuple[str, str], tuple[Store, dict[str, float]]] = {}


def loaded(spark: SparkSession, folder: str) -> tuple[Store, dict[str, float]]:
    """The store of this session's load of ``folder`` and the seconds of each step."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _LOADED:
        root = scratch_path(spark, "warehouse")
        with counted_broadcasts(spark):
            write_batch(spark, folder, batch_path(f"{root}/raw", 1, 1))
        _LOADED[key] = load.run(spark, f"{root}/raw", 1, f"{root}/tables")
    return _LOADED[key]


def _target(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return loaded(spark, folder)[0].table(name)


# --- the target tables as SQL over the same tables -----------------------------------------------

_BROKER = """
SELECT row_number() OVER (ORDER BY s_suppkey) AS sk, s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey % 3 <> 0
"""
_COMPANY = """
SELECT row_number() OVER (ORDER BY id, eff) AS sk, id, eff, name, industry, rating,
       lead(eff) OVER (PARTITION BY id ORDER BY eff) AS nxt
FROM (SELECT id, eff, name, industry, rating,
             row_number() OVER (PARTITION BY id, eff ORDER BY sec DESC) AS back
      FROM (SELECT c_custkey AS id, DATE '1994-01-01' AS eff, 0 AS sec, c_name AS name, n_name AS industry, 'A' AS rating
            FROM customer JOIN nation ON n_nationkey = c_nationkey
            UNION ALL
            SELECT c_custkey, CAST(o_orderdate AS DATE), o_orderkey % 86400, c_name, n_name,
                   CASE o_orderkey % 4 WHEN 0 THEN 'AA' WHEN 1 THEN 'BBB' WHEN 2 THEN 'BB' END
            FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
            WHERE o_orderstatus = 'F'))
WHERE back = 1
"""
_SECURITY = f"""
SELECT row_number() OVER (ORDER BY symbol, s.eff) AS sk, symbol, s.eff, p_partkey, status, shares, c.sk AS company_sk,
       lead(s.eff) OVER (PARTITION BY symbol ORDER BY s.eff) AS nxt
FROM (SELECT 'S' || p_partkey AS symbol, DATE '1994-07-01' AS eff, 'Active' AS status, p_size * 1000 AS shares, p_partkey % ((SELECT count(*) FROM customer) + 3) AS company, p_partkey FROM part
      UNION ALL
      SELECT 'S' || p_partkey, DATE '1998-01-01', 'Inactive', p_size * 1000, p_partkey % ((SELECT count(*) FROM customer) + 3), p_partkey FROM part WHERE p_size > 25) s
JOIN ({_COMPANY}) c ON c.id = company AND c.eff <= s.eff AND (c.nxt IS NULL OR s.eff < c.nxt)
"""
_CUSTOMER = """
SELECT row_number() OVER (ORDER BY id, eff) - 1 AS sk, id, eff, lead(eff) OVER (PARTITION BY id ORDER BY eff) AS nxt,
       last_value(tier IGNORE NULLS) OVER so_far AS tier,
       nullif(last_value(email IGNORE NULLS) OVER so_far, '') AS email,
       last_value(status IGNORE NULLS) OVER so_far AS status
FROM (SELECT id, CAST(moment AS DATE) AS eff, arg_max(tier, moment) AS tier, arg_max(email, moment) AS email, arg_max(status, moment) AS status
      FROM (SELECT c_custkey AS id, TIMESTAMP '1994-06-01 08:00:00' AS moment, CAST(1 + c_custkey % 3 AS VARCHAR) AS tier,
                   'c' || c_custkey || '@x' AS email, 'ACTIVE' AS status FROM customer
            UNION ALL
            SELECT o_custkey, o_orderdate + to_microseconds(o_orderkey), CAST(o_orderkey % 5 AS VARCHAR),
                   CASE o_orderkey % 3 WHEN 1 THEN '' WHEN 2 THEN 'o' || o_orderkey || '@x' END, NULL
            FROM orders WHERE o_orderstatus = 'P'
            UNION ALL
            SELECT o_custkey, o_orderdate + to_microseconds(o_orderkey), NULL, NULL, 'INACTIVE'
            FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW' AND o_totalprice > 400000)
      GROUP BY id, CAST(moment AS DATE))
WINDOW so_far AS (PARTITION BY id ORDER BY eff ROWS UNBOUNDED PRECEDING)
"""
_ACCOUNT = f"""
SELECT row_number() OVER (ORDER BY v.id, v.eff) - 1 AS sk, v.id, v.eff, v.nxt, v.name, v.status, c.sk AS customer_sk,
       coalesce(b.sk, -1) AS broker_sk
FROM (WITH customers AS MATERIALIZED ({_CUSTOMER}),
      own AS (
          SELECT id, CAST(moment AS DATE) AS eff, arg_max(name, moment) AS name, arg_max(status, moment) AS status
          FROM (SELECT c_custkey AS id, TIMESTAMP '1994-06-01 08:00:00' AS moment, 'Account ' || c_custkey AS name, 'ACTIVE' AS status FROM customer
                UNION ALL
                SELECT o_custkey, o_orderdate + to_microseconds(o_orderkey), 'Renamed ' || o_orderkey, NULL
                FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
                UNION ALL
                SELECT o_custkey, o_orderdate + to_microseconds(o_orderkey), NULL, 'INACTIVE'
                FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW' AND o_totalprice > 400000)
          GROUP BY id, CAST(moment AS DATE)),
      lives AS (SELECT id, min(eff) AS opened, min(CASE WHEN status = 'INACTIVE' THEN eff END) AS closed FROM own GROUP BY id),
      gone AS (SELECT id, min(eff) AS gone FROM customers WHERE status = 'INACTIVE' GROUP BY id),
      inherited AS (
          SELECT l.id, c.eff, CASE WHEN c.status = 'INACTIVE' THEN 'INACTIVE' END AS status
          FROM lives l JOIN customers c ON c.id = l.id LEFT JOIN gone g ON g.id = l.id
          WHERE c.eff > opened AND (closed IS NULL OR c.eff < closed) AND (gone IS NULL OR c.eff <= gone)),
      days AS (
          SELECT id, eff, max(name) AS name, coalesce(max(passed), max(status)) AS status
          FROM (SELECT id, eff, name, status, NULL AS passed FROM own
                UNION ALL SELECT id, eff, NULL, NULL, status FROM inherited)
          GROUP BY id, eff)
      SELECT id, eff, lead(eff) OVER (PARTITION BY id ORDER BY eff) AS nxt,
             last_value(name IGNORE NULLS) OVER so_far AS name, last_value(status IGNORE NULLS) OVER so_far AS status
      FROM days WINDOW so_far AS (PARTITION BY id ORDER BY eff ROWS UNBOUNDED PRECEDING)) v
LEFT JOIN ({_CUSTOMER}) c ON c.id = v.id AND c.eff <= v.eff AND (c.nxt IS NULL OR v.eff < c.nxt)
LEFT JOIN ({_BROKER}) b ON b.id = v.id % (SELECT count(*) FROM customer)
"""
_TRADE = f"""
SELECT o_orderkey AS id, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS create_date,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 36000 ELSE 32400 END AS create_time,
       CASE WHEN o_orderstatus <> 'O' THEN CAST(strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d') AS BIGINT) END AS close_date,
       CASE WHEN o_orderstatus <> 'O' THEN 57600 END AS close_time,
       CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Canceled' ELSE 'Submitted' END AS status,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Market Buy' WHEN '2-HIGH' THEN 'Market Sell' ELSE 'Limit Buy' END AS type,
       s.sk AS security_sk, s.company_sk, a.sk AS account_sk, a.customer_sk, a.broker_sk,
       CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice / 1000 AS DECIMAL(18, 2)) AS DOUBLE) END AS price,
       1.5::DOUBLE + o_orderkey % 100 AS bid, 1 + o_orderkey % 100 AS quantity
FROM orders
LEFT JOIN ({_SECURITY}) s ON s.symbol = 'S' || o_custkey AND s.eff <= o_orderdate AND (s.nxt IS NULL OR o_orderdate < s.nxt)
LEFT JOIN ({_ACCOUNT}) a ON a.id = o_custkey AND a.eff <= o_orderdate AND (a.nxt IS NULL OR o_orderdate < a.nxt)
"""
_SPAN = """nxt IS NULL AS "IsCurrent", 1 AS "BatchID", CAST(eff AS VARCHAR) AS "EffectiveDate",
       CAST(coalesce(nxt, DATE '9999-12-31') AS VARCHAR) AS "EndDate" """
_NUMBER = "CAST(CAST({} AS DECIMAL(18, 2)) AS DOUBLE)"


def _whole(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """All columns of a target; dates as text and decimals as doubles for the comparison."""
    df = _target(spark, folder, name)
    plain = {"date": "string", "decimal": "double"}
    return df.select(*[F.col(f.name).cast(plain.get(f.dataType.typeName(), f.dataType)).alias(f.name) for f in df.schema])


@query(f"""
SELECT sk AS "SK_BrokerID", id AS "BrokerID", s_nationkey AS "ManagerID", name AS "FirstName", 'Smith' AS "LastName", 'M' AS "MiddleInitial",
       'B' AS "Branch", 'O' AS "Office", '5' AS "Phone", TRUE AS "IsCurrent", 1 AS "BatchID", '1994-01-01' AS "EffectiveDate", '9999-12-31' AS "EndDate"
FROM ({_BROKER}) JOIN supplier ON s_suppkey = id
""")
def load_dim_broker(spark: SparkSession, folder: str) -> DataFrame:
    return _whole(spark, folder, "DimBroker")


@query(f"""
SELECT sk AS "SK_CompanyID", id AS "CompanyID", 'Active' AS "Status", name AS "Name", industry AS "Industry", rating AS "SPrating",
       rating IS NULL OR rating NOT IN ('A', 'AA', 'BBB') AS "isLowGrade", CAST(NULL AS VARCHAR) AS "CEO", CAST(NULL AS VARCHAR) AS "AddressLine1",
       CAST(NULL AS VARCHAR) AS "AddressLine2", CAST(NULL AS VARCHAR) AS "PostalCode", CAST(NULL AS VARCHAR) AS "City",
       CAST(NULL AS VARCHAR) AS "StateProv", CAST(NULL AS VARCHAR) AS "Country", c_mktsegment AS "Description", '1950-01-01' AS "FoundingDate", {_SPAN}
FROM ({_COMPANY}) JOIN customer ON c_custkey = id
""")
def load_dim_company(spark: SparkSession, folder: str) -> DataFrame:
    return _whole(spark, folder, "DimCompany")


@query(f"""
SELECT sk AS "SK_SecurityID", symbol AS "Symbol", 'COMMON' AS "Issue", status AS "Status", p_name AS "Name", 'NYSE' AS "ExchangeID",
       company_sk AS "SK_CompanyID", CAST(shares AS BIGINT) AS "SharesOutstanding", '1990-01-01' AS "FirstTrade", '1990-01-02' AS "FirstTradeOnExchange",
       p_size + CAST(0.25 AS DOUBLE) AS "Dividend", {_SPAN}
FROM ({_SECURITY}) s JOIN part USING (p_partkey)
""")
def load_dim_security(spark: SparkSession, folder: str) -> DataFrame:
    return _whole(spark, folder, "DimSecurity")


@query(f"""
SELECT sk AS "SK_CompanyID", CAST(year(o_orderdate) AS INT) AS "FI_YEAR", CAST(quarter(o_orderdate) AS INT) AS "FI_QTR",
       CAST(date_trunc('quarter', o_orderdate) AS DATE)::VARCHAR AS "FI_QTR_START_DATE", {_NUMBER.format("o_totalprice")} AS "FI_REVENUE",
       floor(o_totalprice) AS "FI_NET_EARN", CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 100 AS DOUBLE) END AS "FI_BASIC_EPS",
       CAST(o_orderkey % 90 AS DOUBLE) AS "FI_DILUT_EPS", CAST(0.25 AS DOUBLE) AS "FI_MARGIN", CAST(o_orderkey AS DOUBLE) AS "FI_INVENTORY",
       CAST(o_orderkey * 2 AS DOUBLE) AS "FI_ASSETS", CAST(o_orderkey * 3 AS DOUBLE) AS "FI_LIABILITY", o_orderkey AS "FI_OUT_BASIC",
       o_orderkey + 1 AS "FI_OUT_DILUT"
FROM orders JOIN ({_COMPANY}) c ON c.id = o_custkey AND c.eff <= o_orderdate AND (c.nxt IS NULL OR o_orderdate < c.nxt)
WHERE o_orderstatus = 'O'
""")
def load_financial(spark: SparkSession, folder: str) -> DataFrame:
    return _whole(spark, folder, "Financial")


_WORTH = "CAST(floor(c_acctbal * 200) AS BIGINT)"
_AGE, _RATING = "18 + c_custkey % 60", "450 + c_custkey % 400"


@query(f"""
SELECT 'AG' || c_custkey AS "AgencyID", day AS "SK_RecordDateID", day AS "SK_UpdateDateID", 1 AS "BatchID", FALSE AS "IsCustomer",
       lower(c_mktsegment) AS "LastName", c_name AS "FirstName", CAST(NULL AS VARCHAR) AS "MiddleInitial", 'M' AS "Gender",
       'Street ' || c_nationkey AS "AddressLine1", CAST(NULL AS VARCHAR) AS "AddressLine2", CAST(c_custkey AS VARCHAR) AS "PostalCode",
       'City' AS "City", 'ST' AS "State", 'US' AS "Country", '5' AS "Phone", c_custkey * 1000 AS "Income", CAST(c_custkey % 5 AS INT) AS "NumberCars",
       CAST(c_custkey % 6 AS INT) AS "NumberChildren", 'M' AS "MaritalStatus", CAST({_AGE} AS INT) AS "Age", CAST({_RATING} AS INT) AS "CreditRating",
       'O' AS "OwnOrRentFlag", 'Co, Ltd' AS "Employer", CAST(c_custkey % 10 AS INT) AS "NumberCreditCards", {_WORTH} AS "NetWorth", concat_ws('+',
    CASE WHEN {_WORTH} > 1000000 OR c_custkey > 200 THEN 'HighValue' END,
    CASE WHEN c_custkey % 6 > 3 OR c_custkey % 10 > 5 THEN 'Expenses' END,
    CASE WHEN {_AGE} > 45 THEN 'Boomer' END,
    CASE WHEN c_custkey < 5 OR {_RATING} < 600 OR {_WORTH} < 100000 THEN 'MoneyAlert' END,
    CASE WHEN c_custkey % 5 > 3 OR c_custkey % 10 > 7 THEN 'Spender' END,
    CASE WHEN {_AGE} > 25 OR {_WORTH} > 1000000 THEN 'Inherited' END) AS "MarketingNameplate"
FROM customer, (SELECT CAST(strftime(max(o_orderdate), '%Y%m%d') AS INT) AS day FROM orders)
""")
def load_prospect(spark: SparkSession, folder: str) -> DataFrame:
    return _whole(spark, folder, "Prospect")


@query(f"""
SELECT sk AS "SK_CustomerID", id AS "CustomerID", CAST(NULL AS VARCHAR) AS "TaxID", status AS "Status", c_mktsegment AS "LastName", c_name AS "FirstName",
       CAST(NULL AS VARCHAR) AS "MiddleInitial", CASE WHEN left(c_mktsegment, 1) IN ('F', 'M') THEN left(c_mktsegment, 1) ELSE 'U' END AS "Gender",
       CAST(tier AS INT) AS "Tier", '1970-01-01' AS "DOB", 'Street ' || c_nationkey AS "AddressLine1", CAST(NULL AS VARCHAR) AS "AddressLine2",
       CAST(c_custkey AS VARCHAR) AS "PostalCode", CAST(NULL AS VARCHAR) AS "City", CAST(NULL AS VARCHAR) AS "StateProv", CAST(NULL AS VARCHAR) AS "Country",
       '(' || (100 + c_nationkey) || ') ' || c_custkey AS "Phone1", CAST(NULL AS VARCHAR) AS "Phone2", CAST(NULL AS VARCHAR) AS "Phone3",
       email AS "Email1", CAST(NULL AS VARCHAR) AS "Email2", n_name AS "NationalTaxRateDesc", c_nationkey / 100 AS "NationalTaxRate",
       CAST(NULL AS VARCHAR) AS "LocalTaxRateDesc", CAST(NULL AS DOUBLE) AS "LocalTaxRate", CASE WHEN nxt IS NULL THEN 'AG' || c_custkey END AS "AgencyID",
       CASE WHEN nxt IS NULL THEN CAST({_RATING} AS INT) END AS "CreditRating", CASE WHEN nxt IS NULL THEN {_WORTH} END AS "NetWorth",
       CASE WHEN nxt IS NULL THEN nullif(concat_ws('+',
           CASE WHEN {_WORTH} > 1000000 OR c_custkey > 200 THEN 'HighValue' END,
           CASE WHEN c_custkey % 6 > 3 OR c_custkey % 10 > 5 THEN 'Expenses' END,
           CASE WHEN {_AGE} > 45 THEN 'Boomer' END,
           CASE WHEN (c_custkey < 50 AND c_custkey <> 0) OR {_RATING} < 600 OR ({_WORTH} < 100000 AND {_WORTH} <> 0) THEN 'MoneyAlert' END,
           CASE WHEN c_custkey % 5 > 3 OR c_custkey % 10 > 7 THEN 'Spender' END,
           CASE WHEN {_AGE} < 25 AND {_WORTH} > 1000000 THEN 'Inherited' END), '') END AS "MarketingNameplate", {_SPAN}
FROM ({_CUSTOMER}) JOIN customer ON c_custkey = id JOIN nation ON n_nationkey = c_nationkey
""")
def load_dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return _whole(spark, folder, "DimCustomer")


@query(f"""
SELECT sk AS "SK_AccountID", id AS "AccountID", broker_sk AS "SK_BrokerID", customer_sk AS "SK_CustomerID", status AS "Status", name AS "AccountDesc",
       CAST(id % 4 AS INT) AS "TaxStatus", {_SPAN}
FROM ({_ACCOUNT})
""")
def load_dim_account(spark: SparkSession, folder: str) -> DataFrame:
    return _whole(spark, folder, "DimAccount")


@query(f"""
SELECT id AS "TradeID", broker_sk AS "SK_BrokerID", create_date AS "SK_CreateDateID", CAST(create_time AS BIGINT) AS "SK_CreateTimeID",
       close_date AS "SK_CloseDateID", CAST(close_time AS BIGINT) AS "SK_CloseTimeID", status AS "Status", type AS "Type", TRUE AS "CashFlag",
       security_sk AS "SK_SecurityID", company_sk AS "SK_CompanyID", CAST(quantity AS INT) AS "Quantity", bid AS "BidPrice", customer_sk AS "SK_CustomerID",
       account_sk AS "SK_AccountID", 'Exec' AS "ExecutedBy", price AS "TradePrice", CAST(1.5 AS DOUBLE) AS "Fee", CAST(2.25 AS DOUBLE) AS "Commission",
       CAST(0.75 AS DOUBLE) AS "Tax", 1 AS "BatchID"
FROM ({_TRADE})
""")
def load_dim_trade(spark: SparkSession, folder: str) -> DataFrame:
    return _whole(spark, folder, "DimTrade")


@query(f"""
WITH days AS (
    SELECT o_custkey AS id, CAST(l_shipdate AS DATE) AS day,
           sum(CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18, 2)) ELSE CAST(l_extendedprice AS DECIMAL(18, 2)) END) AS net
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey, CAST(l_shipdate AS DATE))
SELECT a.customer_sk AS "SK_CustomerID", a.sk AS "SK_AccountID", CAST(strftime(day, '%Y%m%d') AS BIGINT) AS "SK_DateID",
       CAST(CAST(sum(net) OVER (PARTITION BY days.id ORDER BY day) AS DECIMAL(18, 2)) AS DOUBLE) AS "Cash", 1 AS "BatchID"
FROM days JOIN ({_ACCOUNT}) a ON a.id = days.id AND a.nxt IS NULL
""")
def load_fact_cash_balances(spark: SparkSession, folder: str) -> DataFrame:
    return _whole(spark, folder, "FactCashBalances")


@query(f"""
WITH t AS MATERIALIZED (SELECT *, id - id % 10 AS holding FROM ({_TRADE})),
     ends AS (SELECT holding, min(id) AS first_id, max(id) AS last_id FROM t GROUP BY holding)
SELECT ends.holding AS "TradeID", first_id AS "CurrentTradeID", f.customer_sk AS "SK_CustomerID", f.account_sk AS "SK_AccountID",
       f.security_sk AS "SK_SecurityID", f.company_sk AS "SK_CompanyID", f.close_date AS "SK_DateID", CAST(f.close_time AS BIGINT) AS "SK_TimeID",
       l.price AS "CurrentPrice", CAST(l.quantity AS INT) AS "CurrentHolding", 1 AS "BatchID"
FROM ends JOIN t f ON f.id = first_id JOIN t l ON l.id = last_id
""")
def load_fact_holdings(spark: SparkSession, folder: str) -> DataFrame:
    return _whole(spark, folder, "FactHoldings")


_WATCHES = f"""
WITH w AS (
    SELECT user_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
           min(CASE WHEN event_type = 'view' THEN ts END) AS placed, max(CASE WHEN event_type = 'view' THEN ts END) AS again,
           max(CASE WHEN event_type = 'error' THEN ts END) AS stopped
    FROM events WHERE event_type IN ('view', 'error') GROUP BY user_id, k)
SELECT user_id, k, placed, CASE WHEN again IS NULL OR stopped >= again THEN stopped END AS removed,
       CAST(coalesce(placed, stopped) AS DATE) AS day, c.sk AS customer_sk, s.sk AS security_sk
FROM w LEFT JOIN ({_CUSTOMER}) c ON c.id = user_id AND c.nxt IS NULL LEFT JOIN ({_SECURITY}) s ON s.symbol = 'S' || k AND s.nxt IS NULL
"""


@query(f"""
SELECT customer_sk AS "SK_CustomerID", security_sk AS "SK_SecurityID", CAST(strftime(placed, '%Y%m%d') AS BIGINT) AS "SK_DateID_DatePlaced",
       CAST(strftime(removed, '%Y%m%d') AS BIGINT) AS "SK_DateID_DateRemoved", 1 AS "BatchID"
FROM ({_WATCHES}) WHERE customer_sk IS NOT NULL AND security_sk IS NOT NULL
""")
def load_fact_watches(spark: SparkSession, folder: str) -> DataFrame:
    return _whole(spark, folder, "FactWatches")


_REJECTS = f"""
SELECT 'S_DailyMarketHistory' AS source, 'Value does not fit' AS message, 'DM_VOL = n/a' AS data FROM lineitem WHERE l_linenumber = 7
UNION ALL
SELECT 'S_FinWire', 'Value does not fit', 'EPS = n/a' FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 7 = 0
UNION ALL
SELECT 'S_FinWire', 'Unknown record type', 'type = XYZ, lines = ' || count(*) FROM nation
UNION ALL
SELECT 'DimSecurity', 'Security without company or status', 'Symbol = S' || p_partkey || ', PTS = ' || day || '-120000, COMPANY_NAME_OR_CIK = ' ||
       CASE WHEN p_partkey % 2 = 0 THEN lpad(CAST(company AS VARCHAR), 10, '0') ELSE 'Customer#' || lpad(CAST(company AS VARCHAR), 9, '0') END
FROM (SELECT p_partkey, p_size, p_partkey % ((SELECT count(*) FROM customer) + 3) AS company FROM part), (VALUES ('19940701', 0), ('19980101', 25)) d(day, above)
WHERE p_size > above AND company >= (SELECT count(*) FROM customer)
UNION ALL
SELECT 'FactWatches', 'Watch without customer or security', 'W_C_ID = ' || user_id || ', W_S_SYMB = S' || k || ', day = ' || day
FROM ({_WATCHES}) WHERE customer_sk IS NULL OR security_sk IS NULL
"""
_REJECT_TEXTS = (
    "Value does not fit", "Unknown record type", "Company without industry or status", "Security without company or status",
    "Financial without company", "Trade without history, status or type", "Balance without account or date", "Holding without trade",
    "Watch without customer or security",
)


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    found = _target(spark, folder, "DImessages")
    return found.select(
        F.col("MessageSource").alias("source"), F.col("MessageText").alias("message"), F.col("MessageData").alias("data"), "MessageType"
    )


@query(f"SELECT source, message, data, count(*) AS times FROM ({_REJECTS}) GROUP BY ALL")
def load_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Values that fit no type, records of no known type, and rows that a lookup did not match."""
    found = _messages(spark, folder).where(F.col("message").isin(*_REJECT_TEXTS))
    return found.groupBy("source", "message", "data").agg(F.count(F.lit(1)).alias("times"))


_AUDIT = """
SELECT 'DimBroker' AS data_set, 'HR_BROKERS' AS attribute, count(*) AS n FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL SELECT 'Prospect', 'P_RECORDS', count(*) FROM customer
UNION ALL SELECT 'FactCashBalances', 'CT_RECORDS', count(*) FROM lineitem
UNION ALL SELECT 'FactMarketHistory', 'DM_RECORDS', count(*) FROM lineitem
UNION ALL SELECT 'FactWatches', 'WH_RECORDS', count(*) FROM events WHERE event_type IN ('view', 'error')
UNION ALL SELECT 'FactWatches', 'WH_ACTIVE', count(*) FROM events WHERE event_type = 'view'
UNION ALL SELECT 'FactHoldings', 'HH_RECORDS', count(*) FROM orders
UNION ALL SELECT 'DimTrade', 'T_Records', count(*) FROM orders
UNION ALL SELECT 'DimTrade', 'T_CanceledTrades', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'Financial', 'FW_FIN', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'DimSecurity', 'FW_SEC', count(*) + count(*) FILTER (p_size > 25) FROM part
UNION ALL SELECT 'DimCompany', 'FW_CMP', (SELECT count(*) FROM customer) + count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'DimCustomer', 'C_NEW', count(*) FROM customer
UNION ALL SELECT 'DimCustomer', 'C_UPDCUST', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'DimCustomer', 'C_INACT', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW' AND o_totalprice > 400000
UNION ALL SELECT 'DimAccount', 'CA_UPDACCT', count(*) FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
UNION ALL SELECT 'DimAccount', 'CA_CLOSEACCT', count(*) FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW' AND o_totalprice > 400000
"""


@query(f"""
SELECT data_set, attribute, CAST(n AS DOUBLE) AS expected, CAST(n AS DOUBLE) AS actual, TRUE AS matches FROM ({_AUDIT})
UNION ALL
SELECT 'DimTrade', 'T_InvalidCharge', 0, NULL, FALSE
""")
def load_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What the audit rows say beside what was counted while the tables were written."""
    found = _target(spark, folder, "AuditResult")
    return found.select("data_set", "attribute", *[F.col(c).cast("double").alias(c) for c in ("expected", "actual")], "matches")


@query(f"""
WITH accounts AS MATERIALIZED ({_ACCOUNT}),
tiers AS (
    SELECT o_custkey AS id, o_orderkey % 5 AS tier FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 5 IN (0, 4)),
kept AS (SELECT source, message, data FROM ({_REJECTS})
    UNION ALL SELECT 'DimCustomer', 'Invalid customer tier', 'C_ID = ' || id || ', C_TIER = ' || tier FROM tiers
    UNION ALL SELECT 'DimAccount', 'Invalid tax status', 'CA_ID = ' || id || ', CA_TAX_ST = ' || id % 4 FROM accounts WHERE id % 4 = 3
    UNION ALL SELECT 'Audit', 'Audit difference', 'DimTrade.T_InvalidCharge: expected 0.00000, found none'),
written AS (
    SELECT 'DimBroker' AS source, count(*) AS n FROM ({_BROKER}) UNION ALL SELECT 'DimCompany', count(*) FROM ({_COMPANY})
    UNION ALL SELECT 'DimSecurity', count(*) FROM ({_SECURITY}) UNION ALL SELECT 'Prospect', count(*) FROM customer
    UNION ALL SELECT 'Financial', count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'DimCustomer', count(*) FROM ({_CUSTOMER}) UNION ALL SELECT 'DimAccount', count(*) FROM accounts
    UNION ALL SELECT 'DimTrade', count(*) FROM orders
    UNION ALL SELECT 'FactCashBalances', count(DISTINCT (o_custkey, CAST(l_shipdate AS DATE))) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    UNION ALL SELECT 'FactHoldings', count(DISTINCT o_orderkey - o_orderkey % 10) FROM orders
    UNION ALL SELECT 'FactWatches', count(*) FROM ({_WATCHES}) WHERE customer_sk IS NOT NULL AND security_sk IS NOT NULL)
SELECT 'Alert' AS kind, source, message, data, count(*) AS times FROM kept GROUP BY ALL
UNION ALL
SELECT 'Status', source, 'Inserted rows', CAST(n AS VARCHAR), 1 FROM written
""")
def load_messages(spark: SparkSession, folder: str) -> DataFrame:
    """All messages of the load but for their time."""
    found = _messages(spark, folder).withColumnRenamed("MessageType", "kind")
    return found.groupBy("kind", "source", "message", "data").agg(F.count(F.lit(1)).alias("times"))


@query("""
SELECT o_orderkey AS trade, CAST(moment AS VARCHAR) AS moment, step, 1.5::DOUBLE + o_orderkey % 100 AS bid, 'S' || o_custkey AS symbol, o_custkey AS account
FROM (SELECT *, o_orderdate + INTERVAL 9 HOUR AS moment, 'PNDG' AS step FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
      UNION ALL SELECT *, o_orderdate + INTERVAL 10 HOUR, 'SBMT' FROM orders
      UNION ALL SELECT *, o_orderdate + INTERVAL 40 HOUR, CASE o_orderstatus WHEN 'F' THEN 'CMPT' ELSE 'CNCL' END FROM orders WHERE o_orderstatus <> 'O')
""")
def load_trade_joined(spark: SparkSession, folder: str) -> DataFrame:
    """The steps of each trade with the trade."""
    joined = staging.trade_joined(loaded(spark, folder)[0])
    return joined.select(
        F.col("TH_T_ID").alias("trade"), text("TH_DTS").alias("moment"), F.col("TH_ST_ID").alias("step"),
        F.col("T_BID_PRICE").cast("double").alias("bid"), F.col("T_S_SYMB").alias("symbol"), F.col("T_CA_ID").alias("account"),
    )


@query(f"""
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, 'S' || l_partkey AS symbol, {_NUMBER.format("l_extendedprice")} AS close,
       {_NUMBER.format("l_extendedprice")} AS high, {_NUMBER.format("l_extendedprice")} AS low,
       CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) END AS volume
FROM lineitem
""")
def load_daily_market(spark: SparkSession, folder: str) -> DataFrame:
    """The staged market rows."""
    return _target(spark, folder, "S_DailyMarketHistory").select(
        text("DM_DATE").alias("day"), F.col("DM_S_SYMB").alias("symbol"), F.col("DM_CLOSE").cast("double").alias("close"),
        F.col("DM_HIGH").cast("double").alias("high"), F.col("DM_LOW").cast("double").alias("low"), F.col("DM_VOL").alias("volume"),
    )


TARGET_QUERIES = (
    "load_dim_broker", "load_dim_company", "load_dim_security", "load_financial", "load_prospect", "load_dim_customer",
    "load_dim_account", "load_dim_trade", "load_fact_cash_balances", "load_fact_holdings", "load_fact_watches",
    "load_messages", "load_rejects", "load_audit", "load_trade_joined", "load_daily_market",
)
