"""The whole load on a tiny raw batch."""

import datetime as dt
from decimal import Decimal

import pytest
import raw_batch
from pyspark.sql import functions as F

from ledgerloom.plans import load
from ledgerloom.plans.dimensions import customer_cascade, flag_customers
from ledgerloom.plans.facts import cash_totals
from ledgerloom.sources import readers
from ledgerloom.sources import schemas as layouts


def day(text):
    return dt.date.fromisoformat(text)


OPEN = day("9999-12-31")


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    raw = raw_batch.write_batch(root / "raw")
    at = F.lit("2020-01-01 00:00:00").cast("timestamp")
    store, seconds = load.run(spark, raw, 1, str(root / "out"), message_time=at)
    assert list(seconds)[3:-1] == list(load.STEPS)
    store.raw = raw
    return store


def got(store, name, *columns, by=None):
    rows = store.table(name).select(*columns).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: str(r))


def messages(store, text):
    rows = store.table("DImessages").where(F.col("MessageText") == text)
    return sorted((r.MessageSource, r.MessageData) for r in rows.collect())


def test_tables_have_their_declared_layout(store):
    for name, columns in layouts.TARGETS.items():
        want = [(f.name, f.dataType) for f in layouts_schema(columns)]
        assert [(f.name, f.dataType) for f in store.table(name).schema] == want, name


def layouts_schema(columns):
    from ledgerloom.sinks import layout

    return layout(columns)


def test_reference_tables(store):
    assert store.table("batch_date").collect()[0].batch_date == day(raw_batch.BATCH_DATE)
    assert store.table("DimTime").count() == 86_400
    flags = store.table("DimDate").where("HolidayFlag").count()
    assert flags == 8
    assert got(store, "Audit", "DataSet", "AT_Value") == [
        ("DimBroker", Decimal(2)), ("DimCompany", Decimal(3)), ("DimTrade", Decimal(4)),
    ]


def test_fixed_width_staging_keeps_every_row(store):
    assert store.table("S_Financial").count() == 152
    assert store.table("S_Company").where(F.col("CEO_NAME") == "Pat O'Neil").count() == 5
    bad = store.table("S_Company").where("invalid_text").collect()
    assert [(r.CIK, r.STATUS, r.INDUSTRY_ID, r.CITY) for r in bad] == [("0000000014", "ACTV", "AA", "Town")]
    assert messages(store, "Invalid bytes in line") == [("S_Company", "20090101-120000")]


def test_staged_prices_keep_their_cents(store):
    prices = got(store, "S_Trade", "T_ID", "T_BID_PRICE", "T_TRADE_PRICE", "T_IS_CASH")
    assert prices[0] == (1, Decimal("12.55"), Decimal("12.60"), True)
    assert prices[1] == (2, Decimal("5.00"), None, False)


def test_broker(store):
    assert got(store, "DimBroker", "SK_BrokerID", "BrokerID", "MiddleInitial", "EffectiveDate", "EndDate") == [
        (1, 7, "M", day("2010-01-01"), OPEN), (2, 8, None, day("2010-01-01"), OPEN),
    ]


def test_company_versions(store):
    assert got(store, "DimCompany", "CompanyID", "EffectiveDate", "EndDate", "IsCurrent", "isLowGrade") == [
        (11, day("2009-01-01"), day("2012-01-01"), False, False),
        (11, day("2012-01-01"), OPEN, True, True),
        (12, day("2009-01-01"), OPEN, True, True),
        (14, day("2009-01-01"), OPEN, True, False),
    ]


def test_security_finds_its_company_by_number_and_by_name(store):
    assert got(store, "DimSecurity", "Symbol", "EffectiveDate", "SK_CompanyID", "Status", "SharesOutstanding") == [
        ("SYA", day("2009-06-01"), 1, "Active", 12345678901),
        ("SYA", day("2012-06-01"), 2, "Inactive", 12345678901),
        ("SYB", day("2009-06-01"), 3, "Active", 12345678901),
    ]
    by_company = {r.SK_CompanyID: r["count"] for r in store.table("Financial").groupBy("SK_CompanyID").count().collect()}
    assert by_company == {1: 151, 2: 1}


def test_prospect(store):
    rows = got(store, "Prospect", "AgencyID", "SK_RecordDateID", "MarketingNameplate")
    assert rows == [
        ("AG0", 20170707, "MoneyAlert"),
        ("AG1", 20170707, "HighValue+Expenses+Boomer+Inherited"),
        ("AG2", 20170707, "Expenses+MoneyAlert+Spender"),
    ]


def test_customer_replay(store):
    rows = got(
        store, "DimCustomer", "CustomerID", "EffectiveDate", "EndDate", "Status", "Tier", "AddressLine2",
        "Phone1", "Phone2", "Email1", "Email2", "IsCurrent",
    )
    assert rows == [
        (1, day("2010-01-01"), day("2012-06-01"), "ACTIVE", 1, "Flat 2", "+1 (212) 555-19", "(313) 555-2", "a@x", "b@x", False),
        # Two changes on one day are one version; an empty element clears, an absent one does not.
        (1, day("2012-06-01"), day("2014-01-01"), "ACTIVE", 2, None, "777", "(313) 555-2", "a@x", None, False),
        (1, day("2014-01-01"), day("2015-01-01"), "INACTIVE", 2, None, "777", "(313) 555-2", "a@x", None, False),
        (1, day("2015-01-01"), OPEN, "INACTIVE", 2, None, "777", "(313) 555-2", "new@x", None, True),
        (2, day("2010-01-02"), OPEN, "ACTIVE", 4, None, None, None, None, None, True),
        (3, day("2015-05-01"), OPEN, "ACTIVE", None, None, None, None, None, None, True),
    ]


def test_customer_enrichment(store):
    rows = got(
        store, "DimCustomer", "CustomerID", "IsCurrent", "PostalCode", "Gender", "NationalTaxRateDesc",
        "LocalTaxRate", "AgencyID", "MarketingNameplate",
    )
    # Only the current version is enriched; of two prospects with one key the lowest agency is taken.
    assert (1, True, "11111", "F", "National one", Decimal("0.05000"), "AG0", None) in rows
    assert (1, False, "11111", "F", "National one", Decimal("0.05000"), None, None) in rows
    # An unknown tax code leaves name and rate empty; zero income counts as missing here.
    assert (2, True, "22222", "U", None, None, "AG2", "Expenses+MoneyAlert+Spender") in rows


def test_customer_messages(store):
    assert messages(store, "Invalid customer tier") == [("DimCustomer", "C_ID = 2, C_TIER = 4")]
    assert messages(store, "DOB out of range") == [
        ("DimCustomer", "C_ID = 2, C_DOB = 1910-01-01"), ("DimCustomer", "C_ID = 3, C_DOB = 2030-01-01"),
    ]
    assert messages(store, "Customer not opened by NEW") == [("DimCustomer", "C_ID = 3, first action = UPDCUST")]


def test_account_replay_and_cascade(store):
    rows = got(
        store, "DimAccount", "AccountID", "EffectiveDate", "EndDate", "Status", "SK_CustomerID", "SK_BrokerID",
        "AccountDesc", "IsCurrent",
    )
    assert rows == sorted([
        (101, day("2010-01-01"), day("2012-06-01"), "ACTIVE", 0, 1, "First", False),
        (101, day("2012-06-01"), day("2012-07-01"), "ACTIVE", 1, 1, "First", False),
        (101, day("2012-07-01"), day("2014-01-01"), "ACTIVE", 1, 1, "Renamed", False),
        (101, day("2014-01-01"), OPEN, "INACTIVE", 2, 1, "Renamed", True),
        # The second account of one action; closed before its customer is.
        (102, day("2010-01-01"), day("2012-06-01"), "ACTIVE", 0, 2, "Second", False),
        (102, day("2012-06-01"), day("2013-01-01"), "ACTIVE", 1, 2, "Second", False),
        (102, day("2013-01-01"), OPEN, "INACTIVE", 1, 2, "Second", True),
        # An unknown broker.
        (103, day("2011-03-01"), day("2012-06-01"), "ACTIVE", 0, -1, "Extra", False),
        (103, day("2012-06-01"), day("2014-01-01"), "ACTIVE", 1, -1, "Extra", False),
        (103, day("2014-01-01"), OPEN, "INACTIVE", 2, -1, "Extra", True),
        (201, day("2010-01-02"), OPEN, "ACTIVE", 4, 1, "Third", True),
    ], key=str)
    assert len(messages(store, "Invalid tax status")) == 3


def test_trades(store):
    rows = got(
        store, "DimTrade", "TradeID", "SK_CreateDateID", "SK_CreateTimeID", "SK_CloseDateID", "SK_CloseTimeID",
        "Status", "SK_SecurityID", "SK_AccountID", "SK_CustomerID",
    )
    assert rows == [
        (1, 20110501, 36000, 20110501, 36005, "Completed", 1, 0, 0),
        (2, 20110601, 32400, 20110603, 36000, "Canceled", 3, 10, 4),
        (3, 20130601, 36000, 20130601, 36030, "Completed", 2, 2, 1),
        (4, 20110701, 36000, None, None, "Submitted", None, None, None),
    ]


def test_facts(store):
    assert got(store, "FactCashBalances", "SK_AccountID", "SK_DateID", "Cash") == [
        (10, 20120102, Decimal("5.00")), (3, 20120101, Decimal("80.25")), (3, 20120105, Decimal("90.25")),
    ]
    totals = cash_totals(store.table("S_Cash_Balances")).where("AccountID = 101").collect()
    assert [(r.first_day, r.Cash) for r in totals] == [(day("2012-01-01"), Decimal("90.25"))]
    assert got(store, "FactHoldings", "TradeID", "CurrentTradeID", "SK_TimeID", "CurrentPrice", "CurrentHolding") == [
        (1, 1, 36005, Decimal("13.05"), 60),
    ]
    # Seen twice as active is not a removal.
    assert got(store, "FactWatches", "SK_CustomerID", "SK_SecurityID", "SK_DateID_DatePlaced", "SK_DateID_DateRemoved") == [
        (0, 1, 20110101, 20110201), (4, 3, 20110101, None),
    ]


def test_every_load_reports_its_rows_and_keys_hold(store):
    status = dict(messages(store, "Inserted rows"))
    for name in load.STEPS:
        assert int(status[name]) == store.table(name).count()
    assert messages(store, "Duplicate key") == [] and messages(store, "Null in key") == []


def test_prospects_that_are_customers(store):
    flagged = flag_customers(store.table("Prospect"), store.table("DimCustomer"))
    assert {r.AgencyID: r.IsCustomer for r in flagged.collect()} == {"AG0": True, "AG1": True, "AG2": True}
    ended = store.table("DimCustomer").where("CustomerID <> 2")
    flagged = flag_customers(store.table("Prospect"), ended)
    assert {r.AgencyID: r.IsCustomer for r in flagged.collect()}["AG2"] is False


def test_account_opened_on_the_day_its_customer_goes(spark):
    own = spark.createDataFrame(
        [(1, day("2020-01-05"), 7, "ACTIVE"), (2, day("2020-01-01"), 7, "ACTIVE"), (3, day("2020-01-06"), 7, "ACTIVE")],
        "AccountID int, EffectiveDate date, CustomerID int, Status string",
    )
    customers = spark.createDataFrame(
        [(7, day("2020-01-01"), "ACTIVE"), (7, day("2020-01-03"), "ACTIVE"), (7, day("2020-01-05"), "INACTIVE"), (7, day("2020-01-09"), "INACTIVE")],
        "CustomerID int, EffectiveDate date, Status string",
    )
    got = sorted((tuple(r) for r in customer_cascade(own, customers).collect()), key=str)
    assert got == [
        (1, day("2020-01-05"), "INACTIVE"), (2, day("2020-01-03"), None), (2, day("2020-01-05"), "INACTIVE"),
    ]


def test_audit_is_compared(spark, store):
    actual = spark.createDataFrame(
        [("DimBroker", "HR_BROKERS", Decimal(2)), ("DimCompany", "FW_CMP", Decimal(5))],
        "data_set string, attribute string, value decimal(15, 5)",
    )
    found = {r.data_set: (r.actual, r.matches) for r in load.audit_differences(store, actual).collect()}
    assert found == {"DimBroker": (2, True), "DimCompany": (5, False), "DimTrade": (None, False)}


def test_both_xml_readers_agree(spark, store):
    path = readers.batch_path(store.raw, 1, 1, "CustomerMgmt.xml")
    whole = readers.read_xml_rows(spark, path, layouts.ACTION_TAG, layouts.ACTION).collect()
    split = readers.read_xml_records(spark, path, layouts.ACTION_TAG, layouts.ACTION).collect()
    assert len(whole) == 10 and whole == split


def test_xml_is_split_between_tasks(spark, store):
    path = readers.batch_path(store.raw, 1, 1, "CustomerMgmt.xml")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        rows = readers.read_xml_records(spark, path, layouts.ACTION_TAG, layouts.ACTION, order="seq")
        assert rows.rdd.getNumPartitions() > 2
        ordered = [r._ActionTS for r in rows.orderBy("seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == sorted(ordered) and len(ordered) == 10
