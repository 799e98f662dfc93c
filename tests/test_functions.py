"""Column rules on hand-made values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import cleanse
from ledgerloom.functions.rules import ENRICHMENT_RULES, PROSPECT_RULES, nameplate, register_sql_functions


def values(spark, function, data, schema="a string"):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(data)], f"i int, {schema}")
    columns = df.columns[1:]
    return [r.v for r in df.select("i", function(*columns).alias("v")).orderBy("i").collect()]


def test_phone(spark):
    data = [
        ("1", "212", "555", "9"), ("1", "212", "555", None), ("", "212", "555", ""), (None, None, "555", "x"),
        ("1", None, "555", None), ("1", "212", None, "9"), ("1", "212", "", "9"), (None, None, None, None),
    ]
    got = values(spark, cleanse.phone, data, "a string, b string, c string, d string")
    assert got == ["+1 (212) 5559", "+1 (212) 555", "(212) 555", "555x", "555", "", "", ""]


def test_gender(spark):
    assert values(spark, cleanse.gender, ["f", "M", "x", "", None]) == ["F", "M", "U", "", None]


def test_low_grade(spark):
    got = values(spark, cleanse.low_grade, ["A+", "AAA", "BBB-", "BB", "B", "", None, "a"])
    assert got == [False, False, False, True, True, True, True, True]


def test_dates(spark):
    d = dt.date
    assert values(spark, cleanse.compact_date, ["20200229", "20200229-1200", "20210229", "x", None]) == [
        d(2020, 2, 29), d(2020, 2, 29), None, None, None,
    ]
    assert values(spark, cleanse.iso_date, ["2020-02-29T01:02:03", "2021-02-29", ""]) == [d(2020, 2, 29), None, None]
    assert values(spark, cleanse.century_before, [d(2000, 2, 29), d(2017, 7, 7)], "a date") == [d(1900, 2, 28), d(1917, 7, 7)]
    assert values(spark, cleanse.date_key, [d(2017, 7, 7), None], "a date") == [20170707, None]


def test_time_of_day(spark):
    moment = dt.datetime(2024, 3, 10, 2, 30, 59, 5)
    assert values(spark, cleanse.time_text, [moment, None], "a timestamp_ntz") == ["02:30:59", None]
    assert values(spark, cleanse.clock_text, [0, 59, 3600, 86399], "a int") == [
        "00:00:00", "00:00:59", "01:00:00", "23:59:59",
    ]


def test_casts(spark):
    texts = [" 0012 ", "12.5", "", "junk", "-3", None, "99999999999"]
    assert values(spark, cleanse.to_integer, texts) == [12, None, None, None, -3, None, 99999999999]
    assert values(spark, cleanse.integer_or_null, texts) == [12, None, None, None, -3, None, None]
    got = values(spark, lambda a: cleanse.to_decimal(a, 8, 2), ["12.55", "12.555", "x", "1234567.00"])
    assert got == [Decimal("12.55"), Decimal("12.56"), None, None]
    assert values(spark, cleanse.to_boolean, ["true", "0", "1", "FALSE", "maybe"]) == [True, False, True, False, None]


def test_text(spark):
    assert values(spark, cleanse.without_first, ["+abc", "x", "", None]) == ["abc", "", "", None]
    assert values(spark, cleanse.starts_with_zero, ["01", "10", "", None]) == [True, False, False, None]
    assert values(spark, cleanse.blank_to_null, ["", " ", "x"]) == [None, " ", "x"]
    assert values(spark, cleanse.null_to_blank, [None, "x"]) == ["", "x"]


# worth, income, cards, children, age, rating, cars, prospect variant, enrichment variant
PLATES = [
    (1_000_000, 200_000, 5, 3, 45, 600, 3, "Inherited", ""),
    (1_000_001, 200_000, 5, 3, 25, 600, 3, "HighValue+Inherited", "HighValue"),
    (1_000_001, 200_000, 5, 3, 24, 600, 3, "HighValue+Inherited", "HighValue+Inherited"),
    (500_000, 200_001, 6, 3, 25, 600, 3, "HighValue+Expenses", "HighValue+Expenses"),
    (500_000, 60_000, 8, 3, 46, 600, 3, "Expenses+Boomer+Spender+Inherited", "Expenses+Boomer+Spender"),
    (500_000, 60_000, 1, 4, 20, 600, 4, "Expenses+Spender", "Expenses+Spender"),
    (99_999, 60_000, 1, 1, 20, 600, 1, "MoneyAlert", "MoneyAlert"),
    (100_000, 4_999, 1, 1, 20, 600, 1, "MoneyAlert", "MoneyAlert"),
    (100_000, 5_000, 1, 1, 20, 600, 1, "", "MoneyAlert"),
    (100_000, 49_999, 1, 1, 20, 600, 1, "", "MoneyAlert"),
    (100_000, 50_000, 1, 1, 20, 599, 1, "MoneyAlert", "MoneyAlert"),
    (0, 0, 0, 0, 0, 0, 0, "MoneyAlert", ""),
    (None, None, None, None, None, None, None, "", ""),
]
_FIELDS = "worth long, income long, cards int, children int, age int, rating int, cars int"


@pytest.mark.parametrize("rules, at", [(PROSPECT_RULES, 7), (ENRICHMENT_RULES, 8)])
def test_nameplate(spark, rules, at):
    got = values(spark, lambda *c: nameplate(*c, rules), [p[:7] for p in PLATES], _FIELDS)
    assert got == [p[at] for p in PLATES]


def test_sql_functions_agree(spark):
    register_sql_functions(spark)
    got = values(
        spark, lambda *c: F.call_function("marketing_nameplate", *[F.col(x).cast("bigint") for x in c]),
        [p[:7] for p in PLATES], _FIELDS,
    )
    assert got == [p[7] for p in PLATES]
    row = spark.sql("SELECT gender_code('q'), gender_code(''), low_grade('BBB'), low_grade(NULL)").first()
    assert tuple(row) == ("U", "", False, True)
