"""The marketing nameplate: up to six tags from seven prospect measures, joined by ``+``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.cleanse import col


@dataclass(frozen=True)
class NameplateRules:
    """Where the two published variants of the rule differ."""

    low_income: int
    young_and_rich: bool  # Inherited: under 25 and rich, or else over 25 or rich
    zero_is_missing: bool


# The two variants and the shared thresholds.
ENRICHMENT_RULES = NameplateRules(low_income=50_000, young_and_rich=True, zero_is_missing=True)
PROSPECT_RULES = NameplateRules(low_income=5_000, young_and_rich=False, zero_is_missing=False)
RICH = 1_000_000
HIGH_INCOME = 200_000
MANY_CHILDREN = 3
MANY_CARDS = 5
BOOMER_AGE = 45
LOW_RATING = 600
LOW_WORTH = 100_000
MANY_CARS = 3
SPENDER_CARDS = 7
INHERITED_AGE = 25


def nameplate(
    net_worth: Column | str,
    income: Column | str,
    cards: Column | str,
    children: Column | str,
    age: Column | str,
    rating: Column | str,
    cars: Column | str,
    rules: NameplateRules = ENRICHMENT_RULES,
) -> Column:
    """Comparisons with a missing measure count as false; no tag gives the empty text."""
    measures = [col(c) for c in (net_worth, income, cards, children, age, rating, cars)]
    if rules.zero_is_missing:
        measures = [F.nullif(m, F.lit(0)) for m in measures]
    net_worth, income, cards, children, age, rating, cars = measures
    rich = net_worth > RICH
    inherited = (
        (age < INHERITED_AGE) & rich if rules.young_and_rich else (age > INHERITED_AGE) | rich
    )
    tags = {
        "HighValue": rich | (income > HIGH_INCOME),
        "Expenses": (children > MANY_CHILDREN) | (cards > MANY_CARDS),
        "Boomer": age > BOOMER_AGE,
        "MoneyAlert": (income < rules.low_income) | (rating < LOW_RATING) | (net_worth < LOW_WORTH),
        "Spender": (cars > MANY_CARS) | (cards > SPENDER_CARDS),
        "Inherited": inherited,
    }
    return F.concat_ws("+", *[F.when(test, F.lit(tag)) for tag, test in tags.items()])


def register_sql_functions(spark: SparkSession) -> None:
    """Make the cleaning rules usable from ``spark.sql`` as temporary functions."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION low_grade(rating STRING) RETURNS BOOLEAN "
        "RETURN NOT (startswith(coalesce(rating, ''), 'A') OR startswith(coalesce(rating, ''), 'BBB'))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION gender_code(code STRING) RETURNS STRING "
        "RETURN CASE WHEN upper(code) IN ('', 'F', 'M') THEN upper(code) WHEN code IS NOT NULL THEN 'U' END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION marketing_nameplate("
        "net_worth BIGINT, income BIGINT, cards BIGINT, children BIGINT, age BIGINT, rating BIGINT, cars BIGINT) "
        "RETURNS STRING RETURN concat_ws('+', "
        f"IF(net_worth > {RICH} OR income > {HIGH_INCOME}, 'HighValue', NULL), "
        f"IF(children > {MANY_CHILDREN} OR cards > {MANY_CARDS}, 'Expenses', NULL), "
        f"IF(age > {BOOMER_AGE}, 'Boomer', NULL), "
        f"IF(income < {PROSPECT_RULES.low_income} OR rating < {LOW_RATING} OR net_worth < {LOW_WORTH}, "
        "'MoneyAlert', NULL), "
        f"IF(cars > {MANY_CARS} OR cards > {SPENDER_CARDS}, 'Spender', NULL), "
        f"IF(age > {INHERITED_AGE} OR net_worth > {RICH}, 'Inherited', NULL))"
    )
