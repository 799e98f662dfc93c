"""Cleaning and typing as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(col(value), F.lit(""))


def null_to_blank(value: Column | str) -> Column:
    return F.coalesce(col(value), F.lit(""))


def default(value: Column | str, other) -> Column:
    return F.coalesce(col(value), F.lit(other))


def money(value: Column | str) -> Column:
    return col(value).try_cast(MONEY)


def to_integer(value: Column | str) -> Column:
    """Text to bigint; blanks around and leading zeros are allowed, anything else is null."""
    return F.trim(col(value)).try_cast("bigint")


def integer_or_null(value: Column | str) -> Column:
    """Text that is a whole number, or null: '12.5' is null."""
    return col(value).try_cast("int")


def to_decimal(value: Column | str, precision: int, scale: int) -> Column:
    return F.trim(col(value)).try_cast(T.DecimalType(precision, scale))


def to_boolean(value: Column | str) -> Column:
    """true / false / 1 / 0 in any case, or null."""
    return F.trim(col(value)).try_cast("boolean")


def compact_date(value: Column | str) -> Column:
    """The first eight characters as yyyyMMdd, or null."""
    return F.try_to_date(F.substring(col(value), 1, 8), "yyyyMMdd")


def iso_date(value: Column | str) -> Column:
    """The first ten characters as yyyy-MM-dd, or null."""
    return F.try_to_date(F.substring(col(value), 1, 10), "yyyy-MM-dd")


def date_key(value: Column | str) -> Column:
    """A date as the integer yyyymmdd."""
    return F.date_format(col(value), "yyyyMMdd").cast("int")


def time_text(value: Column | str) -> Column:
    """The time of day as HH:mm:ss, read off the written timestamp, so no zone plays a part."""
    return F.substring(col(value).cast("string"), 12, 8)


def clock_text(second: Column | str) -> Column:
    """A second of the day as HH:mm:ss."""
    second = col(second)
    parts = (F.floor(second / 3600), F.floor(second / 60) % 60, second % 60)
    return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])


def century_before(value: Column | str) -> Column:
    """The same day a hundred years earlier; 29 February becomes 28 where there is none."""
    return F.add_months(col(value), -1200)


def without_first(value: Column | str) -> Column:
    return F.substring(col(value), F.lit(2), F.length(col(value)))


def starts_with_zero(value: Column | str) -> Column:
    return F.substring(col(value), 1, 1) == "0"


def low_grade(rating: Column | str) -> Column:
    """False for ratings that begin with A or BBB, true for all others, a blank one too."""
    rating = null_to_blank(rating)
    return ~(rating.startswith("A") | rating.startswith("BBB"))


def gender(value: Column | str) -> Column:
    """F or M in upper case, U for another code; null and blank stay as they are."""
    code = F.upper(col(value))
    return F.when(code.isin("", "F", "M"), code).when(code.isNotNull(), F.lit("U"))


def phone(country: Column | str, area: Column | str, local: Column | str, extension: Column | str) -> Column:
    """``+country (area) local`` with what is there; no local number gives blank."""
    country, area, local = blank_to_null(country), blank_to_null(area), blank_to_null(local)
    with_area = F.concat(F.lit("("), area, F.lit(") "), local)
    number = F.coalesce(F.concat(F.lit("+"), country, F.lit(" "), with_area), with_area, local)
    return F.coalesce(F.concat(number, null_to_blank(extension)), F.lit(""))
