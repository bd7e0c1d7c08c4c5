"""Parsers for single contract fields, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from overspend import fixed_values as fv

_BLANKS = " \t\n\r\f\v"


def blank_to_null(value: Column) -> Column:
    """Null for blank text and for the text that a missing float turns into."""
    trimmed = F.trim(value, F.lit(_BLANKS))
    return F.when(~F.lower(trimmed).isin("", "nan", "none"), value)


def _first_number(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 0).try_cast("int")


def parse_duration(value: Column) -> Column:
    """First run of digits in free text; null when there is none or the text means "not given"."""
    text = F.trim(value.cast("string"), F.lit(_BLANKS))
    return F.when(~F.lower(text).isin(fv.BLANK_DURATION_WORDS), _first_number(text, r"\d+"))


def parse_year(value: Column, default: int = fv.DEFAULT_YEAR) -> Column:
    """First four digits in free text, else ``default``.

    A shorter run of digits is below 1000, so it can never be a year in 2000..2030 and needs no branch.
    """
    text = F.trim(value.cast("string"), F.lit(_BLANKS))
    year = F.when(~F.lower(text).isin(fv.BLANK_YEAR_WORDS), _first_number(text, r"\d{4}"))
    return F.coalesce(year, F.lit(default))


def whole_number(value: Column, default: int | None = None) -> Column:
    """Numeric form of both parsers: truncate, NaN and out-of-range values become ``default``."""
    usable = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return F.coalesce(usable.try_cast("int"), F.lit(default).cast("int"))


def parse_date(value: Column) -> Column:
    """ISO text to a date; unreadable text becomes null."""
    return F.to_date(F.try_to_timestamp(value))


def valid_amount(amount: Column) -> Column:
    """Present, a number, and above zero."""
    return amount.isNotNull() & ~F.isnan(amount) & (amount > 0)
