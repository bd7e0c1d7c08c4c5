"""Parts of times and differences between them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_seconds(moment: Column) -> Column:
    """Whole seconds since 1970; works for times with and without a zone."""
    return F.unix_timestamp(moment)


def seconds_between(start: Column, end: Column) -> Column:
    return epoch_seconds(end) - epoch_seconds(start)


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / 60


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date"))


def calendar_parts(moment: Column) -> dict[str, Column]:
    """Year, month, weekday (1 = Sunday) and hour."""
    return {
        "anno": F.year(moment),
        "mes": F.month(moment),
        "dia_semana": F.dayofweek(moment),
        "hora": F.hour(moment),
    }
