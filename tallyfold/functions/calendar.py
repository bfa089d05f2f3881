"""Dates: text parsing, date keys and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: month/day/year, one or two digits for the first two, four for the year.
DATE_TEXT_PATTERN = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"


def parse_us_date(text: Column) -> Column:
    """Date of month/day/year text, NULL when it is none."""
    return F.when(text.rlike(DATE_TEXT_PATTERN), F.try_to_date(text, "M/d/yyyy"))


def date_key(date: Column) -> Column:
    """The date as the number yyyymmdd."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def calendar_columns(date: Column) -> list[Column]:
    """All columns of the date dimension for one date. Sunday is day 1; weeks are ISO."""
    return [
        date_key(date).alias("date_key"),
        date.alias("date"),
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.date_format(date, "MMM").alias("month_name"),
        F.dayofmonth(date).alias("day"),
        F.dayofweek(date).alias("day_of_week"),
        F.date_format(date, "EEE").alias("day_name"),
        F.weekofyear(date).alias("week_of_year"),
    ]


def payment_due(date: Column, days: Column | int) -> Column:
    return F.date_add(date, days)


def stamp(value) -> Column:
    """A zone-free timestamp literal; the same in every session time zone."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")
