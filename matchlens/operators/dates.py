"""Date arguments and the choice of dates that still need work."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.functions.columns import date_parts


def parse_day(text: str) -> date:
    """``yyyy-MM-dd`` or ValueError."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"expected yyyy-MM-dd, got {text!r}")
    return date.fromisoformat(text)


def parse_month(text: str) -> tuple[int, int]:
    """``yyyy-MM`` or ValueError."""
    if not re.fullmatch(r"\d{4}-\d{2}", text):
        raise ValueError(f"expected yyyy-MM, got {text!r}")
    first = date.fromisoformat(f"{text}-01")
    return first.year, first.month


def on_day(text: str) -> Column:
    """Filter on the date columns of a table; prunes its partitions."""
    day = parse_day(text)
    return (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)


def in_month(text: str) -> Column:
    year, month = parse_month(text)
    return (F.col("year") == year) & (F.col("month") == month)


def row_date() -> Column:
    return F.make_date(F.col("year"), F.col("month"), F.col("day"))


def new_dates(dated: DataFrame, processed: DataFrame, after: str | None = None) -> DataFrame:
    """Dates that occur in ``dated`` but not in ``processed``, later than ``after`` if given."""
    days = dated.select("year", "month", "day").distinct()
    if after is not None:
        days = days.where(row_date() > F.lit(parse_day(after)))
    return days.join(processed.select("year", "month", "day"), ["year", "month", "day"], "left_anti")


def next_date(days: DataFrame) -> DataFrame:
    """The smallest of the given dates (no row when there is none)."""
    smallest = days.agg(F.min(row_date()).alias("date")).where(F.col("date").isNotNull())
    return smallest.select(*date_parts(F.col("date")))
