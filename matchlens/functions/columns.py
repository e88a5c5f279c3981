"""Scalar expressions: dates, flags, keys and message texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def event_time(start_time: str = "start_time") -> Column:
    """Epoch seconds as a timestamp."""
    return F.timestamp_seconds(start_time)


def utc_date(start_time: str | Column = "start_time") -> Column:
    """The UTC date of epoch seconds, independent of the session time zone."""
    seconds = F.col(start_time) if isinstance(start_time, str) else start_time
    return F.date_from_unix_date(F.floor(seconds / F.lit(SECONDS_PER_DAY)).cast("int"))


def date_parts(date: Column) -> list[Column]:
    """year, month (1 to 12) and day columns of a date."""
    return [F.year(date).alias("year"), F.month(date).alias("month"), F.dayofmonth(date).alias("day")]


def date_text(year: str = "year", month: str = "month", day: str = "day") -> Column:
    """Zero-padded ``yyyy-MM-dd`` text."""
    return F.date_format(F.make_date(F.col(year), F.col(month), F.col(day)), "yyyy-MM-dd")


def flag(text: Column) -> Column:
    """``t``/``true``/``1`` to true, everything else that is not NULL to false."""
    return F.lower(F.trim(text)).isin("t", "true", "1")


def join_ids(*ids: Column) -> Column:
    """Comma-separated key text, such as ``12,93``."""
    return F.concat_ws(",", *[i.cast("string") for i in ids])


def rate_text(win_rate: Column) -> Column:
    """A win rate with three decimals."""
    return F.format_string("%.3f", win_rate)


def win_of(slot: Column, radiant_win: Column) -> Column:
    """1 when the player at list position ``slot`` is on the winning side, else 0."""
    return ((slot < F.lit(5)) == radiant_win).cast("int")


def select_once(df: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
    """Like ``select``, for costly expressions such as parsed JSON.

    A filter above a plain ``select`` is pushed below it with its own copies of the expressions, so each
    text would be parsed once per condition. Nothing is copied through a generator.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))
