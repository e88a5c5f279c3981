"""Batch jobs over the keyed tables: by date argument, and for all dates not processed yet."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.operators import activity
from matchlens.operators.dates import in_month, new_dates, next_date, on_day
from matchlens.sinks.tables import MICRO_BATCH, STREAM_TABLES, Tables

Day = tuple[int, int, int]
JOB = "activity"
BITMAP_JOB = "user_bitmaps"


def in_days(days: list[Day]) -> Column:
    """Filter on date columns; Spark evaluates it on folder names, so only these days are read."""
    wanted = [F.struct(*[F.lit(v) for v in day]) for day in days]
    return F.struct("year", "month", "day").isin(wanted)


def in_months(months: list[tuple[int, int]]) -> Column:
    wanted = [F.struct(*[F.lit(v) for v in month]) for month in months]
    return F.struct("year", "month").isin(wanted)


def newer_than(seen: dict[Day, int]) -> Column:
    """Filter on date and batch columns: facts of these days from later micro-batches than those seen (-1: none yet)."""
    days_at: dict[int, list[Day]] = {}
    for day, batch in seen.items():
        days_at.setdefault(batch, []).append(day)
    return reduce(or_, [in_days(days) & (F.expr(MICRO_BATCH) > batch) for batch, days in days_at.items()])


def run_player_daily(tables: Tables, day: str) -> None:
    """Per-player totals of one day (``yyyy-MM-dd``)."""
    tables.upsert("player_daily", activity.player_daily(tables.read("player_match", on_day(day))))


def daily_users(rows: DataFrame, method: str = "exact") -> DataFrame:
    """Daily active users by ``exact``, ``sorted`` or ``hll`` counting."""
    if method == "exact":
        return activity.active_users(rows)
    if method == "sorted":
        return activity.active_users_sorted(rows)
    if method == "hll":
        return activity.active_users_hll(rows)
    raise ValueError(f"unknown method {method!r}")


def run_daily_users(tables: Tables, day: str, method: str = "exact") -> None:
    tables.upsert("daily_active_users", daily_users(tables.read("daily_player", on_day(day)), method))


def run_monthly_users(tables: Tables, month: str, method: str = "exact") -> None:
    """Monthly active users of one month (``yyyy-MM``), exact or from the month's rows as a sketch."""
    rows = tables.read("daily_player", in_month(month))
    if method == "exact":
        users = activity.active_users(rows, activity.MONTH)
    elif method == "hll":
        users = activity.active_users_hll(rows, activity.MONTH)
    else:
        raise ValueError(f"unknown method {method!r}")
    tables.upsert("monthly_active_users", users)


FACTS = ("player_match", "daily_player")
DATE = ["year", "month", "day"]


def pending_dates(tables: Tables, job: str = JOB, after: str | None = None) -> DataFrame:
    """Closed days (those with a hero win rate) that ``job`` must do, with the newest batch of their facts.

    Facts and hero windows come from separate streams, so a day can close before its facts are there, and late
    facts can follow. A day is pending until it is logged, and again when a newer batch of facts has arrived.
    """
    done = tables.read("processed_dates", F.col("job") == job)
    closed = new_dates(tables.dates("hero_win_rate"), done.limit(0), after)
    facts = tables.newest_batches(FACTS[0]).unionByName(tables.newest_batches(FACTS[1]))
    newest = facts.groupBy(*DATE).agg(F.max("batch").alias("batch"))
    logged = done.select(*DATE, F.coalesce("batch", F.lit(-1)).alias("seen"))
    states = closed.join(newest, DATE, "left").join(logged, DATE, "left").withColumn("batch", F.coalesce("batch", F.lit(-1)))
    return states.where(F.col("seen").isNull() | (F.col("batch") > F.col("seen"))).select(*DATE, "batch")


def refresh_bitmaps(tables: Tables, months: list[tuple[int, int]]) -> list[Day]:
    """Add the users of newer facts to the bitmaps of the days of these months; returns the days that had some.

    Only micro-batches that came after a day's bitmaps are read. A user who is added twice counts once, so an interrupted
    run can be repeated. Days are logged like those of a job, after their bitmaps are there.
    """
    logged = tables.read("processed_dates", F.col("job") == BITMAP_JOB).select(*DATE, F.col("batch").alias("seen"))
    newest = tables.newest_batches("daily_player").where(in_months(months)).join(logged, DATE, "left")
    changed = newest.withColumn("seen", F.coalesce("seen", F.lit(-1))).where("batch > seen")
    # Dates only: at most one small row per calendar day.
    found = changed.collect()
    batch_of = {(r.year, r.month, r.day): r.batch for r in found}
    days = sorted(batch_of)
    if days:
        seen = {(r.year, r.month, r.day): r.seen for r in found}
        fresh = activity.user_bitmaps(tables.read_batches("daily_player", newer_than(seen)))
        both = fresh.unionByName(tables.read("daily_user_bitmap", in_days(days)))
        tables.upsert("daily_user_bitmap", activity.merge_bitmaps(both, activity.DAY))
        log_days(tables, BITMAP_JOB, batch_of)
    return days


def log_days(tables: Tables, job: str, batch_of: dict[Day, int]) -> None:
    rows = [(job, *day, batch_of[day]) for day in sorted(batch_of)]
    tables.upsert("processed_dates", tables.spark.createDataFrame(rows, "job string, year int, month int, day int, batch long"))


def refresh_activity(
    tables: Tables,
    first_only: bool = False,
    after: str | None = None,
    sketches: bool = False,
    bitmaps: bool = False,
    compact: bool = False,
) -> list[Day]:
    """Bring player totals, daily users and monthly users up to date; returns the days done.

    All pending days are computed in one pass per table. The days are logged last, with the newest batch that
    was there before their facts were read, so a run that stops early is repeated and later facts open the
    day again. With ``sketches``, months are estimated by merging stored daily sketches; days of these months
    without one get it first. With ``bitmaps``, months are exact and come from stored daily bitmaps, so only days with
    newer facts are read. With ``compact``, the micro-batch folders of the days are merged before they are read.
    """
    pending = pending_dates(tables, after=after)
    if first_only:
        pending = pending.join(next_date(pending), DATE, "left_semi")
    # Dates only: at most one small row per calendar day.
    batch_of = {(r.year, r.month, r.day): r.batch for r in pending.collect()}
    days = sorted(batch_of)
    if not days:
        return []
    months = sorted({day[:2] for day in days})
    if compact:
        compact_days(tables, days)
    tables.upsert("player_daily", activity.player_daily(tables.read("player_match", in_days(days))))
    tables.upsert("daily_active_users", activity.active_users(tables.read("daily_player", in_days(days))))
    monthly_rows = tables.read("daily_player", in_months(months))
    if bitmaps:
        refresh_bitmaps(tables, months)
        merged = activity.merge_bitmaps(tables.read("daily_user_bitmap", in_months(months)), activity.MONTH)
        monthly = activity.bitmap_counts(merged, activity.MONTH)
    elif sketches:
        # Stored sketches of other days stay, those of pending days and missing ones are made.
        stored = tables.read("daily_user_sketch", in_months(months) & ~in_days(days)).select(*DATE)
        tables.upsert("daily_user_sketch", activity.user_sketches(monthly_rows.join(stored, DATE, "left_anti")))
        merged = activity.merge_sketches(tables.read("daily_user_sketch", in_months(months)), activity.MONTH)
        monthly = activity.sketch_counts(merged)
    else:
        monthly = activity.active_users(monthly_rows, activity.MONTH)
    tables.upsert("monthly_active_users", monthly)
    log_days(tables, JOB, batch_of)
    return days


def compact_days(tables: Tables, days: list[Day]) -> None:
    """Merge the many small micro-batch folders of closed days."""
    for name in STREAM_TABLES:
        tables.compact(name, in_days(days))
