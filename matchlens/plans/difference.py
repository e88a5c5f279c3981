"""Refresh by difference: newer facts are added to stored totals, so a late match does not make its day be read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens import schema as S
from matchlens.operators import activity
from matchlens.operators.keyed import newest_rows
from matchlens.plans.jobs import DATE, Day, in_days, in_months, log_days, newer_than, pending_dates, refresh_bitmaps
from matchlens.session import delete_path, new_folder, stage
from matchlens.sinks.tables import BATCH_STEP, MICRO_BATCH, Tables

JOB = "activity_difference"
FACTS = "player_match"
TOTALS = "player_totals"
MATCH_KEY = list(S.TABLES[FACTS].key)
PLAYER_DAY = ["account_id", *DATE]
SUMS = ("matches_played", "matches_won", "time_played_in_sec")


def refresh_by_difference(tables: Tables, after: str | None = None) -> list[Day]:
    """Bring player totals, daily and monthly users up to date from micro-batches not counted yet; returns the days done.

    Pending days are found as by ``jobs.refresh_activity``, with a log of their own: the first run counts each closed day
    whole. Users are exact and come from the daily bitmaps. A run that stops anywhere can be repeated.
    """
    pending = pending_dates(tables, JOB, after)
    # Dates only, here and below: at most one small row per calendar day.
    batch_of = {(r.year, r.month, r.day): r.batch for r in pending.collect()}
    days = sorted(batch_of)
    if not days:
        return []
    add_matches(tables, days)
    logged = tables.read("processed_dates", F.col("job") == JOB).select(*DATE, F.col("batch").alias("seen"))
    changed = tables.read(TOTALS, in_days(days)).join(logged, DATE, "left").where("seen IS NULL OR batch > seen")
    tables.upsert("player_daily", changed.select(*S.TABLES["player_daily"].schema.fieldNames()))
    months = sorted({day[:2] for day in days})
    refresh_bitmaps(tables, months)
    bitmaps = tables.read("daily_user_bitmap", in_months(months))
    tables.upsert("daily_active_users", activity.bitmap_counts(bitmaps.where(in_days(days)), activity.DAY))
    merged = activity.merge_bitmaps(bitmaps, activity.MONTH)
    tables.upsert("monthly_active_users", activity.bitmap_counts(merged, activity.MONTH))
    log_days(tables, JOB, batch_of)
    return days


def add_matches(tables: Tables, days: list[Day]) -> None:
    """Add the matches of micro-batches that came after the totals of these days.

    Totals carry the newest micro-batch they hold, and both are written by one upsert, so none is added twice. A row that
    replaces an earlier one (a replayed or corrected match) counts by its difference. Only accounts that have totals on that
    day can have such rows; earlier facts are read for their range of accounts, and not at all if there are none. A day
    whose counted and newer facts were merged into one folder is counted again as a whole.
    """
    tables.finish_upsert(TOTALS)
    facts = tables.read_batches(FACTS, in_days(days))
    seen = _counted(tables, facts, days)
    folder = new_folder(tables.spark, "difference")
    try:
        newest = newest_rows(facts.where(newer_than(seen)), MATCH_KEY, ["batch"])
        fresh = stage(newest.select(*MATCH_KEY, "win", "duration", "batch"), "fresh", folder)
        parts = _amounts(fresh, 1)
        kept = [day for day in days if seen[day] >= 0]
        if kept:
            totals = tables.read(TOTALS, in_days(kept))
            parts = parts.unionByName(totals.join(fresh.select(*PLAYER_DAY).distinct(), PLAYER_DAY, "left_semi"))
            again = stage(fresh.join(totals.select(*PLAYER_DAY), PLAYER_DAY, "left_semi").select(*MATCH_KEY), "again", folder)
            ends = again.agg(F.min("account_id").alias("first"), F.max("account_id").alias("last")).first()
            if ends["first"] is not None:
                earlier = facts.where(in_days(kept) & ~newer_than(seen) & F.col("account_id").between(ends["first"], ends["last"]))
                replaced = newest_rows(earlier.join(again, MATCH_KEY, "left_semi"), MATCH_KEY, ["batch"])
                parts = parts.unionByName(_amounts(replaced, -1))
        sums = [F.sum(c).alias(c) for c in SUMS]
        tables.upsert(TOTALS, parts.groupBy(*PLAYER_DAY).agg(*sums, F.max("batch").alias("batch")))
    finally:
        delete_path(tables.spark, folder)


def _counted(tables: Tables, facts: DataFrame, days: list[Day]) -> dict[Day, int]:
    """The newest micro-batch in the totals of each day; -1 if there is none, or none that newer facts can be told from."""
    counted = tables.read(TOTALS, in_days(days)).groupBy(*DATE).agg(F.max("batch").alias("counted"))
    merged = facts.where(f"batch % {BATCH_STEP} <> 0").groupBy(*DATE).agg(F.max(F.expr(MICRO_BATCH)).alias("merged"))
    usable = counted.join(merged, DATE, "left").where("merged IS NULL OR merged <= counted")
    return dict.fromkeys(days, -1) | {(r.year, r.month, r.day): r.counted for r in usable.collect()}


def _amounts(rows: DataFrame, sign: int) -> DataFrame:
    """What each match adds to (or, with sign -1, takes from) the totals of its player's day."""
    times = F.lit(sign).cast("bigint")
    played, won, seconds = times, times * F.col("win").cast("int"), times * F.col("duration")
    return rows.select(*PLAYER_DAY, *[c.alias(n) for n, c in zip(SUMS, (played, won, seconds))], F.expr(MICRO_BATCH).alias("batch"))
