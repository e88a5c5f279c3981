"""Dashboard queries over the keyed tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.operators.dates import on_day, parse_day, row_date
from matchlens.operators.regions import with_region


def hero_history(hero_win_rate: DataFrame, hero_id: str | int) -> DataFrame:
    """Win rate and picks of one hero, by date."""
    return hero_win_rate.where(F.col("hero_id") == F.lit(hero_id)).orderBy("year", "month", "day")


def players_on_date(region_players: DataFrame, day: str, exact: DataFrame, ranges: DataFrame) -> DataFrame:
    """Players per region on one date."""
    clusters = with_region(region_players.where(on_day(day)), exact, ranges)
    return clusters.groupBy("region").agg(F.sum("num_of_players").alias("num_of_players")).orderBy("region")


def users_around(daily_active_users: DataFrame, day: str, days: int = 7) -> DataFrame:
    """Daily active users from ``days`` before to ``days`` after a date.

    The year and month bounds repeat the range on the folder columns.
    """
    middle = parse_day(day)
    first, last = middle - timedelta(days=days), middle + timedelta(days=days)
    month = F.col("year") * 12 + F.col("month")
    return (
        daily_active_users.where(month.between(first.year * 12 + first.month, last.year * 12 + last.month))
        .where(row_date().between(F.lit(first), F.lit(last)))
        .orderBy("year", "month", "day")
    )


def account_activity(player_daily: DataFrame, account_id: int) -> DataFrame:
    """Matches played and won and minutes played of one account, by date."""
    return with_minutes(player_daily.where(F.col("account_id") == account_id)).orderBy("year", "month", "day")


def with_minutes(player_daily: DataFrame) -> DataFrame:
    return player_daily.withColumn("minutes", F.col("time_played_in_sec") / 60)


def live_rate(live: DataFrame, key: str) -> DataFrame:
    """The live value of a message key: ``h``, ``a,b`` or ``counter,a,b``."""
    return live.where(F.col("key") == key).select("key", "value")
