"""Win rates as plain aggregates: per key, per key and day, per hero pair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlens.functions.columns import date_parts, utc_date
from matchlens.operators.expand import hero_counters_once, hero_pairs_once, hero_results


def win_rate_columns(time: str = "start_time") -> list[Column]:
    """Wins, games, ratio and latest time; every part merges, so map tasks pre-aggregate."""
    return [
        F.sum("win").alias("wins"),
        F.count(F.lit(1)).alias("played"),
        (F.sum("win") / F.count(F.lit(1))).alias("win_rate"),
        F.max(time).alias("latest"),
    ]


def win_rate(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Win rate with count per key over all given results."""
    return results.groupBy(*keys).agg(*win_rate_columns())


def hero_win_rate_daily(matches: DataFrame) -> DataFrame:
    """Win rate and picks of each hero on each day (batch form of the daily window)."""
    results = hero_results(matches)
    daily = results.groupBy("hero_id", utc_date().alias("date")).agg(*win_rate_columns())
    return daily.select("hero_id", *date_parts(F.col("date")), "win_rate", F.col("played").alias("count"))


def _both_orders(wins1: Column, wins2: Column) -> Column:
    """The two oriented rows of an unordered pair; a hero paired with itself gets one row."""
    forward = F.struct(F.col("lo").alias("hero_id1"), F.col("hi").alias("hero_id2"), wins1.alias("wins"))
    backward = F.struct(F.col("hi").alias("hero_id1"), F.col("lo").alias("hero_id2"), wins2.alias("wins"))
    return F.when(F.col("lo") == F.col("hi"), F.array(forward)).otherwise(F.array(forward, backward))


def _oriented(totals: DataFrame, wins1: Column, wins2: Column) -> DataFrame:
    rows = totals.select("played", "latest", F.explode(_both_orders(wins1, wins2)).alias("o"))
    return rows.select(
        "o.hero_id1", "o.hero_id2", "o.wins", "played", (F.col("o.wins") / F.col("played")).alias("win_rate"), "latest"
    )


def _unordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.least("hero_id1", "hero_id2").alias("lo"),
        F.greatest("hero_id1", "hero_id2").alias("hi"),
        "start_time",
        F.when(F.col("hero_id1") <= F.col("hero_id2"), F.col("win")).otherwise(1 - F.col("win")).alias("lo_win"),
        "win",
    )


def pair_win_rate(matches: DataFrame) -> DataFrame:
    """Win rate of every ordered pair of heroes on one side.

    Both orders share their numbers, so only half of the rows are expanded and aggregated. A hero
    paired with itself stands for both orders and counts twice.
    """
    twice = F.when(F.col("lo") == F.col("hi"), 2).otherwise(1)
    totals = (
        _unordered(hero_pairs_once(matches))
        .groupBy("lo", "hi")
        .agg(F.sum("win").alias("w"), F.count(F.lit(1)).alias("n"), F.max("start_time").alias("latest"))
        .select("lo", "hi", (F.col("w") * twice).alias("w"), (F.col("n") * twice).alias("played"), "latest")
    )
    return _oriented(totals, F.col("w"), F.col("w"))


def counter_win_rate(matches: DataFrame) -> DataFrame:
    """Win rate of every hero against every hero of the other side.

    The reverse order holds the complement of the wins, so again only half of the rows are needed. A
    hero against itself yields one win and one loss per meeting.
    """
    mirror = F.col("lo") == F.col("hi")
    totals = (
        _unordered(hero_counters_once(matches))
        .groupBy("lo", "hi")
        .agg(F.sum("lo_win").alias("w"), F.count(F.lit(1)).alias("n"), F.max("start_time").alias("latest"))
        .select(
            "lo",
            "hi",
            F.when(mirror, F.col("n")).otherwise(F.col("w")).alias("w"),
            F.when(mirror, F.col("n") * 2).otherwise(F.col("n")).alias("played"),
            "latest",
        )
    )
    return _oriented(totals, F.col("w"), F.col("played") - F.col("w"))


def best_partners(rates: DataFrame, k: int, min_played: int = 1, best: bool = True) -> DataFrame:
    """The ``k`` best (or worst) second heroes for each first hero.

    ``rates`` has one row per hero pair, so a group is never larger than the number of heroes. Equal
    rates are ordered by games played, then by hero id.
    """
    rate = F.col("win_rate").desc() if best else F.col("win_rate").asc()
    order = Window.partitionBy("hero_id1").orderBy(rate, F.col("played").desc(), F.col("hero_id2"))
    return (
        rates.where(F.col("played") >= min_played)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )


def best_teammates(matches: DataFrame, k: int = 5, min_played: int = 1) -> DataFrame:
    return best_partners(pair_win_rate(matches), k, min_played)


def best_opponents(matches: DataFrame, k: int = 5, min_played: int = 1) -> DataFrame:
    """Opponents a hero beats most often."""
    return best_partners(counter_win_rate(matches), k, min_played)


def live_win_rate(results: DataFrame, keys: Sequence[str], size: int, order: Sequence[str]) -> DataFrame:
    """Win rate of each key over its newest ``size`` results.

    A key's results are first dealt over blocks and each block keeps its newest ``size``; only those meet in
    one task. So a hot key is sorted by many tasks, whatever ``size`` is.
    """
    newest_first = [F.col(c).desc() for c in order]
    blocks = int(results.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = results.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    recent = dealt
    for group in ([*keys, "_block"], [*keys]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*newest_first))
        recent = recent.withColumn("_rank", rank).where(F.col("_rank") <= size)
    return recent.groupBy(*keys).agg(*win_rate_columns())
