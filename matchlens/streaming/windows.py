"""Event-time aggregates on match streams: daily hero win rates and cluster players."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens import schema as S
from matchlens.functions.columns import date_parts, event_time, utc_date
from matchlens.operators.expand import hero_results


def with_event_time(matches: DataFrame, delay: str = S.MATCH_DELAY) -> DataFrame:
    """Adds ``ts`` and a watermark: matches later than ``delay`` are dropped by windows below."""
    return matches.withColumn("ts", event_time()).withWatermark("ts", delay)


def dedup_replays(timed: DataFrame) -> DataFrame:
    """Drops repeated match ids within the watermark; optional, since plain totals count replays."""
    return timed.dropDuplicatesWithinWatermark(["match_id"])


def hero_win_rate_windows(timed: DataFrame, length: str = "1 day", slide: str | None = None) -> DataFrame:
    """Win rate, picks and latest start of each hero per time window.

    The ten hero rows of a match are summed per hero inside each task before the shuffle, and only one
    small state row per hero and window is kept. Sliding windows are built from panes of the slide's
    length, so a row is not copied into every window that covers it. Works on streams and on batches.
    """
    totals = [F.sum("win").alias("wins"), F.count(F.lit(1)).alias("played"), F.max("start_time").alias("latest")]
    panes = hero_results(timed, ["ts"]).groupBy(F.window("ts", slide or length), "hero_id").agg(*totals)
    windows = _slide(panes, "hero_id", ["wins", "played"], length, slide)
    rate = F.col("wins") / F.col("played")
    return windows.select("hero_id", "window_start", "wins", "played", rate.alias("win_rate"), "latest")


def cluster_player_windows(timed: DataFrame, length: str = "1 day", slide: str | None = None) -> DataFrame:
    """Players who joined per cluster and time window, with the latest start."""
    players = F.lit(S.MATCH_PLAYERS).cast("bigint").alias("players")
    joined = timed.select("ts", F.col("cluster").alias("cluster_id"), "start_time", players)
    totals = [F.sum("players").alias("num_of_players"), F.max("start_time").alias("latest")]
    panes = joined.groupBy(F.window("ts", slide or length), "cluster_id").agg(*totals)
    windows = _slide(panes, "cluster_id", ["num_of_players"], length, slide)
    return windows.select("cluster_id", "window_start", "num_of_players", "latest")


def _slide(panes: DataFrame, key: str, sums: list[str], length: str, slide: str | None) -> DataFrame:
    """Overlapping windows from panes (column ``window``); tumbling windows are their own panes."""
    if slide is not None:
        covering = F.window(F.window_time("window"), length, slide)
        totals = [F.sum(c).alias(c) for c in sums] + [F.max("latest").alias("latest")]
        panes = panes.groupBy(covering, key).agg(*totals)
    return panes.withColumn("window_start", F.col("window.start"))


def arrival_windows(matches: DataFrame, length: str = "5 minutes", clock: Column | None = None) -> DataFrame:
    """Players per cluster by arrival time instead of event time.

    ``clock`` is when a row arrived, such as the time that the message source has stamped on it; by default it is the time
    of the micro-batch. A window closes when a later arrival has passed its end.
    """
    stamped = matches.withColumn("arrived", F.current_timestamp() if clock is None else clock)
    players = F.lit(S.MATCH_PLAYERS).cast("bigint").alias("players")
    arrived = stamped.withWatermark("arrived", "0 seconds").select("arrived", F.col("cluster").alias("cluster_id"), "start_time", players)
    grouped = arrived.groupBy(F.window("arrived", length), "cluster_id").agg(
        F.sum("players").alias("num_of_players"), F.max("start_time").alias("latest")
    )
    return grouped.select("cluster_id", F.col("window.start").alias("window_start"), "num_of_players", "latest")


def _window_date() -> list:
    return date_parts(utc_date(F.unix_seconds("window_start")))


def hero_table_rows(windows: DataFrame) -> DataFrame:
    """Daily windows as rows of the ``hero_win_rate`` table."""
    return windows.select("hero_id", *_window_date(), "win_rate", F.col("played").alias("count"))


def region_table_rows(windows: DataFrame) -> DataFrame:
    """Daily windows as rows of the ``region_num_of_players`` table."""
    return windows.select("cluster_id", *_window_date(), "num_of_players")
