"""Players by server cluster and by region."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlens.functions.columns import date_parts, utc_date
from matchlens.operators.bands import band_join
from matchlens.operators.expand import cluster_info


def cluster_players_daily(matches: DataFrame) -> DataFrame:
    """Players who joined a match, per cluster and day, with the latest start."""
    daily = (
        cluster_info(matches)
        .groupBy("cluster_id", utc_date().alias("date"))
        .agg(F.sum("players").alias("num_of_players"), F.max("start_time").alias("latest"))
    )
    return daily.select("cluster_id", *date_parts(F.col("date")), "num_of_players", "latest")


def players_in_game(matches: DataFrame) -> DataFrame:
    """Players in a running match per cluster, after every second in which that number may change.

    Starts add ten and ends take ten away. Changes are summed per cluster and second, then per day;
    the running total is the sum of earlier days plus the sum inside the day. A window group is one
    cluster and day, at most 86,400 rows, whatever a cluster's share of the matches is.
    """
    change = F.explode(
        F.array(
            F.struct(F.col("start_time").alias("t"), F.lit(10).cast("bigint").alias("delta")),
            F.struct((F.col("start_time") + F.col("duration")).alias("t"), F.lit(-10).cast("bigint").alias("delta")),
        )
    )
    changes = matches.select(F.col("cluster").alias("cluster_id"), change.alias("c")).select("cluster_id", "c.*")
    per_second = changes.groupBy("cluster_id", utc_date("t").alias("date"), "t").agg(F.sum("delta").alias("delta"))
    per_day = per_second.groupBy("cluster_id", "date").agg(F.sum("delta").alias("day_delta"))
    days = Window.partitionBy("cluster_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_day.select(
        "cluster_id", "date", F.coalesce(F.sum("day_delta").over(days), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("cluster_id", "date").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    running = per_second.withColumn("within", F.sum("delta").over(inside))
    return running.join(offsets, ["cluster_id", "date"]).select(
        "cluster_id", F.col("t").alias("time"), "delta", (F.col("before") + F.col("within")).alias("players")
    )


def with_region(rows: DataFrame, exact: DataFrame, ranges: DataFrame) -> DataFrame:
    """Adds ``region`` of ``cluster_id``: the exact entry if there is one, else the range, else NULL.

    Of several ranges the narrowest decides, then the one that starts first. Each id is looked up once; ranges may be as
    wide as they like.
    """
    order = F.struct((F.col("hi") - F.col("lo")).alias("width"), "lo", "region")
    spanned = band_join(rows.select("cluster_id").distinct(), ranges, "cluster_id")
    spanned = spanned.groupBy("cluster_id").agg(F.min_by("region", order).alias("region")).withColumn("rank", F.lit(1))
    known = exact.select("cluster_id", "region", F.lit(0).alias("rank")).unionByName(spanned)
    lookup = known.groupBy("cluster_id").agg(F.min_by("region", "rank").alias("region"))
    return rows.join(lookup, "cluster_id", "left")


def region_players_daily(matches: DataFrame, exact: DataFrame, ranges: DataFrame) -> DataFrame:
    """Players per region and day; aggregated per cluster before the lookup is joined."""
    clusters = with_region(cluster_players_daily(matches), exact, ranges)
    return clusters.groupBy("region", "year", "month", "day").agg(F.sum("num_of_players").alias("num_of_players"))
