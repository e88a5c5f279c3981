"""Per-player daily totals and daily or monthly active users: exact, sorted and sketched."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlens import schema as S

DAY = ("year", "month", "day")
MONTH = ("year", "month")


def player_daily(player_match: DataFrame) -> DataFrame:
    """Matches played and won and seconds played, per account and day."""
    return player_match.groupBy("account_id", *DAY).agg(
        F.count(F.lit(1)).alias("matches_played"),
        F.sum(F.col("win").cast("int")).alias("matches_won"),
        F.sum("duration").alias("time_played_in_sec"),
    )


def active_users(rows: DataFrame, period: tuple[str, ...] = DAY, account: str = "account_id") -> DataFrame:
    """Exact distinct accounts per period.

    Spark first removes duplicates per (period, account) in map tasks and again after a shuffle on
    both columns, then counts; a hot day or a hot account is spread by that first shuffle.
    """
    return rows.groupBy(*period).agg(F.count_distinct(F.col(account)).alias("num"))


def distinct_accounts(rows: DataFrame, period: tuple[str, ...] = DAY, account: str = "account_id") -> DataFrame:
    return rows.select(*period, account).distinct()


def active_users_sorted(
    rows: DataFrame, account: str = "account_id", time: str = "time_", buckets: int | None = None
) -> DataFrame:
    """Daily active users by comparing each row with its predecessor in account order.

    Each (day, bucket of accounts) is sorted on its own, and the changes of account are added up. Before
    that, rows are reduced to one per account and hour in map tasks, so that the rows of one account
    in a bucket are at most 24.
    """
    buckets = buckets or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hour = F.floor(F.col(time) / F.lit(3_600_000)).alias("hour")
    bucket = F.pmod(F.xxhash64(account), F.lit(buckets)).alias("bucket")
    hours = rows.groupBy(*DAY, bucket, F.col(account).alias("account"), hour).agg(F.count(F.lit(1)).alias("rows"))
    ordered = Window.partitionBy(*DAY, "bucket").orderBy("account", "hour")
    previous = F.lag("account").over(ordered)
    changed = (~F.col("account").eqNullSafe(previous)).cast("int")
    return (
        hours.where(F.col("account").isNotNull())
        .withColumn("changed", changed)
        .groupBy(*DAY)
        .agg(F.sum("changed").alias("num"))
    )


def user_sketches(
    rows: DataFrame, period: tuple[str, ...] = DAY, account: str = "account_id", bits: int = S.SKETCH_BITS
) -> DataFrame:
    """One mergeable HLL sketch per period, 2^bits registers."""
    return rows.groupBy(*period).agg(F.hll_sketch_agg(account, bits).alias("sketch"))


def merge_sketches(sketches: DataFrame, period: tuple[str, ...]) -> DataFrame:
    """Sketches of a coarser period from those of a finer one, without reading the rows again."""
    return sketches.groupBy(*period).agg(F.hll_union_agg("sketch").alias("sketch"))


def user_bitmaps(rows: DataFrame, period: tuple[str, ...] = DAY, account: str = "account_id") -> DataFrame:
    """The exact set of accounts of each period: one bitmap per bucket of 32,768 neighbouring account numbers.

    Buckets spread a hot day over tasks, and a bitmap is 4 KB however often an account plays. Rows without account
    belong to no one.
    """
    known = rows.where(F.col(account).isNotNull())
    buckets = known.groupBy(*period, F.bitmap_bucket_number(account).alias("bucket"))
    return buckets.agg(F.bitmap_construct_agg(F.bitmap_bit_position(account)).alias("users"))


def merge_bitmaps(bitmaps: DataFrame, period: tuple[str, ...]) -> DataFrame:
    """Bitmaps of a coarser period from those of a finer one, without reading the rows again."""
    return bitmaps.groupBy(*period, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def bitmap_counts(bitmaps: DataFrame, period: tuple[str, ...]) -> DataFrame:
    """The exact number of accounts of each period, from one bitmap per bucket."""
    return bitmaps.groupBy(*period).agg(F.sum(F.bitmap_count("users")).alias("num"))


def sketch_counts(sketches: DataFrame) -> DataFrame:
    """The estimated number of users in each sketch."""
    return sketches.withColumn("num", F.hll_sketch_estimate("sketch")).drop("sketch")


def active_users_hll(
    rows: DataFrame, period: tuple[str, ...] = DAY, account: str = "account_id", bits: int = S.SKETCH_BITS
) -> DataFrame:
    return sketch_counts(user_sketches(rows, period, account, bits))


def close_counts(exact: DataFrame, estimated: DataFrame, period: tuple[str, ...], error: float = 0.05) -> DataFrame:
    """Exact counts per period and whether the estimates lie within the relative error of them."""
    both = exact.join(estimated.withColumnRenamed("num", "estimate"), list(period), "full")
    close = F.abs(F.col("estimate") - F.col("num")) <= F.col("num") * error + 1
    return both.select(*period, "num", close.alias("close"))
