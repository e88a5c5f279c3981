"""One row per key: the newest one wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_rows(rows: DataFrame, keys: Sequence[str], newest: Sequence[str | Column]) -> DataFrame:
    """The row of each key that is largest by ``newest``.

    Spark pushes the ``= 1`` filter below the shuffle as a per-task group limit, so a key with many
    versions sends one row per map task.
    """
    order = [F.col(c).desc() if isinstance(c, str) else c for c in newest]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest_values(rows: DataFrame, newest: Sequence[str] = ("ts",)) -> DataFrame:
    """The newest ``value`` of each ``key`` with its time ``ts``, as a plain aggregate.

    ``newest`` lists the deciding columns; the value itself breaks the remaining ties.
    """
    order = F.struct(*newest, "value")
    return rows.groupBy("key").agg(F.max_by("value", order).alias("value"), F.max_by("ts", order).alias("ts"))
