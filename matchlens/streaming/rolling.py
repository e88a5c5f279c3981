"""Rolling win rates on a stream: each result with the last ``size`` results of its key, over micro-batches.

A micro-batch is numbered and rolled by the batch operator. What is carried over are the last ``size - 1`` results
of each key with their positions; they go to the blocks that the new results fall into, so no key is rolled in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from matchlens import schema as S
from matchlens.operators import sequence
from matchlens.session import delete_path, new_folder, stage
from matchlens.sinks.tables import Snapshots

HISTORY = "hero_id int, position bigint, win int"


def history(spark: SparkSession, root: str) -> Snapshots:
    """The last results of each hero."""
    return Snapshots(spark, f"{root}/history", HISTORY)


def roll_batch(batch: DataFrame, batch_id: int, root: str, size: int = S.HERO_WINDOW, block: int = 100_000) -> None:
    """Write the rolling win rate after every hero result of this micro-batch, and carry the newest results on.

    Inside a micro-batch results are in time order, across micro-batches in order of arrival. A repeated batch reads the
    history of the batch before it and replaces its own rows.
    """
    spark = batch.sparkSession
    folder = new_folder(spark, "rolling")
    try:
        carried = history(spark, root)
        before = carried.before(batch_id)
        rows = sequence.HERO.rows(sequence.chunk_matches(batch, folder=folder))
        columns = ("hero_id", "match_id", "slot", "position", "win", "wins", "played", "win_rate")
        rolled = sequence.rolling_win_rate(rows, ["hero_id"], size, block, before).select(*columns)
        new = stage(rolled, "rolled", folder)
        new.drop("win").write.mode("overwrite").parquet(f"{root}/rolling/batch={batch_id}")
        last = Window.partitionBy("hero_id").orderBy(F.desc("position"))
        both = before.unionByName(new.select("hero_id", "position", F.col("win").cast("int").alias("win")))
        # One row at least, which tells where the numbering goes on.
        newest = both.withColumn("_rank", F.row_number().over(last)).where(F.col("_rank") <= max(size - 1, 1)).drop("_rank")
        carried.write(newest, batch_id)
    finally:
        delete_path(spark, folder)


def rolling_writer(matches: DataFrame, root: str, checkpoint: str, size: int = S.HERO_WINDOW) -> DataStreamWriter:
    """Streaming query over valid matches; results go to ``rolling`` below ``root``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        roll_batch(batch, batch_id, root, size)

    return matches.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
