"""Count windows on a stream: one message for every n-th result of a hero, pair or counter pair.

A keyed Python state function would see all results of a hot hero in one task. Here each micro-batch
is numbered by the distributed sequence operator, and what is carried over per key is only the open
window: games, wins and latest time. That state is one row per key, at most heroes squared, and is
kept as a snapshot beside the output.

Inside a micro-batch results are taken in time order, across micro-batches in order of arrival.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from matchlens.operators.keyed import latest_values
from matchlens.operators.sequence import (
    KINDS,
    WINDOW_KEY,
    WindowKind,
    chunk_matches,
    full_windows,
    keyed_results,
    oriented_windows,
    window_parts,
    with_positions,
)
from matchlens.session import delete_path, new_folder, stage
from matchlens.sinks.messages import win_rate_messages
from matchlens.sinks.tables import Snapshots
from matchlens.sources.messages import parse_win_rate_messages

LIVE_SCHEMA = "key string, value string, ts timestamp"
STATE_SCHEMA = "kind int, lo int, hi int, size bigint, played bigint, wins bigint, latest bigint"
STATE_COLUMNS = [*WINDOW_KEY, "size", "played", "wins", "latest"]


def open_windows(spark: SparkSession, root: str) -> Snapshots:
    """The window that each key has begun but not filled."""
    return Snapshots(spark, f"{root}/state", STATE_SCHEMA)


def live_values(spark: SparkSession, root: str) -> Snapshots:
    """The newest win rate per message key, as the dashboard reads it."""
    return Snapshots(spark, f"{root}/live", LIVE_SCHEMA)


def advance(results: DataFrame, carried: DataFrame) -> DataFrame:
    """All windows touched by a micro-batch, the carried open ones included.

    A carried window is window 0 of its key and shifts the key's numbering by its games.
    """
    before = carried.select(*WINDOW_KEY, F.col("played").alias("before"))
    parts = window_parts(with_positions(results, WINDOW_KEY, before), WINDOW_KEY)
    first = carried.withColumn("window", F.lit(0).cast("bigint"))
    return (
        parts.unionByName(first)
        .groupBy(*WINDOW_KEY, "size", "window")
        .agg(F.sum("wins").alias("wins"), F.sum("played").alias("played"), F.max("latest").alias("latest"))
    )


def process_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    send: Callable[[DataFrame, int], None],
    kinds: Sequence[WindowKind] = KINDS,
    size: int | None = None,
) -> None:
    """Emit the windows that this micro-batch completes and save the open ones.

    Repeating a batch gives the same result: it reads the snapshots of the batch before it.
    """
    spark = batch.sparkSession
    folder = new_folder(spark, "micro-batch")
    try:
        results = keyed_results(chunk_matches(batch, folder=folder), kinds, size)
        state = open_windows(spark, root)
        touched = stage(advance(results, state.before(batch_id)), "windows", folder)
        state.write(touched.where(F.col("played") < F.col("size")).select(*STATE_COLUMNS), batch_id)
        messages = stage(win_rate_messages(oriented_windows(full_windows(touched), kinds)), "messages", folder)
        update_live_values(messages, batch_id, root)
        send(messages, batch_id)
    finally:
        delete_path(spark, folder)


def update_live_values(messages: DataFrame, batch_id: int, root: str) -> None:
    """Replace the live value of every key that a message of this micro-batch names."""
    live = live_values(messages.sparkSession, root)
    fresh = parse_win_rate_messages(messages).select("key", "value", "ts", F.lit(1).alias("fresh"))
    known = live.before(batch_id).withColumn("fresh", F.lit(0))
    live.write(latest_values(known.unionByName(fresh), newest=("fresh", "ts")), batch_id)


def live_value_writer(messages: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """Streaming query that keeps live values from a stream of win-rate messages."""

    def run(batch: DataFrame, batch_id: int) -> None:
        update_live_values(batch, batch_id, root)

    return messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def message_files(path: str) -> Callable[[DataFrame, int], None]:
    """Sends messages to JSON files, one folder per micro-batch."""

    def send(messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").json(f"{path}/batch={batch_id}")

    return send


def count_window_writer(
    matches: DataFrame,
    root: str,
    checkpoint: str,
    send: Callable[[DataFrame, int], None] | None = None,
    kinds: Sequence[WindowKind] = KINDS,
    size: int | None = None,
) -> DataStreamWriter:
    """Streaming query that keeps count windows of valid matches; messages go to ``send``."""
    send = send or message_files(f"{root}/messages")

    def run(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, root, send, kinds, size)

    return matches.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
