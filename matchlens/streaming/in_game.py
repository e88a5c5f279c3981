"""Players in a running match, live: keyed state with event-time timers.

A match adds ten players to its cluster at its start and takes them away at its end. Both changes wait in the
state until the watermark has passed their second, when a timer fires and the change is final. Each cluster is split
into parts by match id, so the state of a hot cluster is spread; parts are added up when the changes are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from matchlens import schema as S
from matchlens.streaming.windows import with_event_time

PARTS = 8
# Seconds whose open changes are one value of the state.
SLICE = 86_400
CHANGES = "cluster_id int, time bigint, delta bigint"
# Timers need a state store that can look states up by time.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"


class PlayerChanges(StatefulProcessor):
    """The open changes of one part of a cluster: of each slice of time one value, its seconds in order with their sums.

    A slice has a timer at its first open second. When it fires, all seconds that the watermark has passed are final, and
    the timer of the others is set. What the state is asked thus depends on the number of slices, not on that of matches.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("slices", "slice bigint", "changes binary")

    def _put(self, part: int, changes: np.ndarray) -> None:
        self.open.updateValue((part,), (changes.tobytes(),))

    def _get(self, part: int) -> np.ndarray:
        """Rows (second, sum) of a slice; none if it is not there."""
        known = self.open.getValue((part,)) if self.open.containsKey((part,)) else None
        return np.frombuffer(bytes(known[0]) if known else b"", np.int64).reshape(-1, 2)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        changes = []
        for batch in rows:
            starts, durations = batch["start_time"].to_numpy(np.int64), batch["duration"].to_numpy(np.int64)
            for times, players in ((starts, S.MATCH_PLAYERS), (starts + durations, -S.MATCH_PLAYERS)):
                changes.append(np.column_stack([times, np.full(len(times), players)]))
        fresh = _summed(np.concatenate(changes))
        parts = fresh[:, 0] // SLICE
        for part in np.unique(parts).tolist():
            known, added = self._get(part), fresh[parts == part]
            self._put(part, _summed(np.concatenate([known, added])))
            if not len(known) or added[0, 0] < known[0, 0]:
                self.handle.registerTimer(int(added[0, 0]) * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        part = expiredTimerInfo.getExpiryTimeInMs() // 1000 // SLICE
        changes = self._get(part)
        final = changes[:, 0] * 1000 <= timerValues.getCurrentWatermarkInMs()
        # An earlier timer of the slice may have taken them.
        if not final.any():
            return
        left = changes[~final]
        if len(left):
            self._put(part, left)
            self.handle.registerTimer(int(left[0, 0]) * 1000)
        else:
            self.open.removeKey((part,))
        times, deltas = changes[final].T
        yield pd.DataFrame({"cluster_id": np.full(len(times), int(key[0])), "time": times, "delta": deltas})


def _summed(changes: np.ndarray) -> np.ndarray:
    """Rows (second, sum) in the order of seconds, each once."""
    times, place = np.unique(changes[:, 0], return_inverse=True)
    sums = np.zeros(len(times), np.int64)
    np.add.at(sums, place, changes[:, 1])
    return np.column_stack([times, sums])


def player_changes(matches: DataFrame, delay: str = S.MATCH_DELAY, parts: int = PARTS) -> DataFrame:
    """(cluster_id, time, delta): final changes of a stream of valid matches, one for each part and second.

    Matches that start before the watermark are too late and dropped, as by windows.
    """
    rows = with_event_time(matches, delay).select(
        F.col("cluster").alias("cluster_id"), F.pmod(F.xxhash64("match_id"), F.lit(parts)).alias("part"), "start_time", "duration", "ts"
    )
    keyed = rows.groupBy("cluster_id", "part")
    return keyed.transformWithStateInPandas(PlayerChanges(), CHANGES, "append", "eventTime")


def players_over_time(changes: DataFrame) -> DataFrame:
    """(cluster_id, time, delta, players) from stored changes: as the batch operator gives, up to the watermark.

    The running total is the sum of earlier days plus the sum inside the day, so a window holds a day of one cluster at most.
    """
    per_second = changes.groupBy("cluster_id", F.floor(F.col("time") / 86_400).alias("day"), "time").agg(F.sum("delta").alias("delta"))
    days = Window.partitionBy("cluster_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    per_day = per_second.groupBy("cluster_id", "day").agg(F.sum("delta").alias("sum"))
    offsets = per_day.select("cluster_id", "day", F.coalesce(F.sum("sum").over(days), F.lit(0)).alias("before"))
    inside = Window.partitionBy("cluster_id", "day").orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    running = per_second.withColumn("within", F.sum("delta").over(inside)).join(offsets, ["cluster_id", "day"])
    return running.select("cluster_id", "time", "delta", (F.col("before") + F.col("within")).alias("players"))


def players_now(changes: DataFrame) -> DataFrame:
    """Players in a running match per cluster at the watermark."""
    return changes.groupBy("cluster_id").agg(F.sum("delta").alias("players"))
