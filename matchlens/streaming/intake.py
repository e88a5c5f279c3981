"""One reading of the message source for all outputs, and a table of what was rejected.

The intake query parses each line once. Every micro-batch writes the valid matches to a log, which the stateful queries
stream from, and the outputs without state; what no output counts goes to the reject table with its raw text:

* ``malformed``: the text is not a match;
* ``late for heroes``, ``late for clusters``: the match's day was closed for these windows when it came.

A day is closed once the watermark, the latest start of all earlier micro-batches less the delay, has passed its end. The
rule is applied here, before the windows would drop the row unseen. Spark's windows alone may take such a match for one more
micro-batch, as they filter by the watermark before the newest one. The log is read in the order in which it was written, so the
watermarks of its readers are never ahead of the intake's, and they drop nothing more: the reject table holds all late
matches, each with the micro-batch it came in, through any number of restarts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from matchlens import schema as S
from matchlens.operators.expand import daily_player_rows, match_simple, player_match_rows
from matchlens.operators.keyed import newest_rows
from matchlens.operators.validate import drop_malformed, is_valid, parse_counts
from matchlens.session import delete_path, move_path, path_exists
from matchlens.sinks.tables import Snapshots, Tables
from matchlens.sources.messages import parse_matches
from matchlens.streaming.count_windows import count_window_writer
from matchlens.streaming.pipeline import PARSE_COUNTS, table_writer
from matchlens.streaming.windows import (
    cluster_player_windows,
    dedup_replays,
    hero_table_rows,
    hero_win_rate_windows,
    region_table_rows,
    with_event_time,
)

LOG, REJECTS, CLOCK = "matches", "rejects", "clock"
REJECT = "reason string, value string, batch bigint"
DAY_SECONDS = 86_400
LATE = {"late_heroes": "late for heroes", "late_clusters": "late for clusters"}
# Logged files may be read this long after the newest one.
LOG_AGE = "30d"


def is_late(latest: int | None, delay: str) -> Column:
    """Whether the day of a match had been closed by matches up to ``latest`` (seconds; none yet: null)."""
    if latest is None:
        return F.lit(False)
    watermark = F.unix_seconds(F.timestamp_seconds(F.lit(latest)) - F.expr(f"INTERVAL {delay}"))
    return (F.floor(F.col("start_time") / DAY_SECONDS) + 1) * DAY_SECONDS <= watermark


def log_schema(spark: SparkSession) -> T.StructType:
    parsed = parse_matches(spark.createDataFrame([], "value string"))
    return T.StructType([*parsed.schema.fields, *(T.StructField(c, T.BooleanType()) for c in LATE)])


def read_log(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the logged matches, in the order of their micro-batches."""
    reader = spark.readStream.schema(log_schema(spark)).option("maxFileAge", LOG_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(f"{root}/{LOG}/*")


def _write_log(rows: DataFrame, root: str, batch_id: int) -> None:
    """Add a micro-batch to the log by one rename; a repeated batch finds its folder there and leaves it."""
    spark = rows.sparkSession
    target, hidden = f"{root}/{LOG}/{batch_id:012d}", f"{root}/_{LOG}/{batch_id:012d}"
    if path_exists(spark, target):
        return
    rows.write.mode("overwrite").parquet(hidden)
    # Readers of the log take files alone.
    delete_path(spark, f"{hidden}/_SUCCESS")
    move_path(spark, hidden, target)


def intake_writer(
    lines: DataFrame,
    tables: Tables,
    root: str,
    checkpoint: str,
    match_delay: str = S.MATCH_DELAY,
    region_delay: str = S.REGION_DELAY,
) -> DataStreamWriter:
    """The query that reads ``lines`` (value): log, rejects, line counts, simple texts and player tables.

    Every output goes to a folder named by the batch, so a repeated batch replaces its own rows.
    """
    clock = Snapshots(lines.sparkSession, f"{root}/{CLOCK}", "latest bigint")

    def run(parsed: DataFrame, batch_id: int) -> None:
        parsed.persist()
        try:
            before = clock.before(batch_id).first()
            latest = before["latest"] if before else None
            flags = {"late_heroes": is_late(latest, match_delay), "late_clusters": is_late(latest, region_delay)}
            valid = drop_malformed(parsed).where(is_valid()).withColumns(flags)
            reasons = F.array(F.when(F.col("match_id").isNull(), "malformed"), *[F.when(F.col(c), r) for c, r in LATE.items()])
            judged = parsed.withColumns({c: F.when(F.col("match_id").isNotNull() & is_valid(), f) for c, f in flags.items()})
            rejected = judged.select(F.explode(F.array_compact(reasons)).alias("reason"), "value")
            rejected.write.mode("overwrite").parquet(f"{root}/{REJECTS}/batch={batch_id}")
            parsed.agg(*parse_counts()).write.mode("overwrite").json(f"{root}/{PARSE_COUNTS}/batch={batch_id}")
            _write_log(valid.drop("value"), root, batch_id)
            match_simple(valid).select("value").write.mode("overwrite").text(f"{root}/{S.SIMPLE_TOPIC}/batch={batch_id}")
            for name, rows in (("player_match", player_match_rows(valid)), ("daily_player", daily_player_rows(valid))):
                tables.append(name, newest_rows(rows, S.TABLES[name].key, ["match_id", "slot"]), batch_id)
            seen = valid.agg(F.greatest(F.max("start_time"), F.lit(latest).cast("bigint")).alias("latest"))
            clock.write(seen.coalesce(1), batch_id)
        finally:
            parsed.unpersist()

    return parse_matches(lines, "value", "value").writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def stateful_writers(
    log: DataFrame,
    tables: Tables,
    root: str,
    checkpoints: str,
    match_delay: str = S.MATCH_DELAY,
    region_delay: str = S.REGION_DELAY,
    drop_replays: bool = False,
    size: int | None = None,
) -> dict[str, DataStreamWriter]:
    """The queries over the log: hero days, cluster days and count windows. Give them the delays of the intake."""

    def timed(matches: DataFrame, delay: str) -> DataFrame:
        stream = with_event_time(matches, delay)
        return dedup_replays(stream) if drop_replays else stream

    heroes = hero_table_rows(hero_win_rate_windows(timed(log.where("NOT late_heroes"), match_delay)))
    clusters = region_table_rows(cluster_player_windows(timed(log.where("NOT late_clusters"), region_delay)))
    counted = timed(log, match_delay).drop("ts") if drop_replays else log
    return {
        "hero_days": table_writer(heroes, tables, "hero_win_rate", f"{checkpoints}/hero_days"),
        "cluster_days": table_writer(clusters, tables, "region_num_of_players", f"{checkpoints}/cluster_days"),
        "count_windows": count_window_writer(counted.drop(*LATE), f"{root}/live", f"{checkpoints}/count_windows", size=size),
    }


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """``reason``, raw ``value`` and micro-batch of every rejected line, restarts included, each batch once."""
    if not path_exists(spark, f"{root}/{REJECTS}"):
        return spark.createDataFrame([], REJECT)
    return spark.read.schema(REJECT).parquet(f"{root}/{REJECTS}")


def reject_totals(spark: SparkSession, root: str) -> DataFrame:
    """Rejected lines by reason, over all micro-batches so far."""
    return read_rejects(spark, root).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
