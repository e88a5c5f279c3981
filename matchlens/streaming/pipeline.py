"""The live pipeline: one message source, several outputs.

Outputs without state share one query. Each kind of state has its own query, with its own watermark
and checkpoint, so that a slow one holds back no other:

* facts: simple match texts, ``player_match`` and ``daily_player`` rows;
* hero days: ``hero_win_rate``;
* cluster days: ``region_num_of_players``;
* count windows: win-rate messages and live values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from matchlens import schema as S
from matchlens.operators.expand import daily_player_rows, match_simple, player_match_rows
from matchlens.operators.keyed import newest_rows
from matchlens.operators.validate import drop_malformed, parse_counts, valid_matches
from matchlens.sinks.tables import Tables
from matchlens.sources.messages import parse_matches
from matchlens.streaming.count_windows import count_window_writer
from matchlens.streaming.windows import (
    cluster_player_windows,
    dedup_replays,
    hero_table_rows,
    hero_win_rate_windows,
    region_table_rows,
    with_event_time,
)

PARSE_COUNTS = "parse-counts"


def parsed_matches(lines: DataFrame, metrics: str | None = None) -> DataFrame:
    """Valid matches of a stream or batch of texts; the malformed ones are counted as ``metrics``."""
    return valid_matches(drop_malformed(parse_matches(lines), metrics))


def facts_writer(
    parsed: DataFrame, tables: Tables, text_path: str, checkpoint: str, counts_path: str | None = None
) -> DataStreamWriter:
    """Stateless outputs of each micro-batch of parsed lines, from one evaluation of the source.

    Every output goes to a folder named by the batch, so a repeated batch replaces its own rows. With
    ``counts_path`` the numbers of malformed and all lines are kept there for each batch.
    """

    def run(lines: DataFrame, batch_id: int) -> None:
        lines.persist()
        try:
            if counts_path:
                lines.agg(*parse_counts()).write.mode("overwrite").json(f"{counts_path}/batch={batch_id}")
            batch = valid_matches(drop_malformed(lines))
            match_simple(batch).select("value").write.mode("overwrite").text(f"{text_path}/batch={batch_id}")
            for name, rows in (("player_match", player_match_rows(batch)), ("daily_player", daily_player_rows(batch))):
                tables.append(name, newest_rows(rows, S.TABLES[name].key, ["match_id", "slot"]), batch_id)
        finally:
            lines.unpersist()

    return parsed.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def table_writer(rows: DataFrame, tables: Tables, name: str, checkpoint: str) -> DataStreamWriter:
    """Append closed windows to a stream table."""

    def run(batch: DataFrame, batch_id: int) -> None:
        tables.append(name, batch, batch_id)

    return rows.writeStream.outputMode("append").foreachBatch(run).option("checkpointLocation", checkpoint)


def live_writers(
    lines: DataFrame,
    tables: Tables,
    root: str,
    checkpoints: str,
    match_delay: str = S.MATCH_DELAY,
    region_delay: str = S.REGION_DELAY,
    drop_replays: bool = False,
    size: int | None = None,
) -> dict[str, DataStreamWriter]:
    """The four queries of the pipeline, not yet started."""
    matches = parsed_matches(lines)

    def timed(delay: str) -> DataFrame:
        stream = with_event_time(matches, delay)
        return dedup_replays(stream) if drop_replays else stream

    heroes = hero_table_rows(hero_win_rate_windows(timed(match_delay)))
    clusters = region_table_rows(cluster_player_windows(timed(region_delay)))
    counted = timed(match_delay).drop("ts") if drop_replays else matches
    return {
        "facts": facts_writer(
            parse_matches(lines),
            tables,
            f"{root}/{S.SIMPLE_TOPIC}",
            f"{checkpoints}/facts",
            f"{root}/{PARSE_COUNTS}",
        ),
        "hero_days": table_writer(heroes, tables, "hero_win_rate", f"{checkpoints}/hero_days"),
        "cluster_days": table_writer(clusters, tables, "region_num_of_players", f"{checkpoints}/cluster_days"),
        "count_windows": count_window_writer(counted, f"{root}/live", f"{checkpoints}/count_windows", size=size),
    }


def start(writers: dict[str, DataStreamWriter], interval: str | None = "5 seconds") -> list[StreamingQuery]:
    """Start all queries; ``interval=None`` processes what is available now and ends.

    A query restarts from its checkpoint folder with the state and offsets it had.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return [writer.queryName(name).trigger(**trigger).start() for name, writer in writers.items()]


def parse_totals(spark: SparkSession, root: str) -> DataFrame:
    """``malformed`` and ``total`` lines over all micro-batches so far, restarts included, each batch once."""
    counts = spark.read.schema("malformed long, total long").json(f"{root}/{PARSE_COUNTS}")
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("malformed", "total")])
