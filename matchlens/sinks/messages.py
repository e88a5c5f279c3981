"""Win-rate messages and their outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from matchlens import schema as S
from matchlens.functions.columns import event_time, join_ids, rate_text


def win_rate_messages(windows: DataFrame) -> DataFrame:
    """``topic``, ``value`` and ``ts`` of finished windows, such as ``12,0.530`` or ``counter,1,2,0.480``."""
    pair = join_ids(F.col("hero_id1"), F.col("hero_id2"))
    key = (
        F.when(F.col("topic") == S.HERO_TOPIC, F.col("hero_id1").cast("string"))
        .when(F.col("topic") == S.PAIR_TOPIC, pair)
        .otherwise(F.concat(F.lit("counter,"), pair))
    )
    value = F.concat_ws(",", key, rate_text(F.col("win_rate")))
    return windows.select("topic", value.alias("value"), event_time("latest").alias("ts"))


def write_kafka(messages: DataFrame, servers: str) -> None:
    """Send a batch of messages to the topics named in its rows. Needs the Kafka connector."""
    columns = [F.col("value")] + [F.col("topic")] * ("topic" in messages.columns)
    messages.select(*columns).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def kafka_sender(servers: str) -> Callable[[DataFrame, int], None]:
    """Sends the messages of a micro-batch to Kafka; a repeated micro-batch sends them again."""

    def send(messages: DataFrame, batch_id: int) -> None:
        write_kafka(messages, servers)

    return send


def kafka_stream_writer(values: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """A streaming writer of ``value`` texts to one topic. Needs the Kafka connector."""
    writer = values.select("value").writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("topic", topic).option("checkpointLocation", checkpoint)


def text_stream_writer(values: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    writer = values.select("value").writeStream.format("text").option("path", path)
    return writer.option("checkpointLocation", checkpoint).outputMode("append")


def console_writer(rows: DataFrame, checkpoint: str, lines: int = 20) -> DataStreamWriter:
    """Print some rows of every micro-batch, for debugging."""
    writer = rows.writeStream.format("console").option("numRows", lines).option("truncate", "false")
    return writer.option("checkpointLocation", checkpoint)
