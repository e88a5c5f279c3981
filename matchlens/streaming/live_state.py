"""Live win rates as the state of a streaming aggregation, read from its checkpoint.

The query keeps the newest value of each message key in Spark's state store and writes nothing else. A dashboard reads
that state with the state data source: no snapshot of all keys is rewritten for each micro-batch, and the values are
those of the last finished micro-batch, also after a restart or while no query runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from matchlens.sources.messages import parse_win_rate_messages


def newest_value_writer(messages: DataFrame, checkpoint: str) -> DataStreamWriter:
    """Keep the newest value of each key of a stream of win-rate messages; ties go to the greatest value."""
    newest = F.max(F.struct("ts", "value")).alias("newest")
    values = parse_win_rate_messages(messages).groupBy("key").agg(newest)
    return values.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)


def read_newest_values(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, value, ts) from the state of that query."""
    state = spark.read.format("statestore").load(checkpoint)
    newest = F.col("value").getField(state.schema["value"].dataType.fieldNames()[0])
    return state.select(F.col("key.key").alias("key"), newest["value"].alias("value"), newest["ts"].alias("ts"))
