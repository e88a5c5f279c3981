"""JSON match messages and win-rate messages, from Kafka or from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlens import schema as S
from matchlens.functions.columns import flag, select_once
from matchlens.sources.dump import sort_players

# Where the JSON reader notes a text that it could not read to the end.
BROKEN = "_broken"


def read_kafka_stream(
    spark: SparkSession, servers: str, topics: str, starting: str = "latest", **options: str
) -> DataFrame:
    """A stream of ``topic``, ``value`` (text) and ``ts``; ``topics`` is a comma-separated list.

    Needs the Kafka connector on the classpath.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topics).option("startingOffsets", starting).options(**options)
    return reader.load().select("topic", F.col("value").cast("string").alias("value"), F.col("timestamp").alias("ts"))


def read_text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of text lines (column ``value``) from files that appear in a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(path)


def read_message_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Win-rate messages (``topic``, ``value``, ``ts``) from JSON files in a folder."""
    reader = spark.readStream.schema(S.WIN_RATE_MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.json(path)


def _readable(text: Column) -> Column:
    """Puts quotes around a bare ``t`` or ``f`` win flag, which no JSON reader accepts."""
    return F.regexp_replace(text, r'(\bradiant_win"?\s*:\s*)([tf])(?=\s*[,}])', '$1"$2"')


def parse_matches(lines: DataFrame, text: str = "value", *keep: str) -> DataFrame:
    """Match columns from JSON text, all NULL when the text is not a match.

    Accepts valid JSON and the quote-less spelling of the message producer. The flag is read as text
    so that ``true``, ``t``, ``"t"`` and ``1`` all work. Of a text that is cut off, Spark's reader returns what came before
    the cut; it is no match unless all its players are there.
    """
    schema = T.StructType([*S.MESSAGE.fields, T.StructField(BROKEN, T.StringType())])
    options = {"allowUnquotedFieldNames": "true", "columnNameOfCorruptRecord": BROKEN}
    parsed = F.from_json(_readable(F.col(text)), schema, options)
    fields = [c for c in S.MESSAGE.fieldNames() if c not in ("match_id", "radiant_win", "players")]
    whole = F.col(f"m.{BROKEN}").isNull() | (F.coalesce(F.size("m.players"), F.lit(0)) == S.MATCH_PLAYERS)
    columns = [
        *[F.col(c) for c in keep],
        F.when(whole, F.col("m.match_id")).alias("match_id"),
        *[F.col(f"m.{c}").alias(c) for c in fields],
        F.coalesce(flag(F.col("m.radiant_win")), F.lit(False)).alias("radiant_win"),
        sort_players(F.col("m.players")).alias("players"),
    ]
    return select_once(lines.select(*keep, parsed.alias("m")), columns)


def parse_win_rate_messages(messages: DataFrame) -> DataFrame:
    """Key and value of each message whose number of parts fits its topic; others are dropped.

    Keys are ``h``, ``a,b`` or ``counter,a,b``; the value is the last part.
    """
    parts = F.split("value", ",")
    expected = F.create_map(*[F.lit(x) for pair in S.MESSAGE_PARTS.items() for x in pair])
    split = messages.select("topic", parts.alias("parts"), "ts").where(
        F.size("parts") == F.try_element_at(expected, F.col("topic"))
    )
    body = F.slice("parts", 1, F.size("parts") - 1)
    counter = F.concat(F.array(F.lit("counter")), F.slice("parts", 2, F.lit(2)))
    key = F.when(F.col("topic") == S.COUNTER_TOPIC, F.concat_ws(",", counter)).otherwise(F.concat_ws(",", body))
    return split.select("topic", key.alias("key"), F.element_at("parts", -1).alias("value"), "ts")
