"""The match dump: CSV with a header, 27 columns, the players as a JSON map in the last one.

The crawler writes the same columns, but the players' text without quotes around it and with a comma after the last one.
Columns between the numbers and the players may hold bare JSON too, whose commas would cut a CSV line in the wrong places.
So a line is read from both ends: the 18 plain columns from the front, the map of ten flat objects from the back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchlens import schema as S
from matchlens.functions.columns import flag
from matchlens.operators.validate import drop_malformed, parse_counts

# Parts of a split dump need no header. Header and empty lines are no records.
NO_RECORD = r'^\s*$|^\W*match_id"?,'
PLAYERS = r',"?(\{\s*(?:"{1,2}\d+"{1,2}\s*:\s*\{[^{}]*\}[\s,]*){10}\})"?\s*$'


def read_dump_lines(spark: SparkSession, path: str) -> DataFrame:
    """The records of the dump as numbers, flag text and players' text; columns that no later step uses are not parsed.

    ``pgroup`` is null where the line does not end with ten players.
    """
    lines = spark.read.text(path).where(~F.col("value").rlike(NO_RECORD))
    parts = F.split("value", ",", len(S.DUMP_COLUMNS) + 1)
    text = [F.btrim(F.get(parts, F.lit(i)), F.lit('"')) for i in range(len(S.DUMP_COLUMNS))]
    plain = [t.try_cast(f.dataType).alias(f.name) for t, f in zip(text, S.DUMP_COLUMNS)]
    tail = F.regexp_replace(F.regexp_replace(F.regexp_extract("value", PLAYERS, 1), '""', '"'), r",\s*\}$", "}")
    return lines.select(*plain, F.when(tail != "", tail).alias("pgroup"))


def players_of(pgroup: Column) -> Column:
    """The slot map text as an array of players in slot order.

    Slots 0-4 (first side) sort before 128-132 (second side), so list position tells the side.
    """
    players = F.map_values(F.from_json(pgroup, S.PLAYER_MAP))
    return sort_players(players)


def sort_players(players: Column) -> Column:
    """Players ordered by slot, missing numbers as zero."""

    def slot_first(p: Column) -> Column:
        return F.struct(
            F.coalesce(p["player_slot"], F.lit(0)).alias("player_slot"),
            F.coalesce(p["account_id"], F.lit(0)).alias("account_id"),
            F.coalesce(p["hero_id"], F.lit(0)).alias("hero_id"),
        )

    def in_order_of_type(p: Column) -> Column:
        return F.struct(*[p[name].alias(name) for name in S.PLAYER.fieldNames()])

    return F.transform(F.array_sort(F.transform(players, slot_first)), in_order_of_type)


def _typed(lines: DataFrame) -> DataFrame:
    """All records; ``match_id`` is null where the line is not a match with exactly ten players.

    The players go through ``explode`` so that the filters above do not parse the map again; the other
    columns can still be pruned from the scan.
    """
    columns = [c for c in S.DUMP_COLUMNS.fieldNames() if c not in ("match_id", "radiant_win")]
    typed = lines.select(
        "match_id",
        *columns,
        F.coalesce(flag(F.col("radiant_win")), F.lit(False)).alias("radiant_win"),
        F.explode(F.array(players_of(F.col("pgroup")))).alias("players"),
    )
    return typed.withColumn("match_id", F.when(F.size("players") == S.MATCH_PLAYERS, F.col("match_id")))


def matches_from_dump(lines: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    """Typed matches; lines that are none are dropped, and counted when an observation is given."""
    return drop_malformed(_typed(lines), observation)


def dump_totals(spark: SparkSession, path: str) -> DataFrame:
    """``malformed`` and ``total`` records of a dump, as ``parse_totals`` has them for streams."""
    return _typed(read_dump_lines(spark, path)).agg(*parse_counts())


def read_dump(spark: SparkSession, path: str, observation: Observation | str | None = None) -> DataFrame:
    return matches_from_dump(read_dump_lines(spark, path), observation)
