"""Matches derived from a click-event log: every ten consecutive events form one match.

Lets all match operators run on ``events`` tables. The event at position ``event_id % 10`` plays
that slot; its JSON property ``k`` picks the hero, its user is the account (user 0 is private),
and the summed event values of the two sides decide the winner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens import schema as S


# Seconds since 1970 of a timestamp without zone, taken as UTC whatever the session zone is.
EPOCH_SECONDS = "unix_date(CAST(ts AS DATE)) * 86400L + hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
# The number k of the properties. The usual flat text is matched directly; any other one is parsed.
PROPERTY_K = """coalesce(
    TRY_CAST(regexp_extract(props, r'^[{]"k": ([0-9]{1,9})[}]$', 1) AS INT),
    CAST(get_json_object(props, '$.k') AS INT))"""
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def read_event_matches(spark: SparkSession, folder: str) -> DataFrame:
    return matches_from_events(read_events(spark, folder))


def matches_from_events(events: DataFrame) -> DataFrame:
    """One row per match.

    All aggregates are fixed-width numbers per slot, so map tasks combine the ten events of a match
    before the shuffle and no group is ever collected into a list.
    """
    rows = events.selectExpr(
        "event_id div 10 AS match_id",
        "CAST(event_id % 10 AS INT) AS slot",
        f"{PROPERTY_K} % 20 AS hero_id",
        f"CASE WHEN user_id = 0 THEN {S.PRIVATE_ACCOUNT} ELSE user_id END AS account_id",
        "CAST(round(value * 100) AS BIGINT) AS cents",
        f"{EPOCH_SECONDS} AS second",
    )
    slots = range(S.MATCH_PLAYERS)
    heroes = [F.expr(f"max(hero_id) FILTER (WHERE slot = {i}) AS hero_{i}") for i in slots]
    accounts = [F.expr(f"max(account_id) FILTER (WHERE slot = {i}) AS account_{i}") for i in slots]
    grouped = rows.groupBy("match_id").agg(
        F.min("second").alias("start_time"),
        F.max("cents").alias("top_cents"),
        F.expr(f"sum(cents) FILTER (WHERE slot < {S.TEAM_SIZE}) AS first_side"),
        F.expr(f"sum(cents) FILTER (WHERE slot >= {S.TEAM_SIZE}) AS second_side"),
        *heroes,
        *accounts,
    )
    player_slots = [i if i < S.TEAM_SIZE else 123 + i for i in slots]
    structs = [
        f"named_struct('account_id', account_{i}, 'player_slot', {player_slots[i]}, 'hero_id', hero_{i})" for i in slots
    ]
    players = f"array({', '.join(structs)})"
    complete = " AND ".join(f"hero_{i} IS NOT NULL" for i in slots)
    present = f"CASE WHEN {complete} THEN {players} ELSE filter({players}, p -> p.hero_id IS NOT NULL) END"
    return grouped.selectExpr(
        "match_id",
        "match_id AS match_seq_num",
        "first_side >= second_side AS radiant_win",
        "start_time",
        "CAST(600 + top_cents % 2400 AS INT) AS duration",
        "CAST(110 + match_id % 130 AS INT) AS cluster",
        "CASE WHEN match_id % 17 = 0 THEN 9 ELSE 10 END AS human_players",
        "CASE WHEN match_id % 13 = 0 THEN 4 ELSE 22 END AS game_mode",
        f"{present} AS players",
    )
