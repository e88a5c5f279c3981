"""One match row to its hero, pair, counter, player and cluster rows.

All expansions happen inside the row (explode over a fixed list of positions), so none of them
shuffles and all of them run unchanged on streams. Input matches must be valid: ten players,
ordered by slot, the first five on the first side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens import schema as S
from matchlens.functions.columns import date_parts, join_ids, utc_date, win_of
from matchlens.operators.validate import public_accounts

_SIDES = (range(S.TEAM_SIZE), range(S.TEAM_SIZE, S.MATCH_PLAYERS))


def _positions(pairs: Sequence[tuple[int, int]]) -> Column:
    """Explode over a constant list of position pairs; folded to a literal by the optimizer."""
    structs = ", ".join(f"named_struct('slot1', {i}, 'slot2', {j})" for i, j in pairs)
    return F.expr(f"explode(array({structs}))").alias("p")


def _hero_at(slot: str) -> Column:
    return F.get(F.col("players"), F.col(slot))["hero_id"]


def hero_results(matches: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Ten rows per match: hero and whether it won."""
    return matches.select(
        "match_id", "start_time", "radiant_win", *keep, F.posexplode("players").alias("slot", "player")
    ).select(
        "match_id",
        "start_time",
        "slot",
        F.col("player.hero_id").alias("hero_id"),
        win_of(F.col("slot"), F.col("radiant_win")).alias("win"),
        *keep,
    )


def _two_hero_rows(matches: DataFrame, pairs: Sequence[tuple[int, int]], keep: Sequence[str]) -> DataFrame:
    return matches.select("match_id", "start_time", "radiant_win", "players", *keep, _positions(pairs)).select(
        "match_id",
        "start_time",
        F.col("p.slot1").alias("slot1"),
        F.col("p.slot2").alias("slot2"),
        _hero_at("p.slot1").alias("hero_id1"),
        _hero_at("p.slot2").alias("hero_id2"),
        win_of(F.col("p.slot1"), F.col("radiant_win")).alias("win"),
        *keep,
    )


def hero_pairs(matches: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Forty rows per match: two heroes of one side, in both orders."""
    pairs = [(i, j) for side in _SIDES for i in side for j in side if i != j]
    return _two_hero_rows(matches, pairs, keep)


def hero_pairs_once(matches: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Twenty rows per match: two heroes of one side, first slot before second."""
    pairs = [(i, j) for side in _SIDES for i in side for j in side if i < j]
    return _two_hero_rows(matches, pairs, keep)


def hero_counters(matches: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Fifty rows per match: two heroes of opposite sides, in both orders; the first one's win."""
    pairs = [p for i in _SIDES[0] for j in _SIDES[1] for p in ((i, j), (j, i))]
    return _two_hero_rows(matches, pairs, keep)


def hero_counters_once(matches: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Twenty-five rows per match: first-side hero against second-side hero."""
    pairs = [(i, j) for i in _SIDES[0] for j in _SIDES[1]]
    return _two_hero_rows(matches, pairs, keep)


def pair_key(pairs: DataFrame) -> DataFrame:
    """Adds the text key ``hero_id1,hero_id2`` used in messages."""
    return pairs.withColumn("pair_key", join_ids(F.col("hero_id1"), F.col("hero_id2")))


def cluster_info(matches: DataFrame) -> DataFrame:
    """One row per match: server cluster, time and the ten players who joined."""
    return matches.select(
        F.col("cluster").alias("cluster_id"), "start_time", F.lit(S.MATCH_PLAYERS).cast("bigint").alias("players")
    )


def player_results(matches: DataFrame) -> DataFrame:
    """Up to ten rows per match: the public accounts with their hero and result."""
    exploded = matches.select(
        "match_id", "start_time", "duration", "radiant_win", F.posexplode("players").alias("slot", "player")
    )
    rows = exploded.select(
        F.col("player.account_id").alias("account_id"),
        "start_time",
        "duration",
        F.col("player.hero_id").alias("hero_id"),
        win_of(F.col("slot"), F.col("radiant_win")).cast("boolean").alias("win"),
        "match_id",
        "slot",
    )
    return public_accounts(rows)


def player_match_rows(matches: DataFrame) -> DataFrame:
    """Rows of the ``player_match`` table, plus ``match_id`` and ``slot`` to order equal keys.

    The stored ``start_time`` is in milliseconds, unlike the seconds of a match.
    """
    millis = (F.col("start_time") * 1000).alias("start_time")
    return player_results(matches).select(
        "account_id", *date_parts(utc_date()), millis, "duration", "hero_id", "win", "match_id", "slot"
    )


def daily_player_rows(matches: DataFrame) -> DataFrame:
    """Rows of the ``daily_player`` table: the same facts, date first."""
    time = F.col("start_time").alias("time_")
    return player_match_rows(matches).select(
        "year", "month", "day", "account_id", time, "hero_id", "duration", "match_id", "slot"
    )


def match_simple(matches: DataFrame, compat: bool = False) -> DataFrame:
    """One text per match: ten hero ids, the first side's win flag and the start in milliseconds.

    ``compat`` glues the flag and the timestamp together, as the message consumers of the older
    format expect.
    """
    heroes = F.concat_ws(" ", F.transform("players", lambda p: p["hero_id"].cast("string")))
    win = F.col("radiant_win").cast("int").cast("string")
    millis = (F.col("start_time") * 1000).cast("string")
    tail = F.concat(win, millis) if compat else F.concat_ws(" ", win, millis)
    return matches.select("match_id", F.concat_ws(" ", heroes, tail).alias("value"))
