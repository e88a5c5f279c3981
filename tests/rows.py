"""Hand-made matches."""

from __future__ import annotations

from matchlens import schema as S

SLOTS = [0, 1, 2, 3, 4, 128, 129, 130, 131, 132]
DAY = 86400
START = 1704067200  # 2024-01-01 00:00:00 UTC


def players(heroes=None, accounts=None):
    heroes = heroes or list(range(1, 11))
    accounts = accounts or [1000 + i for i in range(10)]
    return [(a, slot, h) for a, slot, h in zip(accounts, SLOTS, heroes)]


def match(match_id=1, win=True, start=START, duration=1800, cluster=155, humans=10, mode=22, team=None):
    return (match_id, win, start, duration, cluster, humans, mode, team if team is not None else players())


MATCH_DDL = (
    "match_id bigint, radiant_win boolean, start_time bigint, duration int, cluster int, human_players int, "
    "game_mode int, players array<struct<account_id:bigint,player_slot:int,hero_id:int>>"
)


def frame(spark, *matches):
    return spark.createDataFrame(list(matches), MATCH_DDL)


def bare_text(match_id=1, win="t", start=START, duration=1800, humans=10, mode=22, cluster=155, team=None):
    """A message in the quote-less spelling."""
    team = team if team is not None else players()
    body = ", ".join(f"{{account_id:{a},hero_id:{h},player_slot:{s}}}" for a, s, h in team)
    return (
        f"{{pre_game_duration: 90, flags: 1, match_id: {match_id}, match_seq_num: {match_id}, radiant_win: {win}, "
        f"start_time: {start}, duration: {duration}, cluster: {cluster}, human_players: {humans}, "
        f"game_mode: {mode}, engine: 1, players: [{body}]}}"
    )


__all__ = ["DAY", "MATCH_DDL", "S", "SLOTS", "START", "bare_text", "frame", "match", "players"]
