"""Which matches and players count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from matchlens import schema as S


def is_valid(min_duration: int = S.MIN_DURATION) -> Column:
    """Ten humans, long enough, in a rated mode, with exactly ten players listed."""
    return (
        (F.col("human_players") == S.MATCH_PLAYERS)
        & (F.col("duration") >= min_duration)
        & F.col("game_mode").isin(*S.GAME_MODES)
        & (F.size("players") == S.MATCH_PLAYERS)
    )


def valid_matches(matches: DataFrame, min_duration: int = S.MIN_DURATION) -> DataFrame:
    return matches.where(is_valid(min_duration))


def drop_malformed(parsed: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    """Drop rows without a match id, counting them when an observation is given.

    The counts come out as ``malformed`` and ``total``, from the same pass over the data.
    """
    if observation is not None:
        parsed = parsed.observe(observation, *parse_counts())
    return parsed.where(~F.col("match_id").isNull())


def parse_counts() -> list[Column]:
    """Aggregates over parsed rows: those without a match id, and all."""
    return [F.count_if(F.col("match_id").isNull()).alias("malformed"), F.count(F.lit(1)).alias("total")]


def public_accounts(player_rows: DataFrame) -> DataFrame:
    """Player rows without the marker account shared by all private players."""
    return player_rows.where(F.col("account_id") != S.PRIVATE_ACCOUNT)
