"""Match exports: simple text, message JSON, dump-layout CSV, and files of limited length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens import schema as S


def _or_null(df: DataFrame, field) -> Column:
    """The column, or NULL of its type when the matches do not carry it."""
    source = F.col(field.name) if field.name in df.columns else F.lit(None)
    return source.cast(field.dataType).alias(field.name)


def to_message_json(matches: DataFrame) -> DataFrame:
    """One JSON text per match (column ``value``), as valid JSON in the layout of the match API.

    The two fields that a dump lacks get their usual constants.
    """
    fields = [
        F.col("radiant_win").alias("radiant_win") if f.name == "radiant_win" else _or_null(matches, f)
        for f in S.DUMP_COLUMNS.fields
    ]
    record = F.struct(F.lit(90).alias("pre_game_duration"), F.lit(1).alias("flags"), *fields, F.col("players"))
    return matches.select(F.to_json(record).alias("value"))


def to_bare_json(messages: DataFrame) -> DataFrame:
    """The quote-less spelling of message texts, with ``t`` and ``f`` for the flag."""
    bare = F.regexp_replace("value", r'["\\]', "")
    return messages.select(F.regexp_replace(bare, r"radiant_win:(t|f)\w+", "radiant_win:$1").alias("value"))


def to_dump_rows(matches: DataFrame) -> DataFrame:
    """Matches in the dump's 27 columns."""
    by_slot = F.map_from_entries(
        F.transform("players", lambda p: F.struct(p["player_slot"].cast("string").alias("key"), p.alias("value")))
    )
    flag = F.when(F.col("radiant_win"), "t").otherwise("f").alias("radiant_win")
    kept = [flag if f.name == "radiant_win" else _or_null(matches, f) for f in S.DUMP_COLUMNS.fields]
    return matches.select(
        *kept, *[F.lit(None).cast("string").alias(c) for c in S.DUMP_IGNORED], F.to_json(by_slot).alias("pgroup")
    )


def write_dump(matches: DataFrame, path: str, lines_per_file: int | None = None) -> None:
    """Dump-layout CSV with a header; ``lines_per_file`` splits it into files of at most that length."""
    writer = to_dump_rows(matches).write.option("header", True).option("quote", '"').option("escape", '"')
    if lines_per_file:
        writer = writer.option("maxRecordsPerFile", lines_per_file)
    writer.csv(path)


def to_crawler_lines(matches: DataFrame) -> DataFrame:
    """Matches as the crawler's lines (column ``value``): bare players' text, a comma after each player, an empty line."""
    player = '""%d"":{""account_id"":%d,""hero_id"":%d,""player_slot"":%d},'
    texts = F.transform("players", lambda p: F.format_string(player, p["player_slot"], p["account_id"], p["hero_id"], p["player_slot"]))
    flag = F.when(F.col("radiant_win"), "True").otherwise("False")
    kept = [flag if f.name == "radiant_win" else F.coalesce(_or_null(matches, f).cast("string"), F.lit("None")) for f in S.DUMP_COLUMNS.fields]
    empty = [F.lit("") for _ in S.DUMP_IGNORED]
    group = F.concat(F.lit("{"), F.concat_ws("", texts), F.lit("}\n"))
    return matches.select(F.concat_ws(",", *kept, *empty, group).alias("value"))


def split_text(lines: DataFrame, path: str, lines_per_file: int) -> None:
    """Rewrite text lines as files of at most ``lines_per_file`` lines."""
    lines.write.option("maxRecordsPerFile", lines_per_file).text(path)
