"""Record types, table keys and fixed domain values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the data model.
PRIVATE_ACCOUNT = 4294967295
TEAM_SIZE = 5
MATCH_PLAYERS = 10
MIN_DURATION = 1000
GAME_MODES = (1, 2, 3, 5, 16, 22)
HERO_WINDOW = 100
PAIR_WINDOW = 25
SKETCH_BITS = 12
MATCH_DELAY = "90 minutes"
REGION_DELAY = "10 minutes"
HERO_TOPIC = "hero-win-rate"
PAIR_TOPIC = "hero-pair-win-rate"
COUNTER_TOPIC = "hero-counter-pair-win-rate"
SIMPLE_TOPIC = "match-simple"
# Parts of a comma-separated win-rate message, by topic.
MESSAGE_PARTS = {HERO_TOPIC: 2, PAIR_TOPIC: 3, COUNTER_TOPIC: 4}


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """A struct from ``name type, name type`` text; needs no session, unlike a DDL string."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PLAYER = _struct("account_id bigint, player_slot int, hero_id int")

# The 18 kept columns of a dump line, in file order; radiant_win is 't' or 'f' there.
DUMP_COLUMNS = _struct(
    "match_id bigint, match_seq_num bigint, radiant_win string, start_time bigint, duration int, "
    "tower_status_radiant int, tower_status_dire int, barracks_status_radiant int, "
    "barracks_status_dire int, cluster int, first_blood_time int, lobby_type int, "
    "human_players int, leagueid int, positive_votes int, negative_votes int, game_mode int, engine int"
)
# Columns that follow in the dump but carry nothing used here.
DUMP_IGNORED = (
    "picks_bans",
    "parse_status",
    "chat",
    "objectives",
    "radiant_gold_adv",
    "radiant_xp_adv",
    "teamfights",
    "version",
)
DUMP = T.StructType(
    DUMP_COLUMNS.fields
    + [T.StructField(name, T.StringType()) for name in DUMP_IGNORED]
    + [T.StructField("pgroup", T.StringType())]
)
PLAYER_MAP = T.MapType(T.StringType(), PLAYER)

# A JSON match message: the dump columns, two constants of the message form, and the players.
MESSAGE = T.StructType(
    DUMP_COLUMNS.fields
    + [
        T.StructField("pre_game_duration", T.IntegerType()),
        T.StructField("flags", T.IntegerType()),
        T.StructField("players", T.ArrayType(PLAYER)),
    ]
)

WIN_RATE_MESSAGE = _struct("topic string, value string, ts timestamp")


@dataclass(frozen=True)
class Table:
    """A keyed table: one row per key, stored as Parquet partitioned by date columns."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    partition_by: tuple[str, ...]


def _table(name: str, ddl: str, key: str, partition_by: str) -> Table:
    return Table(name, _struct(ddl), tuple(key.split()), tuple(partition_by.split()))


_TABLES = (
    _table(
        "hero_win_rate",
        "hero_id string, year int, month int, day int, win_rate double, count bigint",
        "hero_id year month day",
        "year month day",
    ),
    _table(
        "region_num_of_players",
        "cluster_id int, year int, month int, day int, num_of_players bigint",
        "year month day cluster_id",
        "year month day",
    ),
    _table(
        "player_match",
        "account_id bigint, year int, month int, day int, start_time bigint, duration int, "
        "hero_id string, win boolean",
        "account_id year month day start_time",
        "year month day",
    ),
    _table(
        "player_daily",
        "account_id bigint, year int, month int, day int, matches_played bigint, matches_won bigint, "
        "time_played_in_sec bigint",
        "account_id year month day",
        "year month day",
    ),
    _table(
        # The same totals with the micro-batch of facts that last changed them, for refreshes by difference.
        "player_totals",
        "account_id bigint, year int, month int, day int, matches_played bigint, matches_won bigint, "
        "time_played_in_sec bigint, batch bigint",
        "account_id year month day",
        "year month day",
    ),
    _table(
        "daily_player",
        "year int, month int, day int, account_id bigint, time_ bigint, hero_id string, duration int",
        "year month day account_id time_",
        "year month day",
    ),
    _table("daily_active_users", "year int, month int, day int, num bigint", "year month day", "year month"),
    _table("monthly_active_users", "year int, month int, num bigint", "year month", "year"),
    _table(
        "daily_user_sketch",
        "year int, month int, day int, sketch binary",
        "year month day",
        "year month",
    ),
    _table(
        "daily_user_bitmap",
        "year int, month int, day int, bucket bigint, users binary",
        "year month day bucket",
        "year month day",
    ),
    _table(
        "processed_dates",
        "job string, year int, month int, day int, batch bigint",
        "job year month day",
        "job",
    ),
)
TABLES: dict[str, Table] = {t.name: t for t in _TABLES}
