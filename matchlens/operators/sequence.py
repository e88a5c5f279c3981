"""Exact row sequences per key at scale: count windows and rolling windows.

"The n-th result of a hero" needs a running number per key. A plain ``row_number`` would sort all
rows of a hot hero in one task. Here the *matches* are range-partitioned by time once into chunks of
even size; every key then spans many chunks, and the running number is the key's count in earlier
chunks (a small table) plus the number inside the chunk. No task ever holds more of a key than one
chunk, and equal rows (replayed matches) are collapsed into one row with a weight first, so that
they cannot fill a chunk either.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlens import schema as S
from matchlens.operators.expand import hero_counters_once, hero_pairs_once, hero_results
from matchlens.session import stage

# Equal matches become weighted rows of at most this many copies, so that rows weigh about the same.
COPIES_PER_PIECE = 10
# A match with more copies is first cut into blocks that different tasks turn into pieces.
COPIES_PER_BLOCK = 1_000_000
CHUNK_COLUMNS = ("chunk", "seq", "copies")
# Order of result rows: the match's number, then the turn inside the match.
ORDER = ("seq", "turn")


def chunk_matches(matches: DataFrame, chunks: int | None = None, folder: str | None = None) -> DataFrame:
    """Matches reduced to what windows need, ordered by start time and match id.

    Adds ``chunk`` (rising with time), ``seq`` (rising with the order of matches) and ``copies`` (how
    many equal matches a row stands for). Written once to the shared folder: chunks come from sampled
    range bounds and must be the same for every later read. ``chunks`` defaults to
    ``spark.sql.shuffle.partitions``.
    """
    spark = matches.sparkSession
    chunks = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_time = ["start_time", "match_id", "content", "block", "piece"]
    ordered = _weighted_matches(matches).repartitionByRange(chunks, *by_time).sortWithinPartitions(*by_time)
    numbered = ordered.drop("content", "block", "piece").withColumn("chunk", F.spark_partition_id())
    return stage(numbered.withColumn("seq", F.monotonically_increasing_id()), "chunks", folder)


def _weighted_matches(matches: DataFrame) -> DataFrame:
    """Distinct matches with ``copies``, numbered by ``block`` and ``piece`` where there are many.

    Counting combines copies in map tasks. The numbers let range partitioning spread the copies of
    one match over several chunks.
    """
    heroes = F.transform("players", lambda p: F.struct(p["hero_id"].alias("hero_id")))
    columns = ["match_id", "start_time", "radiant_win", "players"]
    counted = matches.withColumn("players", heroes).groupBy(*columns).agg(F.count(F.lit(1)).alias("total"))
    counted = counted.withColumn("content", F.xxhash64("radiant_win", "players"))
    few = counted.where(F.col("total") <= COPIES_PER_BLOCK).withColumn("block", F.lit(0).cast("bigint"))
    many = counted.where(F.col("total") > COPIES_PER_BLOCK)
    blocks = many.withColumn("block", _numbers(F.col("total"), COPIES_PER_BLOCK)).repartition("match_id", "block")
    in_block = _part(F.col("total"), F.col("block"), COPIES_PER_BLOCK)
    pieces = few.unionByName(blocks).withColumn("total", in_block)
    pieces = pieces.withColumn("piece", _numbers(F.col("total"), COPIES_PER_PIECE))
    return pieces.withColumn("copies", _part(F.col("total"), F.col("piece"), COPIES_PER_PIECE)).drop("total")


def _numbers(total: Column, size: int) -> Column:
    """One row for each part of at most ``size``: 0, 1, ..."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), _div(total - 1, F.lit(size))))


def _part(total: Column, number: Column, size: int) -> Column:
    """The size of one of these parts."""
    return F.least(F.lit(size).cast("bigint"), total - number * size)


def with_positions(rows: DataFrame, keys: Sequence[str], before: DataFrame | None = None) -> DataFrame:
    """Adds ``position``: the running number per key of the last copy that a row stands for.

    ``rows`` carries ``chunk`` and ``copies``; ``before`` (keys, ``before``) shifts the start of a
    key. The window sorts by key, chunk and order, and the merge join with the chunk offsets reuses
    that partitioning and order, so the expanded rows are shuffled and sorted once. The join is asked for by name:
    Spark knows the rows by the size of their matches before these are expanded, and would broadcast them.
    """
    counts = rows.groupBy(*keys, "chunk").agg(F.sum("copies").alias("_count"))
    earlier = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "chunk", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_offset"))
    if before is not None:
        shifted = offsets.join(before, list(keys), "left")
        offsets = shifted.select(
            *keys, "chunk", (F.col("_offset") + F.coalesce("before", F.lit(0))).alias("_offset")
        )
    inside = Window.partitionBy(*keys, "chunk").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_local", F.sum("copies").over(inside))
    joined = local.join(offsets.hint("merge"), [*keys, "chunk"])
    return joined.withColumn("position", F.col("_offset") + F.col("_local")).drop("_offset", "_local", "chunk")


def window_parts(positioned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Wins, games and latest time of every count window (number ``window``), full or not.

    The window length is the column ``size``, constant per key. A weighted row may reach over several
    windows and adds its share to each.
    """
    end, copies, size = F.col("position"), F.col("copies"), F.col("size")
    spread = F.sequence(_div(end - copies, size), _div(end - 1, size))
    overlap = F.least(end, (F.col("window") + 1) * size) - F.greatest(end - copies, F.col("window") * size)
    columns = [*keys, "size", "win", "start_time", "position", "copies"]
    pieces = positioned.select(*columns, F.explode(spread).alias("window"))
    return (
        pieces.withColumn("n", overlap)
        .groupBy(*keys, "size", "window")
        .agg(
            F.sum(F.col("win") * F.col("n")).alias("wins"),
            F.sum("n").alias("played"),
            F.max("start_time").alias("latest"),
        )
    )


def full_windows(parts: DataFrame) -> DataFrame:
    """Only windows that reached their size; the rest of a key has not been emitted yet."""
    return parts.where(F.col("played") == F.col("size"))


def rolling_win_rate(
    rows: DataFrame, keys: Sequence[str], size: int, block: int = 100_000, history: DataFrame | None = None
) -> DataFrame:
    """After every result of a key, the win rate over its last ``size`` results.

    Positions are cut into blocks; the last ``size - 1`` rows of a block are also sent to the next one
    as history. A task's group is thus at most ``block + size`` rows. ``history`` (keys, position, win) holds the last
    results before ``rows``; they count, but have no result of their own.
    """
    block = max(block, size)
    before = history.groupBy(*keys).agg(F.max("position").alias("before")) if history is not None else None
    positioned = with_positions(rows, keys, before)
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    single = positioned.withColumn("_copy", copy).withColumn(
        "position", F.col("position") - F.col("copies") + F.col("_copy")
    )
    single = single.withColumn("_earlier", F.lit(False))
    if history is not None:
        earlier = history.select(*keys, "position", "win", F.lit(True).alias("_earlier"))
        single = single.unionByName(earlier, allowMissingColumns=True)
    own = _div(F.col("position") - 1, F.lit(block))
    is_history = F.col("position") > (own + 1) * block - (size - 1)
    targets = F.when(is_history, F.array(own, own + 1)).otherwise(F.array(own))
    spread = single.select("*", own.alias("_own"), F.explode(targets).alias("_block"))
    last = Window.partitionBy(*keys, "_block").orderBy("position").rowsBetween(-(size - 1), 0)
    return (
        spread.withColumn("wins", F.sum("win").over(last))
        .withColumn("played", F.count(F.lit(1)).over(last))
        .where((F.col("_own") == F.col("_block")) & ~F.col("_earlier"))
        .withColumn("win_rate", F.col("wins") / F.col("played"))
        .drop("_own", "_block", "_copy", "_earlier", "seq", "turn", "copies")
    )


def _div(value: Column, divisor: Column) -> Column:
    return F.call_function("div", value, divisor.cast("bigint"))


@dataclass(frozen=True)
class WindowKind:
    """One family of count windows.

    ``rows`` gives results keyed by ``lo`` and ``hi``, with ``turn`` for their order in a match.
    ``opposed`` tells that one of the two wins, so that key (hi, lo) wins what (lo, hi) loses.
    """

    code: int
    topic: str
    size: int
    rows: Callable[[DataFrame], DataFrame]
    opposed: bool

    def windows(self, chunked: DataFrame, size: int | None = None) -> DataFrame:
        """Full count windows of chunked matches, one row for every ``size`` results of a key."""
        windows = all_windows(chunked, (self,), size).drop("topic")
        if self is HERO:
            return windows.drop("hero_id2").withColumnRenamed("hero_id1", "hero_id")
        return windows


def _hero_rows(chunked: DataFrame) -> DataFrame:
    rows = hero_results(chunked, CHUNK_COLUMNS)
    return rows.select("*", F.col("hero_id").alias("lo"), F.col("hero_id").alias("hi"), F.col("slot").alias("turn"))


def _low_high(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("lo", F.least("hero_id1", "hero_id2")).withColumn("hi", F.greatest("hero_id1", "hero_id2"))


def _pair_rows(chunked: DataFrame) -> DataFrame:
    """Each pair of one side once; the reverse order has the same windows.

    A hero paired with itself stands for both orders, hence for two results.
    """
    twice = F.when(F.col("lo") == F.col("hi"), F.col("copies") * 2).otherwise(F.col("copies"))
    rows = _low_high(hero_pairs_once(chunked, CHUNK_COLUMNS)).withColumn("copies", twice)
    return rows.withColumn("turn", F.col("slot1") * S.MATCH_PLAYERS + F.col("slot2"))


def _counter_rows(chunked: DataFrame) -> DataFrame:
    """Each meeting once, as a result of the smaller hero id; a hero against itself wins and loses."""
    low_win = F.when(F.col("hero_id1") < F.col("hero_id2"), F.col("win")).otherwise(1 - F.col("win"))
    results = F.when(F.col("lo") == F.col("hi"), F.array("win", 1 - F.col("win"))).otherwise(F.array(low_win))
    rows = _low_high(hero_counters_once(chunked, CHUNK_COLUMNS))
    meeting = F.col("slot1") * S.MATCH_PLAYERS + F.col("slot2")
    both = rows.select("*", F.posexplode(results).alias("side", "result"))
    return both.withColumn("win", F.col("result")).withColumn("turn", meeting * 2 + F.col("side"))


HERO = WindowKind(0, S.HERO_TOPIC, S.HERO_WINDOW, _hero_rows, False)
PAIR = WindowKind(1, S.PAIR_TOPIC, S.PAIR_WINDOW, _pair_rows, False)
COUNTER = WindowKind(2, S.COUNTER_TOPIC, S.PAIR_WINDOW, _counter_rows, True)
KINDS = (HERO, PAIR, COUNTER)
WINDOW_KEY = ("kind", "lo", "hi")


def keyed_results(chunked: DataFrame, kinds: Sequence[WindowKind] = KINDS, size: int | None = None) -> DataFrame:
    """The results of several kinds as one frame, so that one pass numbers them all."""
    columns = ["lo", "hi", "win", "start_time", *CHUNK_COLUMNS, "turn"]
    frames = [
        kind.rows(chunked).select(
            F.lit(kind.code).alias("kind"), F.lit(size or kind.size).cast("bigint").alias("size"), *columns
        )
        for kind in kinds
    ]
    return reduce(DataFrame.unionByName, frames)


def oriented_windows(windows: DataFrame, kinds: Sequence[WindowKind] = KINDS) -> DataFrame:
    """Windows keyed by (lo, hi) as rows of both orders, with topic and win rate."""
    topics = F.create_map(*[F.lit(v) for k in kinds for v in (k.code, k.topic)])
    opposed = F.col("kind").isin([k.code for k in kinds if k.opposed])
    reverse = F.when(opposed, F.col("played") - F.col("wins")).otherwise(F.col("wins"))
    forward = F.struct(F.col("lo").alias("hero_id1"), F.col("hi").alias("hero_id2"), F.col("wins"))
    backward = F.struct(F.col("hi").alias("hero_id1"), F.col("lo").alias("hero_id2"), reverse.alias("wins"))
    both = F.when(F.col("lo") == F.col("hi"), F.array(forward)).otherwise(F.array(forward, backward))
    rate = (F.col("o.wins") / F.col("played")).alias("win_rate")
    rows = windows.select(topics[F.col("kind")].alias("topic"), "window", "played", "latest", F.explode(both).alias("o"))
    return rows.select("topic", "o.hero_id1", "o.hero_id2", "window", "o.wins", "played", "latest", rate)


def all_windows(chunked: DataFrame, kinds: Sequence[WindowKind] = KINDS, size: int | None = None) -> DataFrame:
    """Full count windows of several kinds, in one pass over the chunked matches."""
    rows = with_positions(keyed_results(chunked, kinds, size), WINDOW_KEY)
    return oriented_windows(full_windows(window_parts(rows, WINDOW_KEY)), kinds)
