"""Every query on whole tables: matches derived from ``events``, plus ``orders`` and ``lineitem``."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens import schema as S
from matchlens.functions.columns import date_parts, utc_date
from matchlens.operators import activity, expand, regions, sequence, winrate
from matchlens.operators.bands import band_join
from matchlens.operators.dates import new_dates, next_date
from matchlens.operators.keyed import latest_values, newest_rows
from matchlens.operators.validate import drop_malformed, valid_matches
from matchlens.plans import difference, jobs, serving
from matchlens.session import new_folder, stage
from matchlens.sinks.exports import split_text, to_bare_json, to_crawler_lines, to_message_json, write_dump
from matchlens.sinks.messages import win_rate_messages
from matchlens.sinks.tables import Tables
from matchlens.sources.clusters import default_clusters, default_ranges
from matchlens.sources.dump import dump_totals, read_dump
from matchlens.sources.events import EPOCH_SECONDS, read_event_matches, read_events
from matchlens.sources.messages import parse_matches, parse_win_rate_messages, read_message_stream, read_text_stream
from matchlens.streaming import in_game, intake, live_state, pipeline
from matchlens.streaming.count_windows import live_values
from matchlens.streaming.rolling import rolling_writer
from matchlens.streaming.windows import arrival_windows, cluster_player_windows, hero_win_rate_windows, with_event_time

Query = Callable[[SparkSession, str], DataFrame]
TOP_K = 5
SCALARS = ("match_id", "radiant_win", "start_time", "duration", "cluster", "human_players", "game_mode")


def matches(spark: SparkSession, folder: str) -> DataFrame:
    return valid_matches(read_event_matches(spark, folder))


def _on_matches(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(matches(spark, folder))


def _with_lookup(build: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return build(matches(spark, folder), default_clusters(spark), default_ranges(spark))

    return query


def _flat(m: DataFrame) -> DataFrame:
    """Matches with players as texts, for comparison across engines."""
    heroes = F.concat_ws(" ", F.transform("players", lambda p: p["hero_id"].cast("string")))
    accounts = F.concat_ws(" ", F.transform("players", lambda p: p["account_id"].cast("string")))
    return m.select(*SCALARS, heroes.alias("heroes"), accounts.alias("accounts"))


def _windows(kind: sequence.WindowKind) -> Query:
    return _on_matches(lambda m: kind.windows(sequence.chunk_matches(m)))


def _rolling(m: DataFrame) -> DataFrame:
    rows = sequence.HERO.rows(sequence.chunk_matches(m))
    rolled = sequence.rolling_win_rate(rows, ["hero_id"], S.HERO_WINDOW)
    return rolled.select("hero_id", "match_id", "slot", "position", "wins", "played", "win_rate")


def _messages(m: DataFrame) -> DataFrame:
    return win_rate_messages(sequence.all_windows(sequence.chunk_matches(m)))


def _player_match(m: DataFrame) -> DataFrame:
    table = S.TABLES["player_match"]
    rows = newest_rows(expand.player_match_rows(m), table.key, ["match_id", "slot"])
    return rows.select(*table.schema.fieldNames())


def _daily_player(m: DataFrame) -> DataFrame:
    table = S.TABLES["daily_player"]
    rows = newest_rows(expand.daily_player_rows(m), table.key, ["match_id", "slot"])
    return rows.select(*table.schema.fieldNames())


def _event_days(spark: SparkSession, folder: str) -> DataFrame:
    return read_events(spark, folder).select(
        *date_parts(F.to_date("ts")),
        F.col("user_id").alias("account_id"),
        F.expr(f"({EPOCH_SECONDS}) * 1000").alias("time_"),
    )


def _order_months(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return orders.select(*date_parts(F.to_date("o_orderdate"))[:2], F.col("o_custkey").alias("account_id"))


def _monthly_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    daily = activity.user_sketches(_event_days(spark, folder))
    return activity.sketch_counts(activity.merge_sketches(daily, activity.MONTH))


def _close_days(spark: SparkSession, folder: str) -> DataFrame:
    """Exact daily users and whether the sketch agrees within three standard errors."""
    rows = _event_days(spark, folder)
    return activity.close_counts(activity.active_users(rows), activity.active_users_hll(rows), activity.DAY)


def _close_months(spark: SparkSession, folder: str) -> DataFrame:
    rows = _order_months(spark, folder)
    exact, estimated = activity.active_users(rows, activity.MONTH), activity.active_users_hll(rows, activity.MONTH)
    return activity.close_counts(exact, estimated, activity.MONTH)


def _close_merged_months(spark: SparkSession, folder: str) -> DataFrame:
    exact = activity.active_users(_event_days(spark, folder), activity.MONTH)
    return activity.close_counts(exact, _monthly_from_sketches(spark, folder), activity.MONTH)


def _dates_of(m: DataFrame) -> DataFrame:
    return m.select(*date_parts(utc_date()))


def _pending(spark: SparkSession, folder: str) -> DataFrame:
    """Days with valid matches after a given date; weekends count as processed."""
    events = read_events(spark, folder).where("dayofweek(ts) IN (1, 7)")
    done = events.select(*date_parts(F.to_date("ts"))).distinct()
    return new_dates(_dates_of(matches(spark, folder)), done, after="2024-01-03")


def _newest_items(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("shipped")
    )
    newest = newest_rows(items, ["l_orderkey", "l_linenumber"], ["shipped", "l_partkey", "l_suppkey"])
    return newest.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("shipped", "yyyy-MM-dd").alias("shipped")
    )


def _live_from_messages(m: DataFrame) -> DataFrame:
    return latest_values(parse_win_rate_messages(_messages(m))).select("key", "value")


def _dump_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "dump")
    write_dump(matches(spark, folder), path)
    return _flat(read_dump(spark, path))


def _crawler_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "crawler")
    to_crawler_lines(matches(spark, folder)).write.text(path)
    return _flat(read_dump(spark, path))


def _malformed_dump(spark: SparkSession, folder: str) -> DataFrame:
    """Every match as a crawler's line, and of some also the line without its end."""
    path = new_folder(spark, "crawler")
    lines = to_crawler_lines(matches(spark, folder))
    cut = lines.where("CAST(substring_index(value, ',', 1) AS bigint) % 7 = 0").selectExpr("left(value, length(value) - 30) AS value")
    lines.unionByName(cut).write.text(path)
    return dump_totals(spark, path)


def _split_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "split")
    split_text(to_message_json(matches(spark, folder)), path, lines_per_file=50)
    return _flat(parse_matches(spark.read.text(path)))


def _send(messages: DataFrame, root: str) -> None:
    messages.write.mode("append").text(f"{root}/in")


def _live(spark: SparkSession, root: str, *names: str, files_per_batch: int | None = None, drop_replays: bool = False) -> Tables:
    """Run the named live queries over the message files below ``root`` to the end, from where they stopped."""
    tables = Tables(spark, f"{root}/tables")
    lines = read_text_stream(spark, f"{root}/in", files_per_batch)
    writers = pipeline.live_writers(lines, tables, root, f"{root}/checkpoints", drop_replays=drop_replays)
    for query in pipeline.start({name: writers[name] for name in names}, interval=None):
        query.awaitTermination()
    return tables


def _run_stream(spark: SparkSession, folder: str, *names: str) -> tuple[Tables, str]:
    """Write the matches as message files and run the named live queries over them to the end."""
    root = new_folder(spark, "live")
    _send(to_message_json(matches(spark, folder)), root)
    return _live(spark, root, *names), root


def _lagging_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Hero days close and a refresh runs before the facts arrive; the next refresh has them."""
    root = new_folder(spark, "live")
    _send(to_message_json(matches(spark, folder)), root)
    jobs.refresh_activity(_live(spark, root, "hero_days"))
    tables = _live(spark, root, "facts")
    jobs.refresh_activity(tables)
    return tables.read("player_daily")


def _late_facts(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the matches arrives after their days were refreshed."""
    root, all_matches = new_folder(spark, "live"), matches(spark, folder)
    _send(to_message_json(all_matches.where("match_id % 3 <> 0")), root)
    jobs.refresh_activity(_live(spark, root, "facts", "hero_days"))
    _send(to_message_json(all_matches.where("match_id % 3 = 0")), root)
    tables = _live(spark, root, "facts")
    jobs.refresh_activity(tables)
    return tables.read("player_daily")


def _malformed(spark: SparkSession, folder: str) -> DataFrame:
    """Every match with its text, and of some also the first half of it, over four micro-batches and more."""
    root = new_folder(spark, "live")
    lines = to_message_json(matches(spark, folder))
    cut = lines.where(F.get_json_object("value", "$.match_id").cast("long") % 7 == 0)
    cut = cut.select(F.expr("left(value, length(value) div 2)").alias("value"))
    _send(lines.select("value").unionByName(cut).repartition(4), root)
    _live(spark, root, "facts", files_per_batch=1)
    return pipeline.parse_totals(spark, root)


def _with_bad_messages(m: DataFrame) -> DataFrame:
    """Live values from messages of which each also comes with a part too many and a part too few."""
    good = _messages(m)
    longer = good.withColumn("value", F.concat("value", F.lit(",1")))
    shorter = good.withColumn("value", F.regexp_replace("value", ",[^,]*$", ""))
    everything = good.unionByName(longer).unionByName(shorter)
    return latest_values(parse_win_rate_messages(everything)).select("key", "value")


def _close_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct orders shipped in each year, enough for estimates, from one pass."""
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    year = F.year(F.to_date("l_shipdate")).alias("year")
    counts = items.groupBy(year).agg(
        F.count_distinct("l_orderkey").alias("num"),
        F.hll_sketch_estimate(F.hll_sketch_agg("l_orderkey", S.SKETCH_BITS)).alias("estimate"),
    )
    return counts.select("year", "num", (F.abs(F.col("estimate") - F.col("num")) <= F.col("num") * 0.05).alias("close"))


def _stream_hero_days(spark: SparkSession, folder: str) -> DataFrame:
    return _run_stream(spark, folder, "hero_days")[0].read("hero_win_rate")


def _stream_cluster_days(spark: SparkSession, folder: str) -> DataFrame:
    return _run_stream(spark, folder, "cluster_days")[0].read("region_num_of_players")


def _stream_messages(spark: SparkSession, folder: str) -> DataFrame:
    root = _run_stream(spark, folder, "count_windows")[1]
    return spark.read.schema("topic string, value string").json(f"{root}/live/messages").select("topic", "value")


def _stream_live(spark: SparkSession, folder: str) -> DataFrame:
    root = _run_stream(spark, folder, "count_windows")[1]
    return live_values(spark, f"{root}/live").latest().select("key", "value")


def _stream_player_match(spark: SparkSession, folder: str) -> DataFrame:
    return _run_stream(spark, folder, "facts")[0].read("player_match")


def _stream_simple(spark: SparkSession, folder: str) -> DataFrame:
    root = _run_stream(spark, folder, "facts")[1]
    return spark.read.schema("value string").text(f"{root}/{S.SIMPLE_TOPIC}").select("value")


def _refreshed(table: str, sketches: bool = False) -> Query:
    """Fill the stream tables from the live queries, then refresh the activity tables."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables, _ = _run_stream(spark, folder, "facts", "hero_days")
        jobs.refresh_activity(tables, sketches=sketches)
        return tables.read(table)

    return query


def _stored_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Months whose estimate from stored daily sketches lies within 5 % of the exact count."""
    tables, _ = _run_stream(spark, folder, "facts", "hero_days")
    jobs.refresh_activity(tables, sketches=True)
    exact = activity.active_users(tables.read("daily_player"), activity.MONTH)
    months = tables.read("monthly_active_users")
    return activity.close_counts(exact.join(months.select(*activity.MONTH), list(activity.MONTH), "left_semi"), months, activity.MONTH)


def _upserted_days(spark: SparkSession, folder: str) -> DataFrame:
    """Daily users of all events, then corrected by those of matches, through the table's upsert."""
    tables = Tables(spark, new_folder(spark, "tables"))
    tables.upsert("daily_active_users", activity.active_users(_event_days(spark, folder)))
    tables.upsert("daily_active_users", activity.active_users(_daily_player(matches(spark, folder))))
    return tables.read("daily_active_users")


def _monthly_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the matches arrives after the refresh; the second one reads only the days they fall on."""
    root, all_matches = new_folder(spark, "live"), matches(spark, folder)
    _send(to_message_json(all_matches.where("match_id % 3 <> 0")), root)
    jobs.refresh_activity(_live(spark, root, "facts", "hero_days"), bitmaps=True)
    _send(to_message_json(all_matches.where("match_id % 3 = 0")), root)
    tables = _live(spark, root, "facts")
    jobs.refresh_activity(tables, bitmaps=True, compact=True)
    return tables.read("monthly_active_users")


def _by_difference(table: str) -> Query:
    """A third of the matches arrives after the refresh, with replays of earlier ones; only that micro-batch is added."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root, all_matches = new_folder(spark, "live"), matches(spark, folder)
        _send(to_message_json(all_matches.where("match_id % 3 <> 0")), root)
        difference.refresh_by_difference(_live(spark, root, "facts", "hero_days"))
        _send(to_message_json(all_matches.where("match_id % 3 = 0 OR match_id % 7 = 0")), root)
        tables = _live(spark, root, "facts")
        difference.refresh_by_difference(tables)
        return tables.read(table)

    return query


def _order_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """Customers who ordered in each month, from the bitmaps of its days."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    daily = activity.user_bitmaps(orders.select(*date_parts(F.to_date("o_orderdate")), F.col("o_custkey").alias("account_id")))
    return activity.bitmap_counts(activity.merge_bitmaps(daily, activity.MONTH), activity.MONTH)


def _logged(spark: SparkSession, root: str) -> Tables:
    """Run the intake and then the queries over its log to the end, from where they stopped."""
    tables = Tables(spark, f"{root}/tables")
    writer = intake.intake_writer(read_text_stream(spark, f"{root}/in"), tables, root, f"{root}/checkpoints/intake")
    for writers in ({"intake": writer}, intake.stateful_writers(intake.read_log(spark, root), tables, root, f"{root}/checkpoints")):
        for query in pipeline.start(writers, interval=None):
            query.awaitTermination()
    return tables


def _in_two_runs(spark: SparkSession, folder: str) -> tuple[Tables, str]:
    """Two thirds of the matches, with some texts cut in half, and after a restart the rest, partly too late."""
    root, all_matches = new_folder(spark, "live"), matches(spark, folder)
    early = to_message_json(all_matches.where("match_id % 3 <> 0"))
    cut = early.where(F.get_json_object("value", "$.match_id").cast("long") % 7 == 0)
    _send(early.select("value").unionByName(cut.select(F.expr("left(value, length(value) div 2)").alias("value"))), root)
    _logged(spark, root)
    _send(to_message_json(all_matches.where("match_id % 3 = 0")), root)
    return _logged(spark, root), root


def _late_dropped(table: str) -> Query:
    return lambda spark, folder: _in_two_runs(spark, folder)[0].read(table)


def _rejects(spark: SparkSession, folder: str) -> DataFrame:
    match_id = F.regexp_extract("value", r'"match_id"\s*:\s*(\d+)', 1).cast("long")
    return intake.read_rejects(spark, _in_two_runs(spark, folder)[1]).select("reason", match_id.alias("match_id"))


def _reject_totals(spark: SparkSession, folder: str) -> DataFrame:
    return intake.reject_totals(spark, _in_two_runs(spark, folder)[1])


def _all_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and a sum of every output that one reading of the source feeds."""
    root = new_folder(spark, "live")
    _send(to_message_json(matches(spark, folder)), root)
    tables = _logged(spark, root)
    sums = {
        "hero_win_rate": (tables.read("hero_win_rate"), F.sum("count")),
        "region_num_of_players": (tables.read("region_num_of_players"), F.sum("num_of_players")),
        "player_match": (tables.read("player_match"), F.sum("account_id")),
        "daily_player": (tables.read("daily_player"), F.sum("duration")),
        "match_simple": (spark.read.text(f"{root}/{S.SIMPLE_TOPIC}"), F.sum(F.length("value"))),
        "messages": (spark.read.schema("topic string, value string").json(f"{root}/live/messages"), F.sum(F.length("value"))),
    }
    parts = [
        rows.agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("n"), total.cast("bigint").alias("total"))
        for name, (rows, total) in sums.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _quarters(m: DataFrame) -> list[DataFrame]:
    """Matches in four parts by start time."""
    cuts = [-math.inf, *m.stat.approxQuantile("start_time", [0.25, 0.5, 0.75], 0.01), math.inf]
    start = F.col("start_time").cast("double")
    return [m.where((start > F.lit(a)) & (start <= F.lit(b))) for a, b in pairwise(cuts)]


def _over_quarters(spark: SparkSession, folder: str, run: Callable[[str], None]) -> str:
    """Send the matches quarter by quarter and let ``run`` work off each, restarting from its checkpoint."""
    root = new_folder(spark, "live")
    for part in _quarters(matches(spark, folder)):
        _send(to_message_json(part), root)
        run(root)
    return root


def _stream_rolling(spark: SparkSession, folder: str) -> DataFrame:
    def run(root: str) -> None:
        parsed = pipeline.parsed_matches(read_text_stream(spark, f"{root}/in"))
        rolling_writer(parsed, root, f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    root = _over_quarters(spark, folder, run)
    schema = "hero_id int, match_id bigint, slot int, position bigint, wins bigint, played bigint, win_rate double"
    return spark.read.schema(schema).parquet(f"{root}/rolling").select(*[c.split()[0] for c in schema.split(", ")])


def _stream_in_game(spark: SparkSession, folder: str) -> DataFrame:
    def run(root: str) -> None:
        parsed = pipeline.parsed_matches(read_text_stream(spark, f"{root}/in"))
        changes = in_game.player_changes(parsed).writeStream.format("parquet").option("path", f"{root}/changes")
        changes.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    before = spark.conf.get(in_game.STATE_STORE_SETTING)
    spark.conf.set(in_game.STATE_STORE_SETTING, in_game.STATE_STORE)
    try:
        root = _over_quarters(spark, folder, run)
    finally:
        spark.conf.set(in_game.STATE_STORE_SETTING, before)
    return in_game.players_over_time(spark.read.schema(in_game.CHANGES).parquet(f"{root}/changes"))


def _live_from_state(spark: SparkSession, folder: str) -> DataFrame:
    """Live values from the state of a query that was stopped and started again between two parts of the messages."""
    root = new_folder(spark, "live")
    messages = stage(_messages(matches(spark, folder)), "messages")
    for odd in (0, 1):
        messages.where(F.pmod(F.xxhash64("value"), F.lit(2)) == odd).write.mode("append").json(f"{root}/in")
        writer = live_state.newest_value_writer(read_message_stream(spark, f"{root}/in"), f"{root}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    return live_state.read_newest_values(spark, f"{root}/checkpoint").select("key", "value")


def _message_values(spark: SparkSession, folder: str) -> DataFrame:
    """Keys and values that a consumer of the message stream gets, over two micro-batches."""
    root = new_folder(spark, "live")
    _messages(matches(spark, folder)).repartition(2).write.json(f"{root}/in")
    stream = read_message_stream(spark, f"{root}/in", files_per_batch=1)
    values = parse_win_rate_messages(stream).select("topic", "key", "value").writeStream.format("parquet")
    values = values.option("path", f"{root}/values").option("checkpointLocation", f"{root}/checkpoint")
    values.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("topic string, key string, value string").parquet(f"{root}/values")


def _message_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of count windows that were open at the end of a run and filled after the restart."""

    def run(root: str) -> None:
        _live(spark, root, "count_windows")

    root = _over_quarters(spark, folder, run)
    return spark.read.schema("topic string, value string").json(f"{root}/live/messages").select("topic", "value")


def _replays_dropped(spark: SparkSession, folder: str) -> DataFrame:
    """Hero days of a stream in which every match comes twice."""
    root = new_folder(spark, "live")
    lines = to_message_json(matches(spark, folder))
    _send(lines.unionByName(lines), root)
    return _live(spark, root, "hero_days", drop_replays=True).read("hero_win_rate")


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Players by hour of arrival, where a match arrives at its end; the last hours are still open."""
    root = new_folder(spark, "live")
    ended = F.timestamp_seconds(F.col("start_time") + F.col("duration"))
    for part in _quarters(matches(spark, folder)):
        with_end = part.withColumn("ended", ended)
        message = F.to_json(F.struct("match_id", "radiant_win", "start_time", "duration", "cluster", "human_players", "game_mode", "players"))
        with_end.select(message.alias("value"), "ended").write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("value string, ended timestamp").parquet(f"{root}/in")
    parsed = valid_matches(drop_malformed(parse_matches(stream, "value", "ended")))
    windows = arrival_windows(parsed, "1 hour", F.col("ended")).writeStream.format("parquet").option("path", f"{root}/windows")
    windows.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    found = spark.read.schema("cluster_id int, window_start timestamp, num_of_players bigint, latest bigint").parquet(f"{root}/windows")
    return found.withColumn("window_start", F.unix_seconds("window_start"))


def _split_dump(spark: SparkSession, folder: str) -> DataFrame:
    """A dump in files of at most 40 lines: the matches read back, each with whether its file keeps the limit."""
    path = new_folder(spark, "dump")
    write_dump(matches(spark, folder), path, lines_per_file=40)
    lines = spark.read.text(path).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("lines"))
    # Each file also has its header.
    longest = F.lit(lines.agg(F.max("lines")).first()[0] or 0)
    return _flat(read_dump(spark, path)).withColumn("within", longest <= 41)


def _price_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose price in cents lies in the span of each supplier nation's account balances, widened to prices."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(cents.alias("cents"))
    balance = F.round(F.col("s_acctbal") * 100).cast("bigint")
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet").select("s_nationkey", balance.alias("b"))
    bands = suppliers.groupBy("s_nationkey").agg((F.min("b") * 20).alias("lo"), (F.max("b") * 40).alias("hi"))
    return band_join(orders, bands, "cents").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("cents").alias("cents"))


def catalog() -> dict[str, Query]:
    return {
        "refresh_monthly_bitmaps": _monthly_bitmaps,
        "refresh_by_difference": _by_difference("player_daily"),
        "refresh_users_by_difference": _by_difference("daily_active_users"),
        "refresh_monthly_sketches_stored": _stored_sketches,
        "mau_bitmaps": _order_bitmaps,
        "stream_late_dropped": _late_dropped("hero_win_rate"),
        "stream_late_clusters_dropped": _late_dropped("region_num_of_players"),
        "reject_rows": _rejects,
        "reject_totals": _reject_totals,
        "stream_all_outputs": _all_outputs,
        "stream_rolling_win_rate": _stream_rolling,
        "stream_players_in_game": _stream_in_game,
        "live_values_from_state": _live_from_state,
        "message_stream_values": _message_values,
        "order_price_bands": _price_bands,
        "stream_messages_batches": _message_batches,
        "stream_replays_dropped": _replays_dropped,
        "arrival_windows": _arrivals,
        "split_dump_roundtrip": _split_dump,
        "valid_matches": _on_matches(_flat),
        "hero_results": _on_matches(expand.hero_results),
        "hero_pairs": _on_matches(expand.hero_pairs),
        "hero_counters": _on_matches(expand.hero_counters),
        "pair_keys": _on_matches(lambda m: expand.pair_key(expand.hero_pairs(m)).groupBy("pair_key").count()),
        "match_simple": _on_matches(expand.match_simple),
        "cluster_info": _on_matches(expand.cluster_info),
        "player_results": _on_matches(expand.player_results),
        "hero_win_rate_daily": _on_matches(winrate.hero_win_rate_daily),
        "hero_win_rate": _on_matches(lambda m: winrate.win_rate(expand.hero_results(m), ["hero_id"])),
        "pair_win_rate": _on_matches(winrate.pair_win_rate),
        "counter_win_rate": _on_matches(winrate.counter_win_rate),
        "hero_sliding_win_rate": _on_matches(
            lambda m: hero_win_rate_windows(with_event_time(m), "12 hours", "3 hours").select(
                "hero_id", F.unix_seconds("window_start").alias("window_start"), "wins", "played", "win_rate", "latest"
            )
        ),
        "cluster_hourly_players": _on_matches(
            lambda m: cluster_player_windows(with_event_time(m), "1 hour").select(
                "cluster_id", F.unix_seconds("window_start").alias("window_start"), "num_of_players", "latest"
            )
        ),
        "hero_count_window": _windows(sequence.HERO),
        "pair_count_window": _windows(sequence.PAIR),
        "counter_count_window": _windows(sequence.COUNTER),
        "hero_rolling_win_rate": _on_matches(_rolling),
        "hero_live_win_rate": _on_matches(
            lambda m: winrate.live_win_rate(
                expand.hero_results(m), ["hero_id"], S.HERO_WINDOW, ["start_time", "match_id", "slot"]
            )
        ),
        "best_teammates": _on_matches(lambda m: winrate.best_teammates(m, TOP_K)),
        "best_opponents": _on_matches(lambda m: winrate.best_opponents(m, TOP_K)),
        "cluster_players_daily": _on_matches(regions.cluster_players_daily),
        "players_in_game": _on_matches(regions.players_in_game),
        "cluster_regions": _with_lookup(
            lambda m, exact, ranges: regions.with_region(expand.cluster_info(m), exact, ranges)
        ),
        "region_players_daily": _with_lookup(regions.region_players_daily),
        "players_on_date": _with_lookup(
            lambda m, exact, ranges: serving.players_on_date(
                regions.cluster_players_daily(m), "2024-01-10", exact, ranges
            )
        ),
        "player_match": _on_matches(_player_match),
        "daily_player": _on_matches(_daily_player),
        "player_daily": _on_matches(lambda m: activity.player_daily(_player_match(m))),
        "player_activity": _on_matches(lambda m: serving.with_minutes(activity.player_daily(_player_match(m)))),
        "hero_history": _on_matches(lambda m: serving.hero_history(winrate.hero_win_rate_daily(m), 1)),
        "users_around": _on_matches(
            lambda m: serving.users_around(activity.active_users(_daily_player(m)), "2024-01-15", 5)
        ),
        "daily_accounts": lambda s, d: activity.distinct_accounts(_event_days(s, d)),
        "dau_exact": lambda s, d: activity.active_users(_event_days(s, d)),
        "dau_sorted": lambda s, d: activity.active_users_sorted(_event_days(s, d)),
        "dau_matches": _on_matches(lambda m: activity.active_users(_daily_player(m))),
        "mau_exact": lambda s, d: activity.active_users(_order_months(s, d), activity.MONTH),
        "dau_hll": lambda s, d: activity.active_users_hll(_event_days(s, d)),
        "mau_hll": lambda s, d: activity.active_users_hll(_order_months(s, d), activity.MONTH),
        "mau_from_daily_sketches": _monthly_from_sketches,
        "dau_hll_close": _close_days,
        "mau_hll_close": _close_months,
        "mau_sketches_close": _close_merged_months,
        "new_dates": _pending,
        "next_date": lambda s, d: next_date(_pending(s, d)),
        "newest_items": _newest_items,
        "win_rate_messages": _on_matches(lambda m: _messages(m).select("topic", "value")),
        "live_win_rate_latest": _on_matches(_live_from_messages),
        "dump_roundtrip": _dump_roundtrip,
        "crawler_lines": _crawler_lines,
        "malformed_dump_lines": _malformed_dump,
        "json_roundtrip": _on_matches(lambda m: _flat(parse_matches(to_message_json(m)))),
        "bare_json_roundtrip": _on_matches(lambda m: _flat(parse_matches(to_bare_json(to_message_json(m))))),
        "split_roundtrip": _split_roundtrip,
        "upserted_days": _upserted_days,
        "stream_hero_days": _stream_hero_days,
        "stream_cluster_days": _stream_cluster_days,
        "stream_messages": _stream_messages,
        "stream_live_values": _stream_live,
        "stream_player_match": _stream_player_match,
        "stream_match_simple": _stream_simple,
        "live_lookup": _on_matches(lambda m: serving.live_rate(_live_from_messages(m), "1")),
        "bad_messages_ignored": _on_matches(_with_bad_messages),
        "orders_hll_close": _close_orders,
        "malformed_lines": _malformed,
        "refresh_after_lagging_facts": _lagging_facts,
        "refresh_with_late_facts": _late_facts,
        "refresh_player_daily": _refreshed("player_daily"),
        "refresh_daily_users": _refreshed("daily_active_users"),
        "refresh_monthly_users": _refreshed("monthly_active_users"),
    }

