"""Live queries over file streams: several micro-batches, late matches, replays and restarts."""

import os
import random

import pytest
from pyspark.sql import functions as F
from rows import DAY, START, bare_text, players

from matchlens import schema as S
from matchlens.operators import sequence
from matchlens.plans import serving
from matchlens.sinks.messages import console_writer, text_stream_writer
from matchlens.sinks.tables import Tables
from matchlens.sources.messages import parse_matches, read_message_stream, read_text_stream
from matchlens.streaming import pipeline
from matchlens.streaming.count_windows import (
    count_window_writer, live_value_writer, live_values, message_files, open_windows, process_batch,
)
from matchlens.streaming.windows import (
    arrival_windows, dedup_replays, hero_win_rate_windows, with_event_time,
)


def put(folder, name, *texts, age=0):
    """Write an input file; ``age`` orders files, the oldest is read first."""
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(texts) + "\n")
    os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))


def finish(writer, **trigger):
    query = writer.trigger(**(trigger or {"availableNow": True})).start()
    query.awaitTermination()
    return query


def run_all(writers):
    queries = pipeline.start(writers, interval=None)
    for query in queries:
        query.awaitTermination()
    return queries


@pytest.fixture
def live(spark, tmp_path):
    """Starts the whole pipeline over the folder ``in`` of this test."""
    tables = Tables(spark, str(tmp_path / "tables"))

    def run(files_per_batch=1, names=None, **options):
        lines = read_text_stream(spark, str(tmp_path / "in"), files_per_batch)
        writers = pipeline.live_writers(lines, tables, str(tmp_path / "out"), str(tmp_path / "ck"), **options)
        run.queries = run_all({n: w for n, w in writers.items() if names is None or n in names})
        return tables

    return run


def counts(tables, name="hero_win_rate", hero="1"):
    rows = tables.read(name).where(F.col("hero_id") == hero).collect()
    return {r["day"]: r["count"] for r in rows}


def test_pipeline_outputs(spark, tmp_path, live):
    source = tmp_path / "in"
    put(source, "a.txt", bare_text(1, start=START), bare_text(2, "f", start=START + 60), "broken", age=30)
    put(source, "b.txt", bare_text(3, start=START + DAY + 7200), bare_text(4, duration=10), age=20)
    put(source, "c.txt", bare_text(5, start=START + 2 * DAY + 7200), age=10)
    tables = live(size=2)
    assert counts(tables) == {1: 2, 2: 1}
    hero = tables.read("hero_win_rate").where("hero_id = '1' AND day = 1").first()
    assert (hero["year"], hero["month"], hero["win_rate"]) == (2024, 1, 0.5)
    assert {r["day"]: r["num_of_players"] for r in tables.read("region_num_of_players").collect()} == {1: 20, 2: 10}
    assert tables.read("player_match").count() == 40 and tables.read("daily_player").count() == 40
    simple = spark.read.text(str(tmp_path / "out" / S.SIMPLE_TOPIC)).select("value").collect()
    assert f"1 2 3 4 5 6 7 8 9 10 1 {START}000" in {r["value"] for r in simple}
    # Four valid matches of the same ten heroes make two windows of two for each key.
    messages = spark.read.schema("topic string, value string").json(str(tmp_path / "out/live/messages"))
    assert {r["topic"]: r["n"] for r in messages.groupBy("topic").agg(F.count("*").alias("n")).collect()} == {
        S.HERO_TOPIC: 20, S.PAIR_TOPIC: 80, S.COUNTER_TOPIC: 100,
    }
    current = live_values(spark, str(tmp_path / "out/live")).latest()
    assert serving.live_rate(current, "1").first()["value"] == "1.000"
    assert serving.live_rate(current, "counter,10,1").first()["value"] == "0.000"


def test_malformed_totals_outlive_restarts(spark, tmp_path, live):
    """Totals come from a table by batch, not from the few progress entries that a query retains."""
    source = tmp_path / "in"
    put(source, "a.txt", bare_text(1), "broken", age=50)
    put(source, "b.txt", "broken", "{}", age=40)
    live(names=["facts"])
    put(source, "c.txt", bare_text(2), "broken", age=30)
    live(names=["facts"])
    totals = pipeline.parse_totals(spark, str(tmp_path / "out")).first()
    assert (totals["malformed"], totals["total"]) == (4, 6)


def test_late_matches_are_dropped(spark, tmp_path, live):
    source = tmp_path / "in"
    put(source, "a.txt", bare_text(1, start=START + 100), age=50)
    put(source, "b.txt", bare_text(2, start=START + DAY + 3600 * 5), age=40)
    put(source, "c.txt", bare_text(3, start=START + DAY + 3600 * 6), age=30)
    put(source, "d.txt", bare_text(4, start=START + 200), age=20)  # its day has been closed
    put(source, "e.txt", bare_text(5, start=START + 2 * DAY + 3600 * 5), age=10)
    tables = live(names=["hero_days"])
    assert counts(tables) == {1: 1, 2: 2}


def test_disorder_within_the_delay_is_kept(spark, tmp_path, live):
    source = tmp_path / "in"
    put(source, "a.txt", bare_text(1, start=START + DAY - 60), age=50)
    put(source, "b.txt", bare_text(2, start=START + DAY + 3600), age=40)
    put(source, "c.txt", bare_text(3, start=START + DAY - 30), age=30)
    put(source, "d.txt", bare_text(4, start=START + 3 * DAY), age=20)
    assert counts(live(names=["hero_days"])) == {1: 2, 2: 1}


def test_replays_count_unless_dropped(spark, tmp_path, live):
    source = tmp_path / "in"
    put(source, "a.txt", bare_text(1), bare_text(1), bare_text(2, start=START + 60), age=20)
    put(source, "b.txt", bare_text(3, start=START + 3 * DAY), age=10)
    tables = live(names=["hero_days", "facts"])
    assert counts(tables) == {1: 3}
    assert tables.read("player_match").where("day = 1").count() == 20


def test_dropped_replays(spark, tmp_path, live):
    source = tmp_path / "in"
    put(source, "a.txt", bare_text(1), bare_text(1), bare_text(2, start=START + 60), age=20)
    put(source, "b.txt", bare_text(3, start=START + 3 * DAY), age=10)
    assert counts(live(names=["hero_days"], drop_replays=True)) == {1: 2}


def test_restart_continues_from_the_checkpoint(spark, tmp_path, live):
    source = tmp_path / "in"
    for i in range(3):
        put(source, f"a{i}.txt", bare_text(i, start=START + 60 * i), age=90 - i)
    live(size=2)
    for i in range(3, 6):
        put(source, f"a{i}.txt", bare_text(i, start=START + 60 * i), age=90 - i)
    put(source, "z.txt", bare_text(9, start=START + 3 * DAY), age=1)
    tables = live(size=2)
    assert counts(tables) == {1: 6}
    assert tables.read("player_match").count() == 70
    messages = spark.read.schema("topic string, value string").json(str(tmp_path / "out/live/messages"))
    # Seven results per hero: three windows of two, one result left over across the restart.
    assert messages.where(F.col("topic") == S.HERO_TOPIC).count() == 30
    state = open_windows(spark, str(tmp_path / "out/live")).latest().where("kind = 0")
    assert {r["played"] for r in state.collect()} == {1}


def random_texts(seed, count):
    rnd = random.Random(seed)
    return [bare_text(i, rnd.choice("tf"), START + i, team=players([1] + rnd.sample(range(2, 14), 9))) for i in range(count)]


def test_streamed_windows_equal_batch_windows(spark, tmp_path):
    """Hero 1 is in every match, as a hot key; batches arrive in time order."""
    texts = random_texts(2, 60)
    for b in range(4):
        put(tmp_path / "in", f"{b}.txt", *texts[b * 15 : b * 15 + 15], age=50 - b)
    matches = pipeline.parsed_matches(read_text_stream(spark, str(tmp_path / "in"), 1))
    finish(count_window_writer(matches, str(tmp_path / "out"), str(tmp_path / "ck"), size=4))
    streamed = spark.read.schema("topic string, value string").json(str(tmp_path / "out/messages"))
    batch = pipeline.parsed_matches(spark.createDataFrame([(t,) for t in texts], "value string"))
    chunked = sequence.chunk_matches(batch, chunks=3)
    for kind in sequence.KINDS:
        expected = kind.windows(chunked, 4)
        columns = [c for c in expected.columns if c.startswith("hero_id")]
        rates = F.concat_ws(",", *[F.col(c).cast("string") for c in columns], F.format_string("%.3f", "win_rate"))
        value = F.concat(F.lit("counter,"), rates) if kind is sequence.COUNTER else rates
        found = streamed.where(F.col("topic") == kind.topic).select("value")
        assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in expected.select(value).collect())


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    texts = random_texts(3, 9)
    root = str(tmp_path / "out")
    for batch_id in (0, 1, 1, 2, 2):
        part = spark.createDataFrame([(t,) for t in texts[batch_id * 3 : batch_id * 3 + 3]], "value string")
        process_batch(pipeline.parsed_matches(part), batch_id, root, message_files(f"{root}/messages"), (sequence.HERO,), 2)
    messages = spark.read.json(f"{root}/messages")
    assert messages.where("value LIKE '1,%'").count() == 4
    left = open_windows(spark, root).latest().where("lo = 1").first()
    assert left["played"] == 1


def test_live_values_from_messages(spark, tmp_path):
    ts = '"ts":"2024-01-01T00:00:0{}Z"'
    line = '{{"topic":"{}","value":"{}",{}}}'
    put(tmp_path / "in", "a.json", line.format(S.HERO_TOPIC, "1,0.500", ts.format(1)), line.format(S.HERO_TOPIC, "1,0.600", ts.format(2)), age=9)
    put(tmp_path / "in", "b.json", line.format(S.PAIR_TOPIC, "1,2,0.100", ts.format(3)), line.format(S.HERO_TOPIC, "1,2,0.9", ts.format(3)))
    finish(live_value_writer(read_message_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")))
    rows = live_values(spark, str(tmp_path / "out")).latest().collect()
    assert {(r["key"], r["value"]) for r in rows} == {("1", "0.600"), ("1,2", "0.100")}


def test_sliding_windows_stream_like_batch(spark, tmp_path):
    rnd = random.Random(4)
    texts = [bare_text(i, rnd.choice("tf"), START + 600 * i) for i in range(60)]
    put(tmp_path / "in", "a.txt", *texts[:30], age=20)
    put(tmp_path / "in", "b.txt", *texts[30:], age=10)
    columns = ["hero_id", "window_start", "wins", "played", "latest"]
    stream = with_event_time(pipeline.parsed_matches(read_text_stream(spark, str(tmp_path / "in"), 1)), "10 minutes")
    windows = hero_win_rate_windows(stream, "2 hours", "30 minutes").select(columns)
    finish(
        windows.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append")
    )
    batch = with_event_time(parse_matches(spark.createDataFrame([(t,) for t in texts], "value string")))
    expected = {tuple(r) for r in hero_win_rate_windows(batch, "2 hours", "30 minutes").select(columns).collect()}
    found = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select(columns).collect()]
    assert len(found) == len(set(found)) and set(found) <= expected
    assert len(found) >= 10 * 12


def test_other_writers(spark, tmp_path):
    put(tmp_path / "in", "a.txt", bare_text(1), bare_text(1), age=20)
    put(tmp_path / "in", "b.txt", bare_text(2), age=10)
    lines = read_text_stream(spark, str(tmp_path / "in"), 1)
    finish(text_stream_writer(lines, str(tmp_path / "copy"), str(tmp_path / "ck1")))
    assert spark.read.text(str(tmp_path / "copy")).count() == 3
    matches = pipeline.parsed_matches(lines)
    once = dedup_replays(with_event_time(matches)).select("match_id")
    query = finish(console_writer(once, str(tmp_path / "ck2")))
    assert query.exception() is None and sum(p["numInputRows"] for p in query.recentProgress) == 3
    arrived = arrival_windows(matches, "1 minute").writeStream.format("noop").outputMode("append")
    query = finish(arrived.option("checkpointLocation", str(tmp_path / "ck3")))
    assert query.exception() is None
