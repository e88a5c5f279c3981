"""The shared intake with its reject table, rolling rates, timers and state, over several micro-batches and restarts."""

import os
import random
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F
from rows import DAY, START, bare_text, players

from matchlens import schema as S
from matchlens.operators import regions, sequence
from matchlens.operators.validate import valid_matches
from matchlens.sinks.tables import Tables
from matchlens.sources.messages import parse_matches, read_message_stream, read_text_stream
from matchlens.streaming import in_game, intake, live_state, pipeline
from matchlens.streaming.rolling import history, rolling_writer


def put(folder, name, *texts, age=0):
    """Write an input file; ``age`` orders files, the oldest is read first."""
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(texts) + "\n")
    os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))


def finish(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def live(spark, tmp_path):
    """Runs the intake, one file a micro-batch, and the queries over its log; returns the tables."""
    tables, root = Tables(spark, str(tmp_path / "tables")), str(tmp_path / "out")

    def run():
        lines = read_text_stream(spark, str(tmp_path / "in"), 1)
        finish(intake.intake_writer(lines, tables, root, f"{root}/ck/intake"))
        for writer in intake.stateful_writers(intake.read_log(spark, root, 1), tables, root, f"{root}/ck", size=3).values():
            finish(writer)
        return tables

    run.root = root
    return run


def random_files(tmp_path, n, seed, first=0):
    """Texts whose days jump to and fro, some of them broken; returns the texts file by file."""
    rnd = random.Random(seed)
    files = []
    for i in range(n):
        texts = []
        for k in range(rnd.randint(1, 4)):
            text = bare_text(100 * (first + i) + k, rnd.choice("tf"), START + rnd.randint(max(0, i - 4), i + 1) * DAY // 2 + rnd.randint(0, 9000))
            texts.append(text if rnd.random() < 0.8 else text[: len(text) // 2])
        texts.append(bare_text(100 * (first + i) + 9, "t", START + i * DAY // 2, duration=10))
        put(tmp_path / "in", f"f{first + i:03}.txt", *texts, age=500 - first - i)
        files.append(texts)
    return files


def test_every_match_is_counted_or_rejected(spark, tmp_path, live):
    """Closed windows hold the matches that came in time, the reject table has all others and the broken texts."""
    files = random_files(tmp_path, 6, 0)
    tables = live()
    # A day is closed when an earlier file has reached its end and the delay.
    late = {"late for heroes": 5400, "late for clusters": 600}
    expected, latest, taken = [], None, {r: {} for r in late}
    for batch, texts in enumerate(files):
        starts = []
        for text in texts:
            match = spark_free(text)
            if match is None:
                expected.append(("malformed", text, batch))
            elif match[1] >= 1000:
                starts.append(match[0])
                day = match[0] // DAY
                for reason, delay in late.items():
                    if latest is not None and (day + 1) * DAY <= latest - delay:
                        expected.append((reason, text, batch))
                    else:
                        taken[reason][day] = taken[reason].get(day, 0) + 1
        latest = max([*starts, *([latest] if latest is not None else [])], default=None)
    assert rows_of(intake.read_rejects(spark, live.root)) == sorted(expected)
    assert {r for r, _, _ in expected} == {"malformed", *late}
    closed = [{d - START // DAY + 1: n for d, n in taken[r].items() if (d + 1) * DAY <= latest - delay} for r, delay in late.items()]
    heroes = {r["day"]: r["count"] for r in tables.read("hero_win_rate").where("hero_id = '1'").collect()}
    clusters = {r["day"]: r["num_of_players"] // 10 for r in tables.read("region_num_of_players").collect()}
    assert [heroes, clusters] == closed and all(closed)


def spark_free(text):
    """(start, duration) of a whole text."""
    if not text.endswith("]}"):
        return None
    numbers = {k: int(v) for k, v in (p.split(": ") for p in text[1 : text.index(", players")].split(", ")) if v.isdigit()}
    return numbers["start_time"], numbers["duration"]


def test_rejects_and_totals_outlive_restarts(spark, tmp_path, live):
    put(tmp_path / "in", "a.txt", bare_text(1, start=START + 3 * DAY), "broken", age=90)
    live()
    put(tmp_path / "in", "b.txt", bare_text(2, start=START), "{}", bare_text(3, start=START + 3 * DAY + 60), age=80)
    put(tmp_path / "in", "c.txt", bare_text(4, start=START + 6 * DAY), age=70)
    tables = live()
    assert dict(rows_of(intake.reject_totals(spark, live.root))) == {"malformed": 2, "late for heroes": 1, "late for clusters": 1}
    late = intake.read_rejects(spark, live.root).where("reason = 'late for heroes'").first()
    assert late["value"] == bare_text(2, start=START) and late["batch"] == 1
    totals = pipeline.parse_totals(spark, live.root).first()
    assert (totals["malformed"], totals["total"]) == (2, 6)
    # Late matches are facts all the same.
    assert tables.read("player_match").count() == 40
    assert {(r["day"], r["count"]) for r in tables.read("hero_win_rate").collect()} == {(4, 2)}


def test_a_repeated_intake_batch_changes_nothing(spark, tmp_path, live):
    random_files(tmp_path, 3, 9)
    tables = live()
    before = [rows_of(tables.read("player_match")), rows_of(intake.read_rejects(spark, live.root)), rows_of(tables.read("hero_win_rate"))]
    logged = sorted(p.name for p in Path(f"{live.root}/{intake.LOG}").rglob("*.parquet"))
    # As if the last micro-batch had been stopped before its commit.
    commits = Path(f"{live.root}/ck/intake/commits")
    for name in ("2", ".2.crc"):
        (commits / name).unlink(missing_ok=True)
    tables = live()
    after = [rows_of(tables.read("player_match")), rows_of(intake.read_rejects(spark, live.root)), rows_of(tables.read("hero_win_rate"))]
    assert after == before and sorted(p.name for p in Path(f"{live.root}/{intake.LOG}").rglob("*.parquet")) == logged


def test_no_rejects_yet(spark, tmp_path):
    assert intake.reject_totals(spark, str(tmp_path)).count() == 0


def match_texts(seed, count):
    rnd = random.Random(seed)
    return [bare_text(i, rnd.choice("tf"), START + 60 * i, 1000 + rnd.randint(0, 3000), cluster=150 + i % 3, team=players([1] + rnd.sample(range(2, 14), 9))) for i in range(count)]


def batch_matches(spark, texts):
    return valid_matches(parse_matches(spark.createDataFrame([(t,) for t in texts], "value string")))


@pytest.mark.parametrize("size", [1, 5, 40])
def test_rolling_rates_equal_the_batch_form(spark, tmp_path, size):
    texts = match_texts(3, 30)
    for k in range(3):
        put(tmp_path / "in", f"{k}.txt", *texts[10 * k : 10 * k + 10], age=90 - k)
    root = str(tmp_path / "out")
    finish(rolling_writer(pipeline.parsed_matches(read_text_stream(spark, str(tmp_path / "in"), 1)), root, f"{root}/ck", size))
    columns = ["hero_id", "match_id", "slot", "position", "wins", "played", "win_rate"]
    rows = sequence.HERO.rows(sequence.chunk_matches(batch_matches(spark, texts)))
    expected = rows_of(sequence.rolling_win_rate(rows, ["hero_id"], size).select(*columns))
    schema = "hero_id int, match_id bigint, slot int, position bigint, wins bigint, played bigint, win_rate double"
    assert rows_of(spark.read.schema(schema).parquet(f"{root}/rolling").select(*columns)) == expected
    kept = {r["hero_id"]: r["count"] for r in history(spark, root).latest().groupBy("hero_id").count().collect()}
    assert kept[1] == max(size - 1, 1) if size <= 30 else kept[1] == 30


def test_history_of_the_key_before_small_blocks(spark):
    """Blocks as small as the window, with history from before the first of them."""
    texts = match_texts(5, 40)
    rows = [sequence.HERO.rows(sequence.chunk_matches(batch_matches(spark, part))) for part in (texts, texts[:25], texts[25:])]
    columns = ["hero_id", "match_id", "slot", "position", "win", "wins", "played"]
    whole, first = (sequence.rolling_win_rate(r, ["hero_id"], 6, 6).select(*columns) for r in rows[:2])
    last = first.groupBy("hero_id").agg(F.max("position").alias("top"))
    carried = first.join(last, "hero_id").where("position > top - 5").select("hero_id", "position", "win")
    second = sequence.rolling_win_rate(rows[2], ["hero_id"], 6, 6, carried).select(*columns)
    assert rows_of(first.unionByName(second)) == rows_of(whole)


def test_players_in_game_up_to_the_watermark(spark, tmp_path):
    texts = match_texts(7, 60)
    root = str(tmp_path / "out")
    before = spark.conf.get(in_game.STATE_STORE_SETTING)
    spark.conf.set(in_game.STATE_STORE_SETTING, in_game.STATE_STORE)
    try:
        for k in range(4):
            put(tmp_path / "in", f"{k}.txt", *texts[15 * k : 15 * k + 15], age=90 - k)
            matches = pipeline.parsed_matches(read_text_stream(spark, str(tmp_path / "in")))
            changes = in_game.player_changes(matches, "10 minutes", parts=2).writeStream.format("parquet")
            finish(changes.option("path", f"{root}/changes").option("checkpointLocation", f"{root}/ck"))
    finally:
        spark.conf.set(in_game.STATE_STORE_SETTING, before)
    found = spark.read.schema(in_game.CHANGES).parquet(f"{root}/changes")
    batch = regions.players_in_game(batch_matches(spark, texts))
    until = START + 60 * 59 - 600
    columns = ["cluster_id", "time", "delta", "players"]
    expected = [r for r in rows_of(batch.select(*columns)) if r[1] <= until]
    assert rows_of(in_game.players_over_time(found).select(*columns)) == expected != []
    now = {r["cluster_id"]: r["players"] for r in in_game.players_now(found).collect()}
    assert now == {c: [p for x, _, _, p in expected if x == c][-1] for c in {r[0] for r in expected}}


def test_newest_values_come_from_the_state(spark, tmp_path):
    ts = "2024-01-01T00:00:{:02}.000Z"
    rows = [(S.HERO_TOPIC, "1,0.500", 5), (S.HERO_TOPIC, "1,0.400", 3), (S.HERO_TOPIC, "2,0.1,9", 9), (S.PAIR_TOPIC, "1,2,0.700", 1)]
    more = [(S.HERO_TOPIC, "1,0.600", 7), (S.HERO_TOPIC, "1,0.200", 7), (S.PAIR_TOPIC, "1,2,0.900", 0)]
    found = []
    for part in (rows, more):
        spark.createDataFrame([(t, v, ts.format(s)) for t, v, s in part], "topic string, value string, ts string").write.mode("append").json(str(tmp_path / "in"))
        finish(live_state.newest_value_writer(read_message_stream(spark, str(tmp_path / "in")), str(tmp_path / "ck")))
        found.append({r["key"]: r["value"] for r in live_state.read_newest_values(spark, str(tmp_path / "ck")).collect()})
    assert found == [{"1": "0.500", "1,2": "0.700"}, {"1": "0.600", "1,2": "0.700"}]


def test_state_of_players_is_asked_by_slices():
    class State:
        def __init__(self):
            self.values, self.timers, self.calls = {}, [], 0

        def getMapState(self, *_):
            return self

        def containsKey(self, key):
            self.calls += 1
            return key in self.values

        def getValue(self, key):
            self.calls += 1
            return self.values[key]

        def updateValue(self, key, value):
            self.calls += 1
            self.values[key] = value

        def removeKey(self, key):
            del self.values[key]

        def registerTimer(self, time):
            self.calls += 1
            self.timers.append(time)

    class Clock:
        def __init__(self, now, timer=None):
            self.getCurrentWatermarkInMs, self.getExpiryTimeInMs = (lambda: now * 1000), (lambda: timer)

    state, changes, found = State(), in_game.PlayerChanges(), []
    changes.init(state)
    starts = [START + 10 * i for i in range(500)]
    for part in (starts[250:], starts[:250], starts[:1]):
        rows = pd.DataFrame({"start_time": part, "duration": [1000] * len(part)})
        assert list(changes.handleInputRows((7,), iter([rows]), Clock(0))) == []
    assert state.calls < 20
    for now in (START + 20, START + 20, START + 10_000):
        due = [t for t in state.timers if t <= now * 1000]
        state.timers = [t for t in state.timers if t > now * 1000]
        for timer in due:
            for rows in changes.handleExpiredTimer((7,), Clock(now), Clock(0, timer)):
                found += rows.itertuples(index=False, name=None)
    expected = {}
    for start in [*starts, starts[0]]:
        expected[start] = expected.get(start, 0) + 10
        expected[start + 1000] = expected.get(start + 1000, 0) - 10
    assert found == [(7, t, d) for t, d in sorted(expected.items())]
    assert state.values == {}
