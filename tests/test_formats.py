"""Dump lines, message texts, win-rate messages, exports and cluster lookups."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from rows import START, bare_text, frame, match, players

from matchlens import schema as S
from matchlens.functions.columns import date_text
from matchlens.operators.validate import drop_malformed, valid_matches
from matchlens.session import checkpoint_dir, folder_names, new_folder, stage
from matchlens.sinks.exports import split_text, to_bare_json, to_dump_rows, to_message_json, write_dump
from matchlens.sinks.messages import win_rate_messages
from matchlens.sources.clusters import read_clusters, read_ranges
from matchlens.sources.dump import dump_totals, read_dump
from matchlens.sources.messages import parse_matches, parse_win_rate_messages

HEADER = ",".join(S.DUMP.fieldNames())


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def dump_line(match_id, win="t", picks="", team=None):
    pgroup = {str(s): {"account_id": a, "hero_id": h, "player_slot": s} for a, s, h in team or players()}
    text = json.dumps(pgroup, separators=(",", ":")).replace('"', '""')
    picks = '"' + picks.replace('"', '""') + '"' if picks else ""
    kept = f"{match_id},{match_id},{win},{START},1701,1975,4,63,3,155,100,0,10,0,0,0,1,1"
    return f'{kept},{picks},2,,,,,,,"{text}"'


def test_dump_lines(spark, tmp_path):
    tricky = '[{"order":0,"team":1},{"order":1,"team":0}]'
    path = tmp_path / "dump.csv"
    nine = players()[:9]
    path.write_text(
        "\n".join([HEADER, dump_line(1), dump_line(2, "f", tricky), dump_line(3, team=nine), "4,broken"]) + "\n"
    )
    rows = {r["match_id"]: r for r in read_dump(spark, str(path)).collect()}
    assert set(rows) == {1, 2}
    assert rows[1]["radiant_win"] is True and rows[2]["radiant_win"] is False
    assert [tuple(p) for p in rows[2]["players"]] == players()
    assert rows[1]["start_time"] == START and rows[1]["cluster"] == 155


@pytest.mark.parametrize(
    "win, expected",
    [("t", True), ("f", False), ("true", True), ("false", False), ("1", True), ("0", False), ('"t"', True), ('"f"', False)],
)
def test_win_flags(spark, win, expected):
    quoted = to_message_json(frame(spark, match())).first()["value"].replace('"radiant_win":true', f'"radiant_win":{win}')
    for text in (bare_text(win=win), quoted):
        parsed = valid_matches(parse_matches(lines(spark, text))).collect()
        assert len(parsed) == 1 and parsed[0]["radiant_win"] is expected
        assert [tuple(p) for p in parsed[0]["players"]] == players()


def test_malformed_texts_are_dropped_and_counted(spark):
    counts = Observation("counts")
    texts = lines(spark, bare_text(7), "", "not json", None, "[1, 2]", '{"other": 1}')
    assert [r["match_id"] for r in drop_malformed(parse_matches(texts), counts).collect()] == [7]
    assert counts.get == {"malformed": 5, "total": 6}


def test_missing_player_numbers_become_zero(spark):
    text = bare_text().replace("account_id:1000,", "")
    first = parse_matches(lines(spark, text)).first()["players"][0]
    assert tuple(first) == (0, 0, 1)


def test_players_are_put_in_slot_order(spark):
    shuffled = players()[::-1]
    parsed = parse_matches(lines(spark, bare_text(team=shuffled))).first()
    assert [tuple(p) for p in parsed["players"]] == players()


def test_message_json_layout(spark):
    record = json.loads(to_message_json(frame(spark, match(5))).first()["value"])
    assert record["pre_game_duration"] == 90 and record["flags"] == 1
    assert record["match_id"] == 5 and record["radiant_win"] is True
    assert record["players"][9] == {"account_id": 1009, "player_slot": 132, "hero_id": 10}


def test_bare_json_layout(spark):
    text = to_bare_json(to_message_json(frame(spark, match(5, win=False)))).first()["value"]
    assert '"' not in text and "radiant_win:f," in text


def test_parts_of_a_split_dump_need_no_header(spark, tmp_path):
    text = spark.createDataFrame([(x,) for x in (HEADER, *map(dump_line, range(1, 8)))], "value string").coalesce(1)
    split_text(text, str(tmp_path / "parts"), 3)
    assert sorted(r["match_id"] for r in read_dump(spark, str(tmp_path / "parts")).collect()) == list(range(1, 8))


def test_crawler_lines_are_read_and_bad_ones_counted(spark, tmp_path):
    def line(match_id, team, win="True"):
        group = "".join(f'""{s}"":{{""account_id"":{a},""hero_id"":{h},""player_slot"":{s}}},' for a, s, h in team)
        return f"{match_id},{match_id},{win},{START},1701,1975,4,63,3,155,100,0,10,0,None,None,1,1,,,,,,,,,{{{group}}}"

    texts = [HEADER, line(1, players()), line(2, players()[::-1], "False"), line(3, players()[:9]), dump_line(4), "5,broken", line(6, players())[:-9]]
    path = tmp_path / "crawler.csv"
    path.write_text("\n\n".join(texts) + "\n\n")
    counts = Observation("counts")
    rows = {r["match_id"]: r for r in read_dump(spark, str(path), counts).collect()}
    assert {i: r["radiant_win"] for i, r in rows.items()} == {1: True, 2: False, 4: True}
    assert all([tuple(p) for p in r["players"]] == players() for r in rows.values())
    assert rows[2]["start_time"] == START and rows[2]["cluster"] == 155 and rows[2]["engine"] == 1
    assert counts.get == {"malformed": 3, "total": 6}
    assert dump_totals(spark, str(path)).first().asDict() == counts.get


def test_dump_layout(spark, tmp_path):
    matches = frame(spark, *[match(i, win=i % 2 == 0) for i in range(25)])
    assert to_dump_rows(matches).columns == S.DUMP.fieldNames()
    write_dump(matches.coalesce(1), str(tmp_path / "out"), lines_per_file=10)
    files = sorted((tmp_path / "out").glob("*.csv"))
    assert [len(f.read_text().splitlines()) for f in files] == [11, 11, 6]
    back = read_dump(spark, str(tmp_path / "out")).select("match_id", "radiant_win", "players").collect()
    assert {(r[0], r[1]) for r in back} == {(i, i % 2 == 0) for i in range(25)}


def test_win_rate_messages(spark):
    rows = [(S.HERO_TOPIC, 12, 12, 0.53, START), (S.PAIR_TOPIC, 1, 2, 0.48, START), (S.COUNTER_TOPIC, 1, 2, 0.48, START)]
    windows = spark.createDataFrame(rows, "topic string, hero_id1 int, hero_id2 int, win_rate double, latest bigint")
    assert [r["value"] for r in win_rate_messages(windows).collect()] == ["12,0.530", "1,2,0.480", "counter,1,2,0.480"]


def test_messages_with_wrong_parts_are_ignored(spark):
    rows = [
        (S.HERO_TOPIC, "12,0.530"), (S.HERO_TOPIC, "1,2,0.480"), (S.PAIR_TOPIC, "1,2,0.480"), (S.PAIR_TOPIC, "1,0.4"),
        (S.COUNTER_TOPIC, "counter,1,2,0.480"), (S.COUNTER_TOPIC, "1,2,0.480"), ("unknown", "1,2"),
    ]
    messages = spark.createDataFrame(rows, "topic string, value string").withColumn("ts", F.current_timestamp())
    parsed = {(r["key"], r["value"]) for r in parse_win_rate_messages(messages).collect()}
    assert parsed == {("12", "0.530"), ("1,2", "0.480"), ("counter,1,2", "0.480")}


def test_date_text(spark):
    rows = spark.createDataFrame([(2024, 1, 5)], "year int, month int, day int")
    assert rows.select(date_text()).first()[0] == "2024-01-05"


def test_staged_tables(spark, tmp_path):
    staged = stage(spark.range(3), "numbers", str(tmp_path))
    assert staged.count() == 3 and folder_names(spark, str(tmp_path)) == ["numbers"]
    folder = new_folder(spark, "numbers")
    assert folder.startswith(checkpoint_dir(spark))


def test_cluster_files(spark, tmp_path):
    exact, ranges = tmp_path / "exact.txt", tmp_path / "ranges.txt"
    exact.write_text("https://example.org/a\nhttps://example.org/b\n\n111,United States\n155,Southeast Asia\n")
    ranges.write_text("110-129,United States\n220-239,China\n")
    assert [tuple(r) for r in read_clusters(spark, str(exact)).collect()] == [(111, "United States"), (155, "Southeast Asia")]
    assert [tuple(r) for r in read_ranges(spark, str(ranges)).collect()] == [(110, 129, "United States"), (220, 239, "China")]
