"""Refresh by difference against totals of all facts, over late, replayed, corrected and merged ones."""

import random
import shutil

import pytest
from rows import DAY, START, frame, match, players

from matchlens import schema as S
from matchlens.operators import activity, expand
from matchlens.operators.keyed import newest_rows
from matchlens.plans import difference, jobs
from matchlens.sinks.tables import Tables

DAYS = [(2024, 1, 1), (2024, 1, 2)]


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def append_matches(tables, batch_id, *matches):
    m = frame(tables.spark, *matches)
    for name, rows in (("player_match", expand.player_match_rows(m)), ("daily_player", expand.daily_player_rows(m))):
        tables.append(name, newest_rows(rows, S.TABLES[name].key, ["match_id", "slot"]), batch_id)


def close_days(tables, *days):
    rows = [("1", 2024, 1, d, 0.5, 10) for d in days]
    tables.append("hero_win_rate", tables.spark.createDataFrame(rows, S.TABLES["hero_win_rate"].schema), days[0])


def add(tables, days=DAYS[:1]):
    difference.add_matches(tables, days)
    totals, facts = tables.read("player_totals"), tables.read("player_match")
    columns = S.TABLES["player_daily"].schema.fieldNames()
    assert rows_of(totals.select(*columns)) == rows_of(activity.player_daily(facts).select(*columns))


def test_late_replayed_and_corrected_facts(tables, monkeypatch):
    append_matches(tables, 0, match(1), match(2, start=START + 3600), match(3, start=START + DAY))
    close_days(tables, 1, 2)
    assert difference.refresh_by_difference(tables) == DAYS
    # A late match of old and new accounts, a replay, and one whose winner and length were corrected.
    append_matches(tables, 1, match(4, start=START + 7200, team=players(accounts=range(1005, 1015))), match(1), match(2, False, START + 3600, 2400))
    upsert = Tables.upsert

    def stops(self, name, rows):
        upsert(self, name, rows)
        if name == "player_totals":
            raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(Tables, "upsert", stops)
        with pytest.raises(RuntimeError):
            difference.refresh_by_difference(tables)
    # The stopped run is repeated, and its matches are not added twice.
    assert difference.refresh_by_difference(tables) == DAYS[:1]
    facts, columns = tables.read("player_match"), S.TABLES["player_daily"].schema.fieldNames()
    assert rows_of(tables.read("player_daily")) == rows_of(activity.player_daily(facts).select(*columns))
    assert rows_of(tables.read("daily_active_users")) == [(*DAYS[0], 15), (*DAYS[1], 10)]
    assert rows_of(tables.read("monthly_active_users")) == [(2024, 1, 15)]
    assert difference.refresh_by_difference(tables) == []


def test_new_accounts_need_no_earlier_facts(tables, tmp_path):
    append_matches(tables, 0, match(1))
    add(tables)
    shutil.rmtree(tmp_path / "tables" / "player_match")
    append_matches(tables, 1, match(2, start=START + 60, team=players(accounts=range(2000, 2010))))
    difference.add_matches(tables, DAYS[:1])
    assert [r.matches_played for r in tables.read("player_totals").collect()] == [1] * 20


def test_merged_folders(tables):
    append_matches(tables, 0, match(1), match(2, start=START + 60))
    append_matches(tables, 1, match(3, start=START + 120))
    add(tables)
    tables.compact("player_match", jobs.in_days(DAYS))
    append_matches(tables, 2, match(4, start=START + 180), match(1))
    add(tables)
    # Counted and newer facts in one folder.
    append_matches(tables, 3, match(5, start=START + 240), match(3, False, START + 120))
    tables.compact("player_match", jobs.in_days(DAYS))
    add(tables)
    add(tables)


def test_random_batches(tables):
    rng = random.Random(6)
    for batch in range(4):
        made = []
        for slot in rng.sample(range(12), 5):
            start = START + slot % 2 * DAY + slot * 60
            made.append(match(slot, rng.random() < 0.5, start, rng.randint(1000, 3000), team=players(accounts=rng.sample(range(1000, 1030), 10))))
        append_matches(tables, batch, *made)
        add(tables, DAYS)
