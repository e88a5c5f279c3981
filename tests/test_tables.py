"""Keyed tables, snapshots and the date-driven jobs."""

import pytest
from pyspark.sql import functions as F
from rows import DAY, START, frame, match, players

from matchlens import schema as S
from matchlens.operators import expand
from matchlens.operators.dates import new_dates, next_date
from matchlens.operators.keyed import newest_rows
from matchlens.plans import jobs, serving
from matchlens.sinks import tables as tables_module
from matchlens.sinks.tables import Snapshots, Tables
from matchlens.sources.clusters import default_clusters, default_ranges

DAU = "year int, month int, day int, num bigint"


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_replaces_by_key_and_keeps_the_rest(spark, tables):
    assert tables.read("daily_active_users").count() == 0
    tables.upsert("daily_active_users", spark.createDataFrame([(2024, 1, 1, 5), (2024, 1, 2, 6), (2024, 2, 1, 7)], DAU))
    tables.upsert("daily_active_users", spark.createDataFrame([(2024, 1, 2, 60), (2024, 1, 3, 8), (2025, 1, 1, 9)], DAU))
    assert rows_of(tables.read("daily_active_users")) == [
        (2024, 1, 1, 5), (2024, 1, 2, 60), (2024, 1, 3, 8), (2024, 2, 1, 7), (2025, 1, 1, 9),
    ]
    before = rows_of(tables.read("daily_active_users"))
    tables.upsert("daily_active_users", spark.createDataFrame([(2024, 1, 2, 60)], DAU))
    assert rows_of(tables.read("daily_active_users")) == before


def test_upsert_of_one_key_twice_keeps_the_greatest(spark, tables):
    for num in (5, 9):
        tables.upsert("daily_active_users", spark.createDataFrame([(2024, 1, 1, num), (2024, 1, 1, 7)], DAU))
        assert rows_of(tables.read("daily_active_users")) == [(2024, 1, 1, max(num, 7))]
    tables.upsert("daily_active_users", spark.createDataFrame([], DAU))
    assert rows_of(tables.read("daily_active_users")) == [(2024, 1, 1, 9)]


def test_upsert_leaves_no_staged_rows(spark, tables, tmp_path):
    tables.upsert("daily_active_users", spark.createDataFrame([(2024, 1, 1, 5)], DAU))
    assert not [p for p in (tmp_path / "tables").rglob("*.parquet") if "daily_active_users/year=" not in str(p)]


def test_upsert_touches_only_its_partitions(spark, tables, tmp_path):
    tables.upsert("daily_active_users", spark.createDataFrame([(2024, 1, 1, 5), (2024, 2, 1, 7)], DAU))
    february = tmp_path / "tables/daily_active_users/year=2024/month=2"
    kept = sorted(f.name for f in february.iterdir())
    tables.upsert("daily_active_users", spark.createDataFrame([(2024, 1, 2, 6)], DAU))
    assert sorted(f.name for f in february.iterdir()) == kept


def test_interrupted_upsert_is_finished_later(spark, tables, monkeypatch):
    tables.upsert("daily_active_users", spark.createDataFrame([(2024, 1, 1, 5), (2024, 1, 2, 6)], DAU))

    def lost(self, rows, name, partition_by):
        from matchlens.session import delete_path

        delete_path(spark, f"{self.path(name)}/year=2024/month=1")
        raise RuntimeError("stopped while replacing")

    with monkeypatch.context() as patch:
        patch.setattr(Tables, "_write", lost)
        with pytest.raises(RuntimeError):
            tables.upsert("daily_active_users", spark.createDataFrame([(2024, 1, 2, 60)], DAU))
    assert tables.read("daily_active_users").where("month = 1").count() == 0
    # Another session knows only the root.
    later = Tables(spark.newSession(), tables.root)
    later.upsert("daily_active_users", spark.createDataFrame([(2024, 1, 3, 7)], DAU))
    assert rows_of(tables.read("daily_active_users")) == [(2024, 1, 1, 5), (2024, 1, 2, 60), (2024, 1, 3, 7)]


def append_matches(tables, batch_id, *matches):
    m = frame(tables.spark, *matches)
    for name, rows in (("player_match", expand.player_match_rows(m)), ("daily_player", expand.daily_player_rows(m))):
        tables.append(name, newest_rows(rows, S.TABLES[name].key, ["match_id", "slot"]), batch_id)


def test_appended_batches_give_one_row_per_key(spark, tables):
    append_matches(tables, 0, match(1, win=True), match(2, start=START + DAY))
    append_matches(tables, 1, match(1, win=False))
    append_matches(tables, 1, match(1, win=False))  # the same batch again
    stored = tables.read("player_match")
    assert stored.columns == S.TABLES["player_match"].schema.fieldNames()
    assert stored.count() == 20
    first_day = stored.where("day = 1").collect()
    assert all(r["win"] is (int(r["hero_id"]) > 5) for r in first_day)
    assert dict(stored.dtypes)["hero_id"] == "string"


def batch_folders(tables, name, day):
    from pathlib import Path

    return {f.name for f in Path(f"{tables.path(name)}/year=2024/month=1/day={day}").iterdir()}


def test_compaction_keeps_the_newest_rows(spark, tables):
    append_matches(tables, 0, match(1, win=True), match(2, start=START + DAY))
    append_matches(tables, 1, match(1, win=False), match(3, start=START + 60))
    append_matches(tables, 2, match(4, start=START + 120))
    before = rows_of(tables.read("player_match"))
    jobs.compact_days(tables, [(2024, 1, 1), (2024, 1, 2)])
    assert rows_of(tables.read("player_match")) == before
    assert batch_folders(tables, "player_match", 1) == {"batch=2001"}
    assert batch_folders(tables, "player_match", 2) == {"batch=0"}
    append_matches(tables, 3, match(1, win=True))
    changed = rows_of(tables.read("player_match"))
    assert changed != before
    jobs.compact_days(tables, [(2024, 1, 1)])
    assert rows_of(tables.read("player_match")) == changed
    assert batch_folders(tables, "daily_player", 1) == {"batch=3001"}


def test_interrupted_compaction_loses_nothing(spark, tables, monkeypatch):
    append_matches(tables, 0, match(1, win=True))
    append_matches(tables, 1, match(1, win=False))
    before = rows_of(tables.read("player_match"))

    def stop(spark, path):
        raise RuntimeError("stopped before deleting")

    with monkeypatch.context() as patch:
        patch.setattr(tables_module, "delete_path", stop)
        with pytest.raises(RuntimeError):
            tables.compact("player_match", F.col("day") == 1)
    assert rows_of(tables.read("player_match")) == before
    tables.compact("player_match", F.col("day") == 1)
    assert rows_of(tables.read("player_match")) == before
    assert batch_folders(tables, "player_match", 1) == {"batch=1002"}


def test_two_heroes_of_one_account_keep_the_highest_slot(spark, tables):
    append_matches(tables, 0, match(1, team=players(accounts=[5] * 10)))
    assert [(r["account_id"], r["hero_id"]) for r in tables.read("player_match").collect()] == [(5, "10")]


def closed_days(tables, *days):
    rows = [("1", 2024, 1, d, 0.5, 10) for d in days]
    tables.append("hero_win_rate", tables.spark.createDataFrame(rows, S.TABLES["hero_win_rate"].schema), days[0])


def test_refresh_processes_new_closed_days(spark, tables):
    append_matches(tables, 0, match(1), match(2, start=START + 3600, team=players(accounts=range(1005, 1015))))
    append_matches(tables, 1, match(3, start=START + DAY, duration=1200, team=players(accounts=range(2000, 2010))))
    append_matches(tables, 2, match(4, start=START + 2 * DAY))
    closed_days(tables, 1, 2)
    assert jobs.refresh_activity(tables, first_only=True) == [(2024, 1, 1)]
    assert rows_of(tables.read("daily_active_users")) == [(2024, 1, 1, 15)]
    assert jobs.refresh_activity(tables) == [(2024, 1, 2)]
    assert jobs.refresh_activity(tables) == []
    assert rows_of(tables.read("daily_active_users")) == [(2024, 1, 1, 15), (2024, 1, 2, 10)]
    closed_days(tables, 3)
    assert jobs.refresh_activity(tables, sketches=True) == [(2024, 1, 3)]
    daily = tables.read("player_daily")
    both = daily.where("account_id = 1005 AND day = 1").first()
    assert (both["matches_played"], both["matches_won"], both["time_played_in_sec"]) == (2, 1, 3600)
    assert [r["minutes"] for r in serving.account_activity(daily, 2000).collect()] == [20.0]
    # The first two days had no sketch yet; the merged month covers all three.
    assert rows_of(tables.read("monthly_active_users")) == [(2024, 1, 25)]


def test_refresh_waits_for_lagging_facts(spark, tables):
    closed_days(tables, 1, 2)
    jobs.refresh_activity(tables)
    append_matches(tables, 0, match(1))
    append_matches(tables, 1, match(3, start=START + DAY, team=players(accounts=range(2000, 2010))))
    assert jobs.refresh_activity(tables) == [(2024, 1, 1), (2024, 1, 2)]
    assert rows_of(tables.read("daily_active_users")) == [(2024, 1, 1, 10), (2024, 1, 2, 10)]
    assert jobs.refresh_activity(tables) == []


def test_late_facts_open_a_logged_day_again(spark, tables):
    append_matches(tables, 0, match(1))
    closed_days(tables, 1)
    assert jobs.refresh_activity(tables) == [(2024, 1, 1)]
    append_matches(tables, 1, match(2, start=START + 3600, team=players(accounts=range(1005, 1015))))
    assert jobs.refresh_activity(tables) == [(2024, 1, 1)]
    assert rows_of(tables.read("daily_active_users")) == [(2024, 1, 1, 15)]
    assert rows_of(tables.read("monthly_active_users")) == [(2024, 1, 15)]


def test_jobs_by_date(spark, tables):
    append_matches(tables, 0, match(1), match(2, start=START + DAY, team=players(accounts=range(1005, 1015))))
    jobs.run_player_daily(tables, "2024-01-02")
    assert tables.read("player_daily").count() == 10
    for method in ("exact", "sorted", "hll"):
        jobs.run_daily_users(tables, "2024-01-01", method)
        assert rows_of(tables.read("daily_active_users")) == [(2024, 1, 1, 10)]
    for method in ("exact", "hll"):
        jobs.run_monthly_users(tables, "2024-01", method)
        assert rows_of(tables.read("monthly_active_users")) == [(2024, 1, 15)]
    with pytest.raises(ValueError):
        jobs.run_player_daily(tables, "2024-1-2")
    with pytest.raises(ValueError):
        jobs.run_daily_users(tables, "2024-01-01", "guess")
    with pytest.raises(ValueError):
        jobs.run_monthly_users(tables, "2024-01-01")


def test_day_filter_prunes_folders(spark, tables):
    append_matches(tables, 0, match(1), match(2, start=START + DAY))
    plan = tables.read("player_match", jobs.in_days([(2024, 1, 2)]))._jdf.queryExecution().toString()
    assert "PartitionFilters: [struct(year, year" in plan or "PartitionFilters: [named_struct(year" in plan
    assert tables.read("player_match", jobs.in_days([(2024, 1, 2)])).count() == 10


def test_new_dates(spark):
    dated = spark.createDataFrame([(2024, 1, d) for d in (3, 1, 2, 2, 5)], "year int, month int, day int")
    done = spark.createDataFrame([(2024, 1, 2)], "year int, month int, day int")
    assert rows_of(new_dates(dated, done)) == [(2024, 1, 1), (2024, 1, 3), (2024, 1, 5)]
    assert rows_of(new_dates(dated, done, after="2024-01-03")) == [(2024, 1, 5)]
    assert rows_of(next_date(new_dates(dated, done))) == [(2024, 1, 1)]
    assert rows_of(next_date(dated.where("day > 9"))) == []


def test_dashboard_queries(spark):
    rates = spark.createDataFrame([("1", 2024, 1, 2, 0.5, 4), ("1", 2023, 12, 31, 0.25, 8), ("2", 2024, 1, 1, 1.0, 1)], S.TABLES["hero_win_rate"].schema)
    assert [r["count"] for r in serving.hero_history(rates, "1").collect()] == [8, 4]
    users = spark.createDataFrame([(2023, 12, 25, 1), (2023, 12, 31, 2), (2024, 1, 1, 3), (2024, 1, 9, 4)], DAU)
    assert [r["num"] for r in serving.users_around(users, "2024-01-02", 7).collect()] == [2, 3, 4]
    clusters = spark.createDataFrame(
        [(155, 2024, 1, 1, 30), (151, 2024, 1, 1, 10), (999, 2024, 1, 1, 20), (155, 2024, 1, 2, 50)],
        S.TABLES["region_num_of_players"].schema,
    )
    found = serving.players_on_date(clusters, "2024-01-01", default_clusters(spark), default_ranges(spark))
    assert [tuple(r) for r in found.collect()] == [(None, 20), ("Southeast Asia", 40)]
    live = spark.createDataFrame([("12", "0.530"), ("counter,1,2", "0.480")], "key string, value string")
    assert serving.live_rate(live, "counter,1,2").first()["value"] == "0.480"


def test_snapshots(spark, tmp_path):
    state = Snapshots(spark, str(tmp_path / "state"), "key string, n bigint")
    assert state.before(0).count() == 0 and state.latest().count() == 0
    for batch_id in range(4):
        old = state.before(batch_id)
        fresh = old.withColumn("n", F.col("n") + 1).unionByName(spark.createDataFrame([(f"k{batch_id}", 0)], "key string, n bigint"))
        state.write(fresh, batch_id)
        state.write(fresh, batch_id)  # a repeated batch reads the same input again
    assert rows_of(state.latest()) == [("k0", 3), ("k1", 2), ("k2", 1), ("k3", 0)]
    assert {f.name for f in (tmp_path / "state").iterdir()} == {"batch=2", "batch=3"}
    with pytest.raises(RuntimeError):
        state.before(7)
