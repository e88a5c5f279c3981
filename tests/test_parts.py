"""Stored daily parts, compaction, bloom filters and band joins."""

import random

import pytest
from pyspark.sql import functions as F
from rows import DAY, START, frame, match, players

from matchlens import schema as S
from matchlens.operators import activity, expand
from matchlens.operators.bands import band_join
from matchlens.operators.keyed import newest_rows
from matchlens.operators.regions import with_region
from matchlens.plans import jobs
from matchlens.sinks.tables import Tables


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


def test_bitmaps_hold_exactly_the_accounts(spark):
    random.seed(0)
    accounts = [random.choice([random.randint(0, 40_000), random.randint(0, 1 << 33), -random.randint(0, 70_000)]) for _ in range(3000)]
    rows = [(2024, 1 + i % 2, 1 + i % 5, a) for i, a in enumerate(accounts + accounts[:500])] + [(2024, 1, 1, None), (2024, 3, 1, 0)]
    rows = spark.createDataFrame(rows, "year int, month int, day int, account_id bigint")
    daily = activity.user_bitmaps(rows)
    assert rows_of(activity.bitmap_counts(daily, activity.DAY)) == rows_of(activity.active_users(rows))
    monthly = activity.bitmap_counts(activity.merge_bitmaps(daily, activity.MONTH), activity.MONTH)
    assert rows_of(monthly) == rows_of(activity.active_users(rows, activity.MONTH))


def test_bitmap_months_read_only_days_with_newer_facts(tables, monkeypatch):
    for day in range(3):
        append_matches(tables, day, match(day, start=START + day * DAY, team=players(accounts=range(day * 5, day * 5 + 10))))
    close_days(tables, 1, 2)
    assert jobs.refresh_activity(tables, bitmaps=True) == [(2024, 1, 1), (2024, 1, 2)]
    # The third day is not closed, but its accounts are users of the month.
    assert rows_of(tables.read("monthly_active_users")) == [(2024, 1, 20)]
    append_matches(tables, 3, match(9, start=START + DAY + 60, team=players(accounts=range(100, 110))))
    made = []
    bitmaps = activity.user_bitmaps
    monkeypatch.setattr(activity, "user_bitmaps", lambda rows: made.append(rows_of(rows.select("day").distinct())) or bitmaps(rows))
    assert jobs.refresh_activity(tables, bitmaps=True) == [(2024, 1, 2)]
    assert made == [[(2,)]]
    assert rows_of(tables.read("monthly_active_users")) == [(2024, 1, 30)]
    assert jobs.refresh_bitmaps(tables, [(2024, 1)]) == []


def test_compaction_opens_no_day_again(tables):
    for batch in range(3):
        append_matches(tables, batch, match(batch, start=START + batch * 60), match(10 + batch, start=START + DAY + batch))
    close_days(tables, 1, 2)
    days = [(2024, 1, 1), (2024, 1, 2)]
    assert jobs.refresh_activity(tables, bitmaps=True) == days
    jobs.compact_days(tables, days)
    assert jobs.pending_dates(tables).count() == 0 and jobs.refresh_bitmaps(tables, [(2024, 1)]) == []
    append_matches(tables, 3, match(20, start=START + 500, team=players(accounts=range(50, 60))))
    assert jobs.refresh_activity(tables, compact=True) == days[:1]
    assert jobs.refresh_activity(tables) == []
    assert rows_of(tables.read("daily_active_users")) == [(2024, 1, 1, 20), (2024, 1, 2, 10)]
    # A refresh that compacts leaves one folder for the day.
    assert tables._scan("player_match").where("day = 1").select("batch").distinct().count() == 1


def scanned_rows(df):
    """Rows that the file scan hands on after row groups have been skipped."""
    df.collect()

    def scans(node):
        found = [node] if "FileSourceScanExec" in node.getClass().getName() else []
        children = node.children()
        kids = [children.apply(i) for i in range(children.size())]
        for inner in ("executedPlan", "plan"):
            if "AdaptiveSparkPlanExec" in node.getClass().getName() and inner == "executedPlan":
                kids.append(node.executedPlan())
            if "QueryStageExec" in node.getClass().getName() and inner == "plan":
                kids.append(node.plan())
        return found + [s for k in kids for s in scans(k)]

    return sum(s.metrics().apply("numOutputRows").value() for s in scans(df._jdf.queryExecution().executedPlan()))


def test_bloom_filters_skip_days_without_the_account(spark, tables):
    """Every day's accounts span the same range, so only the filter can tell the days apart."""
    rows = [(a, 2024, 1, day, 1, 1, 60) for day in range(1, 21) for a in [*range(day, 4000, 20), 4001]]
    rows.append((999_999, 2024, 1, 7, 1, 1, 60))
    rows += [(1_000_000, 2024, 1, day, 1, 1, 60) for day in range(1, 21)]
    tables.upsert("player_daily", spark.createDataFrame(rows, S.TABLES["player_daily"].schema))
    assert rows_of(tables.read("player_daily").where("account_id = 999999").select("day")) == [(7,)]
    everything = scanned_rows(tables.read("player_daily"))
    one = scanned_rows(tables.read("player_daily").where("account_id = 999999"))
    assert everything == len(rows) and one < everything / 5


def brute_bands(points, bands):
    return sorted((p, lo, hi, name) for p in points for lo, hi, name in bands if p is not None and None not in (lo, hi) and lo <= p <= hi)


def test_band_join_equals_brute_force(spark):
    random.seed(5)
    points = [random.randint(-10**12, 10**12) for _ in range(200)] + list(range(-20, 200)) + [None, 0, 0, 2**62, -(2**62)]
    bands = [(lo, lo + random.choice([0, 1, 5, 64, 10**6, 10**11, 10**12]), f"b{i}") for i, lo in enumerate(random.randint(-10**12, 10**12) for _ in range(60))]
    bands += [(0, 0, "point"), (5, 4, "empty"), (None, 3, "open"), (3, None, "open"), (-7, 150, "across"), (-7, 150, "again"), (-(2**61), 2**61, "all")]
    rows = spark.createDataFrame([(p,) for p in points], "p bigint")
    known = spark.createDataFrame(bands, "lo bigint, hi bigint, name string")
    joined = band_join(rows, known, "p")
    assert rows_of(joined.select("p", "lo", "hi", "name")) == brute_bands(points, bands)
    assert band_join(rows, known.where("false"), "p").count() == 0
    plan = joined._jdf.queryExecution().toString()
    assert "sequence(" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_wide_and_overlapping_ranges_of_regions(spark):
    clusters = spark.createDataFrame([(1,), (50,), (2_000_000,), (7,), (2_000_000_001,)], "cluster_id int")
    exact = spark.createDataFrame([(7, "exact")], "cluster_id int, region string")
    ranges = spark.createDataFrame([(0, 2_000_000_000, "wide"), (40, 60, "narrow"), (45, 65, "later")], "lo int, hi int, region string")
    found = dict(tuple(r) for r in with_region(clusters, exact, ranges).collect())
    assert found == {1: "wide", 50: "narrow", 2_000_000: "wide", 7: "exact", 2_000_000_001: None}
