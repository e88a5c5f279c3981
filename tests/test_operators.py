"""Edge rows of validation, expansion, aggregates, windows and dates, against plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from rows import DAY, START, frame, match, players

from matchlens import schema as S
from matchlens.operators import activity, expand, regions, sequence, winrate
from matchlens.operators.dates import in_month, on_day, parse_day, parse_month
from matchlens.operators.keyed import latest_values, newest_rows
from matchlens.operators.validate import public_accounts, valid_matches
from matchlens.sources.clusters import default_clusters, default_ranges


def ids(df):
    return sorted(r["match_id"] for r in df.collect())


def test_validity(spark):
    good = [match(i, mode=m) for i, m in enumerate(S.GAME_MODES)]
    bad = [
        match(10, duration=999), match(11, humans=9), match(12, mode=4), match(13, team=players()[:9]), match(14, mode=None),
    ]
    rows = frame(spark, *good, *bad, match(15, duration=1000))
    assert ids(valid_matches(rows)) == [0, 1, 2, 3, 4, 5, 15]
    assert 10 in ids(valid_matches(rows, min_duration=600))


def test_rows_per_match(spark):
    m = frame(spark, match(1, win=True), match(2, win=False))
    for build, count, wins in ((expand.hero_results, 10, 5), (expand.hero_pairs, 40, 20), (expand.hero_counters, 50, 25)):
        sizes = build(m).groupBy("match_id").agg(F.count("*").alias("n"), F.sum("win").alias("w")).collect()
        assert [(r["n"], r["w"]) for r in sizes] == [(count, wins)] * 2
    first = {r["hero_id"]: r["win"] for r in expand.hero_results(m).where("match_id = 2").collect()}
    assert [first[h] for h in range(1, 11)] == [0] * 5 + [1] * 5


def test_private_accounts(spark):
    team = players(accounts=[S.PRIVATE_ACCOUNT] * 9 + [45475622])
    m = frame(spark, match(1, team=team))
    assert expand.hero_results(m).count() == 10
    assert expand.cluster_info(m).first()["players"] == 10
    assert [r["account_id"] for r in expand.player_results(m).collect()] == [45475622]
    accounts = spark.createDataFrame([(S.PRIVATE_ACCOUNT,), (1,)], "account_id bigint")
    assert public_accounts(accounts).count() == 1


def test_match_simple(spark):
    m = frame(spark, match(1, win=False))
    heroes = "1 2 3 4 5 6 7 8 9 10"
    assert expand.match_simple(m).first()["value"] == f"{heroes} 0 {START}000"
    assert expand.match_simple(m, compat=True).first()["value"] == f"{heroes} 0{START}000"


@pytest.mark.parametrize(
    "start, expected",
    [
        (START - 1, (2023, 12, 31)),
        (START, (2024, 1, 1)),
        (1709251199, (2024, 2, 29)),
        (1709251200, (2024, 3, 1)),
    ],
)
def test_utc_days(spark, start, expected):
    previous = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = expand.player_match_rows(frame(spark, match(start=start))).first()
            assert (row["year"], row["month"], row["day"]) == expected
            assert row["start_time"] == start * 1000
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def random_matches(seed, count, hot=False, heroes=12, copies=1):
    """Matches in which hero 1 is in most games if ``hot``, some of them repeated ``copies`` times."""
    rnd = random.Random(seed)
    rows = []
    for i in range(count):
        team = rnd.sample(range(1, heroes + 1), 10)
        if hot and 1 not in team:
            team[rnd.randrange(10)] = 1
        row = match(i, rnd.random() < 0.5, START + rnd.randrange(5) * 60, cluster=100 + i % 3, team=players(team))
        rows += [row] * (copies if i % 10 == 0 else 1)
    return rows


def expected_windows(rows, kind, size):
    """Brute force: results of each key in order, cut into windows."""
    results = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        win, heroes = row[1], [p[2] for p in row[7]]
        if kind is sequence.HERO:
            emitted = [((heroes[i],), int((i < 5) == win)) for i in range(10)]
        elif kind is sequence.PAIR:
            emitted = [
                ((heroes[i], heroes[j]), int((i < 5) == win))
                for i in range(10) for j in range(10) if i != j and (i < 5) == (j < 5)
            ]
        else:
            emitted = []
            for i in range(5):
                for j in range(5, 10):
                    emitted += [((heroes[i], heroes[j]), int(win)), ((heroes[j], heroes[i]), 1 - int(win))]
        for key, won in emitted:
            results[key].append((won, row[2]))
    windows = {}
    for key, seen in results.items():
        for w in range(len(seen) // size):
            part = seen[w * size : (w + 1) * size]
            windows[(*key, w)] = (sum(p[0] for p in part), max(p[1] for p in part))
    return windows


@pytest.mark.parametrize("kind", sequence.KINDS, ids=lambda k: k.topic)
@pytest.mark.parametrize("hot, copies", [(False, 1), (True, 1), (True, 40)])
def test_count_windows(spark, kind, hot, copies):
    rows = random_matches(3, 120, hot, copies=copies)
    expected = expected_windows(rows, kind, 7)
    found = kind.windows(sequence.chunk_matches(frame(spark, *rows), chunks=5), 7).collect()
    names = ["hero_id"] if kind is sequence.HERO else ["hero_id1", "hero_id2"]
    assert {(*[r[n] for n in names], r["window"]): (r["wins"], r["latest"]) for r in found} == expected
    assert len(found) == len(expected)


@pytest.mark.parametrize("block", [8, 20, 1000])
def test_copies_are_split_into_pieces(spark, monkeypatch, block):
    monkeypatch.setattr(sequence, "COPIES_PER_PIECE", 4)
    monkeypatch.setattr(sequence, "COPIES_PER_BLOCK", block)
    rows = random_matches(5, 30, copies=30)
    chunked = sequence.chunk_matches(frame(spark, *rows), chunks=3)
    assert chunked.agg(F.max("copies")).first()[0] == 4
    assert chunked.agg(F.sum("copies")).first()[0] == len(rows)
    found = sequence.HERO.windows(chunked, 7).collect()
    expected = expected_windows(rows, sequence.HERO, 7)
    assert {(r["hero_id"], r["window"]): (r["wins"], r["latest"]) for r in found} == expected


def test_copies_of_one_match_spread_over_chunks(spark):
    rows = [match(1)] * 200 + [match(i, start=START + i) for i in range(2, 30)]
    sizes = sequence.chunk_matches(frame(spark, *rows), chunks=4).groupBy("chunk").count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) <= 20


def test_window_counts(spark):
    """n-1, n, n+1 and 2n results give 0, 1, 1 and 2 windows."""
    for games, windows in ((99, 0), (100, 1), (101, 1), (200, 2)):
        m = frame(spark, *[match(i, start=START + i) for i in range(games)])
        found = sequence.HERO.windows(sequence.chunk_matches(m)).where("hero_id = 1").count()
        assert found == windows


@pytest.mark.parametrize("copies", [1, 30])
def test_rolling_win_rate(spark, copies):
    rows = random_matches(4, 80, hot=True, copies=copies)
    chunked = sequence.chunk_matches(frame(spark, *rows), chunks=5)
    rolled = sequence.rolling_win_rate(sequence.HERO.rows(chunked), ("hero_id",), 7, block=10)
    found = {(r["hero_id"], r["position"]): (r["wins"], r["played"]) for r in rolled.collect()}
    results = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        for i, p in enumerate(row[7]):
            results[p[2]].append(int((i < 5) == row[1]))
    expected = {
        (hero, i + 1): (sum(seen[max(0, i - 6) : i + 1]), min(i + 1, 7)) for hero, seen in results.items() for i in range(len(seen))
    }
    assert found == expected


def test_pair_rates_by_halves(spark):
    """Unordered aggregation equals aggregation of all ordered rows, also with equal heroes."""
    rows = random_matches(6, 60) + [match(900, True, team=players([1, 1, 2, 3, 4, 1, 2, 2, 5, 6]))]
    m = frame(spark, *rows)
    keys = ["hero_id1", "hero_id2"]
    for fast, full in ((winrate.pair_win_rate, expand.hero_pairs), (winrate.counter_win_rate, expand.hero_counters)):
        plain = winrate.win_rate(full(m), keys)
        assert fast(m).select(plain.columns).exceptAll(plain).count() == 0
        assert plain.exceptAll(fast(m).select(plain.columns)).count() == 0


def test_players_in_game(spark):
    rows = random_matches(8, 60)
    found = {(r["cluster_id"], r["time"]): r["players"] for r in regions.players_in_game(frame(spark, *rows)).collect()}
    changes = Counter()
    for r in rows:
        changes[(r[4], r[2])] += 10
        changes[(r[4], r[2] + r[3])] -= 10
    for (cluster, time), players_now in found.items():
        assert players_now == sum(d for (c, t), d in changes.items() if c == cluster and t <= time)
    assert set(found) == set(changes)


def test_players_in_game_over_midnight(spark):
    rows = [match(1, start=START + DAY - 600, duration=1800), match(2, start=START + DAY, duration=1000)]
    found = {r["time"] - START - DAY: r["players"] for r in regions.players_in_game(frame(spark, *rows)).collect()}
    assert found == {-600: 10, 0: 20, 1000: 10, 1200: 0}


def test_regions(spark):
    clusters = spark.createDataFrame([(113,), (155,), (999,), (131,)], "cluster_id int")
    found = regions.with_region(clusters, default_clusters(spark), default_ranges(spark)).collect()
    assert {r["cluster_id"]: r["region"] for r in found} == {
        113: "United States", 155: "Southeast Asia", 999: None, 131: "Europe West",
    }


def test_sorted_users_equal_exact_users(spark):
    rnd = random.Random(1)
    rows = [(2024, 1, rnd.choice([1, 1, 1, 2, 3]), rnd.choice([7] * 5 + list(range(40))), START * 1000 + rnd.randrange(DAY * 1000)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "year int, month int, day int, account_id bigint, time_ bigint")
    exact = {tuple(r) for r in activity.active_users(df).collect()}
    assert {tuple(r) for r in activity.active_users_sorted(df).collect()} == exact
    assert {tuple(r) for r in activity.active_users_sorted(df, buckets=1).collect()} == exact


def test_newest_rows_and_values(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("b", 1, "w")], "key string, ts int, value string")
    assert {(r["key"], r["ts"]) for r in newest_rows(rows, ["key"], ["ts"]).collect()} == {("a", 2), ("b", 1)}
    assert {tuple(r) for r in latest_values(rows).select("key", "value").collect()} == {("a", "y"), ("b", "z")}


def test_best_partners(spark):
    rates = spark.createDataFrame(
        [(1, 2, 0.5, 10), (1, 3, 0.5, 20), (1, 4, 0.9, 1), (1, 5, 0.5, 10), (2, 1, 0.1, 10)],
        "hero_id1 int, hero_id2 int, win_rate double, played bigint",
    )
    top = winrate.best_partners(rates, k=2, min_played=5).orderBy("hero_id1", "rank").collect()
    assert [(r["hero_id1"], r["hero_id2"], r["rank"]) for r in top] == [(1, 3, 1), (1, 2, 2), (2, 1, 1)]
    worst = winrate.best_partners(rates, k=1, best=False).where("hero_id1 = 1").first()
    assert worst["hero_id2"] == 3


@pytest.mark.parametrize("text", ["2024-1-1", "2024/01/01", "20240101", "2024-13-01", "", "2024-01-01 "])
def test_bad_days(text):
    with pytest.raises(ValueError):
        parse_day(text)


@pytest.mark.parametrize("text", ["2024-1", "2024", "2024-00", "2024-01-01"])
def test_bad_months(text):
    with pytest.raises(ValueError):
        parse_month(text)


def test_date_filters(spark):
    rows = spark.createDataFrame([(2024, 1, 5), (2024, 1, 6), (2024, 2, 5)], "year int, month int, day int")
    assert [tuple(r) for r in rows.where(on_day("2024-01-05")).collect()] == [(2024, 1, 5)]
    assert rows.where(in_month("2024-01")).count() == 2


def test_expanded_rows_are_never_broadcast(spark):
    matches = frame(spark, *[match(i, start=START + i) for i in range(20)])
    rows = sequence.with_positions(sequence.keyed_results(sequence.chunk_matches(matches)), sequence.WINDOW_KEY)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
