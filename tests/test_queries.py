"""Every registered query against its SQL on the given tables."""

import pytest
from compare import compare, duck

import __spark_entry__ as contract
from matchlens.plans.catalog import catalog
from oracle import oracle_sql

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, SQL = catalog(), oracle_sql()
# Too few rows per key for full count windows in the smallest tables.
NEED_MEDIUM = {
    "hero_count_window", "pair_count_window", "counter_count_window", "win_rate_messages",
    "live_win_rate_latest", "stream_messages", "stream_live_values", "live_lookup", "bad_messages_ignored",
    "orders_hll_close", "message_stream_values", "stream_messages_batches", "live_values_from_state", "stream_all_outputs",
}


@pytest.fixture(scope="module")
def engines():
    return {folder: duck(folder) for folder in (SMALL, MEDIUM)}


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"dau_hll", "mau_hll", "mau_from_daily_sketches"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, engines, name):
    folder = MEDIUM if name in NEED_MEDIUM else SMALL
    assert compare(QUERIES[name](spark, folder), engines[folder], SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 410


@pytest.mark.parametrize(
    "sketched, exact",
    [
        ("dau_hll", "SELECT year(ts) AS year, month(ts) AS month, day(ts) AS day, count(DISTINCT user_id) AS num FROM events GROUP BY ALL"),
        ("mau_hll", "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(DISTINCT o_custkey) AS num FROM orders GROUP BY ALL"),
        ("mau_from_daily_sketches", "SELECT year(ts) AS year, month(ts) AS month, count(DISTINCT user_id) AS num FROM events GROUP BY ALL"),
    ],
)
def test_sketches_are_close(spark, engines, sketched, exact):
    """Within three standard errors of a 12-bit sketch."""
    rows = {tuple(r)[:-1]: r["num"] for r in QUERIES[sketched](spark, MEDIUM).collect()}
    expected = {r[:-1]: r[-1] for r in engines[MEDIUM].sql(exact).fetchall()}
    assert rows.keys() == expected.keys()
    for key, num in expected.items():
        assert abs(rows[key] - num) <= 0.05 * num + 1
