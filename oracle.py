"""Expected results of the queries as SQL over the same Parquet tables."""

from __future__ import annotations

from matchlens.sources.clusters import CLUSTER_RANGES, CLUSTERS

MATCHES = """
ev AS (
  SELECT event_id // 10 AS match_id, CAST(event_id % 10 AS INTEGER) AS slot,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 AS INTEGER) AS hero_id,
         CASE WHEN user_id = 0 THEN 4294967295 ELSE user_id END AS account_id,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS sec
  FROM events),
m AS (
  SELECT match_id, min(sec) AS start_time, CAST(600 + max(cents) % 2400 AS INTEGER) AS duration,
         CAST(110 + match_id % 130 AS INTEGER) AS cluster,
         sum(CASE WHEN slot < 5 THEN cents END) >= sum(CASE WHEN slot >= 5 THEN cents END) AS radiant_win,
         CAST(CASE WHEN match_id % 17 = 0 THEN 9 ELSE 10 END AS INTEGER) AS human_players,
         CAST(CASE WHEN match_id % 13 = 0 THEN 4 ELSE 22 END AS INTEGER) AS game_mode,
         string_agg(CAST(hero_id AS VARCHAR), ' ' ORDER BY slot) AS heroes,
         string_agg(CAST(account_id AS VARCHAR), ' ' ORDER BY slot) AS accounts,
         count(hero_id) AS filled
  FROM ev GROUP BY match_id),
v AS (
  SELECT *, make_timestamp(start_time * 1000000) AS started FROM m
  WHERE human_players = 10 AND duration >= 1000 AND game_mode IN (1, 2, 3, 5, 16, 22) AND filled = 10),
p AS (
  SELECT v.*, ev.slot, ev.hero_id, ev.account_id,
         CAST(CASE WHEN (ev.slot < 5) = radiant_win THEN 1 ELSE 0 END AS INTEGER) AS win
  FROM v JOIN ev USING (match_id)),
pairs AS (
  SELECT a.match_id, a.start_time, a.slot AS slot1, b.slot AS slot2, a.hero_id AS hero_id1,
         b.hero_id AS hero_id2, a.win
  FROM p a JOIN p b ON a.match_id = b.match_id AND (a.slot < 5) = (b.slot < 5) AND a.slot <> b.slot),
counters AS (
  SELECT a.match_id, a.start_time, a.slot AS slot1, b.slot AS slot2, a.hero_id AS hero_id1,
         b.hero_id AS hero_id2, a.win
  FROM p a JOIN p b ON a.match_id = b.match_id AND (a.slot < 5) <> (b.slot < 5))
"""

# Count windows; within a match, meetings follow the first side's slot, then the second side's, then
# the row of the first side comes first.
WINDOWS = """,
hero_win AS (
  SELECT hero_id, w AS "window", CAST(sum(win) AS BIGINT) AS wins, count(*) AS played, max(start_time) AS latest,
         sum(win) / count(*) AS win_rate
  FROM (SELECT *, (row_number() OVER (PARTITION BY hero_id ORDER BY start_time, match_id, slot) - 1) // 100 AS w FROM p)
  GROUP BY hero_id, w HAVING count(*) = 100),
pair_win AS (
  SELECT hero_id1, hero_id2, w AS "window", CAST(sum(win) AS BIGINT) AS wins, count(*) AS played,
         max(start_time) AS latest, sum(win) / count(*) AS win_rate
  FROM (SELECT *, (row_number() OVER (PARTITION BY hero_id1, hero_id2
                   ORDER BY start_time, match_id, slot1, slot2) - 1) // 25 AS w FROM pairs)
  GROUP BY hero_id1, hero_id2, w HAVING count(*) = 25),
counter_win AS (
  SELECT hero_id1, hero_id2, w AS "window", CAST(sum(win) AS BIGINT) AS wins, count(*) AS played,
         max(start_time) AS latest, sum(win) / count(*) AS win_rate
  FROM (SELECT *, (row_number() OVER (PARTITION BY hero_id1, hero_id2
                   ORDER BY start_time, match_id, least(slot1, slot2), greatest(slot1, slot2), slot1) - 1) // 25 AS w
        FROM counters)
  GROUP BY hero_id1, hero_id2, w HAVING count(*) = 25),
messages AS (
  SELECT 'hero-win-rate' AS topic, hero_id || ',' || printf('%.3f', win_rate) AS value,
         CAST(hero_id AS VARCHAR) AS key, latest, win_rate FROM hero_win
  UNION ALL
  SELECT 'hero-pair-win-rate', hero_id1 || ',' || hero_id2 || ',' || printf('%.3f', win_rate),
         hero_id1 || ',' || hero_id2, latest, win_rate FROM pair_win
  UNION ALL
  SELECT 'hero-counter-pair-win-rate', 'counter,' || hero_id1 || ',' || hero_id2 || ',' || printf('%.3f', win_rate),
         'counter,' || hero_id1 || ',' || hero_id2, latest, win_rate FROM counter_win)
"""

_DAY = """CAST(year({0}) AS INTEGER) AS year, CAST(month({0}) AS INTEGER) AS month, CAST(day({0}) AS INTEGER) AS day"""
STARTED = _DAY.format("started")

PLAYER_MATCH = f""",
pm AS (
  SELECT account_id, {STARTED}, start_time * 1000 AS start_time, duration, hero_id, win = 1 AS win
  FROM p WHERE account_id <> 4294967295
  QUALIFY row_number() OVER (PARTITION BY account_id, start_time ORDER BY match_id DESC, slot DESC) = 1)
"""


def _values(text: str) -> list[list[str]]:
    return [line.split(",") for line in text.strip().splitlines()]


_EXACT = ", ".join(f"({cluster}, '{region}')" for cluster, region in _values(CLUSTERS))
_RANGES = ", ".join(f"({ids.replace('-', ', ')}, '{region}')" for ids, region in _values(CLUSTER_RANGES))
LOOKUP = f""",
exact(cluster_id, region) AS (VALUES {_EXACT}),
ranges(lo, hi, region) AS (VALUES {_RANGES}),
regioned AS (
  SELECT v.*, coalesce(e.region, r.region) AS region
  FROM v LEFT JOIN exact e ON v.cluster = e.cluster_id LEFT JOIN ranges r ON v.cluster BETWEEN r.lo AND r.hi)
"""

_FLAT = """SELECT match_id, radiant_win, start_time, duration, cluster, human_players, game_mode, heroes, accounts FROM v"""
_SIMPLE = """heroes || ' ' || CAST(radiant_win AS INTEGER) || ' ' || start_time * 1000"""
_RATES = "CAST(sum(win) AS BIGINT) AS wins, count(*) AS played, sum(win) / count(*) AS win_rate, max(start_time) AS latest"
_PLAYER_DAILY = """account_id, year, month, day, count(*) AS matches_played,
  CAST(sum(CAST(win AS INTEGER)) AS BIGINT) AS matches_won, CAST(sum(duration) AS BIGINT) AS time_played_in_sec"""
_PM_AS_TEXT = """SELECT account_id, year, month, day, start_time, duration, CAST(hero_id AS VARCHAR) AS hero_id, win FROM pm"""
# Days whose end the watermark (latest start minus the delay) has passed.
_CLOSED = "date_trunc('day', started) + INTERVAL 1 DAY <= (SELECT max(started) FROM v) - INTERVAL {} MINUTE"
_LATEST = """SELECT key, printf('%.3f', arg_max(win_rate, struct_pack(a := latest, b := win_rate))) AS value
  FROM messages GROUP BY key"""


def _best(source: str) -> str:
    return f"""SELECT hero_id1, hero_id2, wins, played, win_rate, latest,
  CAST(row_number() OVER (PARTITION BY hero_id1 ORDER BY win_rate DESC, played DESC, hero_id2) AS INTEGER) AS rank
  FROM (SELECT hero_id1, hero_id2, {_RATES} FROM {source} GROUP BY ALL) QUALIFY rank <= 5"""


def _matches(select: str, more: str = "") -> str:
    return f"WITH {MATCHES}{more} {select}"


def oracle_sql() -> dict[str, str]:
    event_day = _DAY.format("ts")
    sql = {
        "valid_matches": _matches(_FLAT),
        "hero_results": _matches("SELECT match_id, start_time, slot, hero_id, win FROM p"),
        "hero_pairs": _matches("SELECT * FROM pairs"),
        "hero_counters": _matches("SELECT * FROM counters"),
        "pair_keys": _matches("SELECT hero_id1 || ',' || hero_id2 AS pair_key, count(*) AS count FROM pairs GROUP BY 1"),
        "match_simple": _matches(f"SELECT match_id, {_SIMPLE} AS value FROM v"),
        "cluster_info": _matches("SELECT cluster AS cluster_id, start_time, CAST(10 AS BIGINT) AS players FROM v"),
        "player_results": _matches(
            "SELECT account_id, start_time, duration, hero_id, win = 1 AS win, match_id, slot FROM p "
            "WHERE account_id <> 4294967295"
        ),
        "hero_win_rate_daily": _matches(
            f"SELECT hero_id, {STARTED}, sum(win) / count(*) AS win_rate, count(*) AS count FROM p GROUP BY ALL"
        ),
        "hero_win_rate": _matches(f"SELECT hero_id, {_RATES} FROM p GROUP BY hero_id"),
        "pair_win_rate": _matches(f"SELECT hero_id1, hero_id2, {_RATES} FROM pairs GROUP BY ALL"),
        "counter_win_rate": _matches(f"SELECT hero_id1, hero_id2, {_RATES} FROM counters GROUP BY ALL"),
        "hero_sliding_win_rate": _matches(
            f"""SELECT hero_id, (start_time // 10800 - k) * 10800 AS window_start, {_RATES}
  FROM p CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS k) GROUP BY ALL"""
        ),
        "cluster_hourly_players": _matches(
            """SELECT cluster AS cluster_id, start_time // 3600 * 3600 AS window_start,
  CAST(count(*) * 10 AS BIGINT) AS num_of_players, max(start_time) AS latest FROM v GROUP BY ALL"""
        ),
        "hero_count_window": _matches("SELECT * FROM hero_win", WINDOWS),
        "pair_count_window": _matches("SELECT * FROM pair_win", WINDOWS),
        "counter_count_window": _matches("SELECT * FROM counter_win", WINDOWS),
        "hero_rolling_win_rate": _matches(
            """SELECT hero_id, match_id, slot, row_number() OVER all_rows AS position,
  CAST(sum(win) OVER last_rows AS BIGINT) AS wins, count(*) OVER last_rows AS played,
  sum(win) OVER last_rows / count(*) OVER last_rows AS win_rate
  FROM p WINDOW all_rows AS (PARTITION BY hero_id ORDER BY start_time, match_id, slot),
  last_rows AS (PARTITION BY hero_id ORDER BY start_time, match_id, slot ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)"""
        ),
        "hero_live_win_rate": _matches(
            f"""SELECT hero_id, {_RATES} FROM (SELECT * FROM p QUALIFY
  row_number() OVER (PARTITION BY hero_id ORDER BY start_time DESC, match_id DESC, slot DESC) <= 100)
  GROUP BY hero_id"""
        ),
        "best_teammates": _matches(_best("pairs")),
        "best_opponents": _matches(_best("counters")),
        "cluster_players_daily": _matches(
            f"""SELECT cluster AS cluster_id, {STARTED}, CAST(count(*) * 10 AS BIGINT) AS num_of_players,
  max(start_time) AS latest FROM v GROUP BY ALL"""
        ),
        "players_in_game": _matches(
            """SELECT cluster_id, time, delta, CAST(sum(delta) OVER (PARTITION BY cluster_id ORDER BY time) AS BIGINT) AS players
  FROM (SELECT cluster_id, time, CAST(sum(d) AS BIGINT) AS delta FROM (
    SELECT cluster AS cluster_id, start_time AS time, 10 AS d FROM v
    UNION ALL SELECT cluster, start_time + duration, -10 FROM v) GROUP BY cluster_id, time)"""
        ),
        "cluster_regions": _matches(
            "SELECT cluster AS cluster_id, start_time, CAST(10 AS BIGINT) AS players, region FROM regioned", LOOKUP
        ),
        "region_players_daily": _matches(
            f"SELECT region, {STARTED}, CAST(count(*) * 10 AS BIGINT) AS num_of_players FROM regioned GROUP BY ALL", LOOKUP
        ),
        "players_on_date": _matches(
            "SELECT region, CAST(count(*) * 10 AS BIGINT) AS num_of_players FROM regioned "
            "WHERE CAST(started AS DATE) = DATE '2024-01-10' GROUP BY region",
            LOOKUP,
        ),
        "player_match": _matches("SELECT * FROM pm", PLAYER_MATCH),
        "daily_player": _matches(
            "SELECT year, month, day, account_id, start_time AS time_, hero_id, duration FROM pm", PLAYER_MATCH
        ),
        "player_daily": _matches(f"SELECT {_PLAYER_DAILY} FROM pm GROUP BY ALL", PLAYER_MATCH),
        "player_activity": _matches(
            f"SELECT {_PLAYER_DAILY}, sum(duration) / 60 AS minutes FROM pm GROUP BY account_id, year, month, day",
            PLAYER_MATCH,
        ),
        "hero_history": _matches(
            f"""SELECT hero_id, {STARTED}, sum(win) / count(*) AS win_rate, count(*) AS count
  FROM p WHERE hero_id = 1 GROUP BY ALL"""
        ),
        "users_around": _matches(
            """SELECT year, month, day, count(DISTINCT account_id) AS num FROM pm
  WHERE make_date(year, month, day) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY ALL""",
            PLAYER_MATCH,
        ),
        "daily_accounts": f"SELECT DISTINCT {event_day}, user_id AS account_id FROM events",
        "dau_exact": f"SELECT {event_day}, count(DISTINCT user_id) AS num FROM events GROUP BY ALL",
        "dau_sorted": f"SELECT {event_day}, count(DISTINCT user_id) AS num FROM events GROUP BY ALL",
        "dau_matches": _matches(
            "SELECT year, month, day, count(DISTINCT account_id) AS num FROM pm GROUP BY ALL", PLAYER_MATCH
        ),
        "mau_exact": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  count(DISTINCT o_custkey) AS num FROM orders GROUP BY ALL""",
        "dau_hll_close": f"SELECT {event_day}, count(DISTINCT user_id) AS num, true AS close FROM events GROUP BY ALL",
        "mau_hll_close": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month, count(DISTINCT o_custkey) AS num, true AS close
  FROM orders GROUP BY ALL""",
        "mau_sketches_close": """SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  count(DISTINCT user_id) AS num, true AS close FROM events GROUP BY ALL""",
        "newest_items": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY CAST(l_shipdate AS DATE) DESC, l_partkey DESC, l_suppkey DESC) = 1""",
        "win_rate_messages": _matches("SELECT topic, value FROM messages", WINDOWS),
        "live_win_rate_latest": _matches(_LATEST, WINDOWS),
        "live_lookup": _matches(f"SELECT * FROM ({_LATEST}) WHERE key = '1'", WINDOWS),
        "bad_messages_ignored": _matches(_LATEST, WINDOWS),
        "orders_hll_close": """SELECT CAST(year(CAST(l_shipdate AS DATE)) AS INTEGER) AS year,
  count(DISTINCT l_orderkey) AS num, true AS close FROM lineitem GROUP BY ALL""",
        "malformed_lines": _matches(
            "SELECT count(*) FILTER (match_id % 7 = 0) AS malformed, count(*) + count(*) FILTER (match_id % 7 = 0) AS total FROM v"
        ),
        "dump_roundtrip": _matches(_FLAT),
        "crawler_lines": _matches(_FLAT),
        "malformed_dump_lines": _matches(
            "SELECT count(*) FILTER (match_id % 7 = 0) AS malformed, count(*) + count(*) FILTER (match_id % 7 = 0) AS total FROM v"
        ),
        "json_roundtrip": _matches(_FLAT),
        "bare_json_roundtrip": _matches(_FLAT),
        "split_roundtrip": _matches(_FLAT),
        "upserted_days": _matches(
            f"""SELECT year, month, day, coalesce(b.num, a.num) AS num
  FROM (SELECT {event_day}, count(DISTINCT user_id) AS num FROM events GROUP BY ALL) a
  LEFT JOIN (SELECT year, month, day, count(DISTINCT account_id) AS num FROM pm GROUP BY ALL) b USING (year, month, day)""",
            PLAYER_MATCH,
        ),
        "stream_hero_days": _matches(
            f"""SELECT CAST(hero_id AS VARCHAR) AS hero_id, {STARTED}, sum(win) / count(*) AS win_rate, count(*) AS count
  FROM p WHERE {_CLOSED.format(90)} GROUP BY ALL"""
        ),
        "stream_cluster_days": _matches(
            f"""SELECT cluster AS cluster_id, {STARTED}, CAST(count(*) * 10 AS BIGINT) AS num_of_players
  FROM v WHERE {_CLOSED.format(10)} GROUP BY ALL"""
        ),
        "stream_messages": _matches("SELECT topic, value FROM messages", WINDOWS),
        "stream_live_values": _matches(_LATEST, WINDOWS),
        "stream_player_match": _matches(_PM_AS_TEXT, PLAYER_MATCH),
        "stream_match_simple": _matches(f"SELECT {_SIMPLE} AS value FROM v"),
    }
    pending = f"""SELECT DISTINCT {STARTED} FROM v WHERE CAST(started AS DATE) > DATE '2024-01-03'
  AND CAST(started AS DATE) NOT IN (
    SELECT CAST(ts AS DATE) FROM events WHERE dayofweek(ts) IN (0, 6))"""
    sql["new_dates"] = _matches(pending)
    sql["next_date"] = _matches(f"SELECT * FROM ({pending}) ORDER BY year, month, day LIMIT 1")
    closed = f"""{PLAYER_MATCH}, closed AS (
  SELECT DISTINCT {STARTED} FROM v WHERE {_CLOSED.format(90)})"""
    sql["refresh_player_daily"] = _matches(
        f"SELECT {_PLAYER_DAILY} FROM pm JOIN closed USING (year, month, day) GROUP BY ALL", closed
    )
    sql["refresh_after_lagging_facts"] = sql["refresh_player_daily"]
    early = f"""{PLAYER_MATCH}, early AS (SELECT * FROM v WHERE match_id % 3 <> 0), closed AS (
  SELECT DISTINCT {STARTED} FROM early WHERE {_CLOSED.format(90).replace("FROM v", "FROM early")})"""
    sql["refresh_with_late_facts"] = _matches(
        f"SELECT {_PLAYER_DAILY} FROM pm JOIN closed USING (year, month, day) GROUP BY ALL", early
    )
    sql["refresh_daily_users"] = _matches(
        "SELECT year, month, day, count(DISTINCT account_id) AS num FROM pm JOIN closed USING (year, month, day) GROUP BY ALL",
        closed,
    )
    sql["refresh_monthly_users"] = _matches(
        """SELECT year, month, count(DISTINCT account_id) AS num FROM pm
  WHERE (year, month) IN (SELECT (year, month) FROM closed) GROUP BY ALL""",
        closed,
    )
    sql["refresh_monthly_bitmaps"] = _matches(
        """SELECT year, month, count(DISTINCT account_id) AS num FROM pm
  WHERE (year, month) IN (SELECT (year, month) FROM closed) GROUP BY ALL""",
        early,
    )
    sql["refresh_by_difference"] = sql["refresh_with_late_facts"]
    sql["refresh_users_by_difference"] = _matches(
        "SELECT year, month, day, count(DISTINCT account_id) AS num FROM pm JOIN closed USING (year, month, day) GROUP BY ALL",
        early,
    )
    sql["refresh_monthly_sketches_stored"] = _matches(
        """SELECT year, month, count(DISTINCT account_id) AS num, true AS close FROM pm
  WHERE (year, month) IN (SELECT (year, month) FROM closed) GROUP BY ALL""",
        closed,
    )
    sql["mau_bitmaps"] = sql["mau_exact"]
    late = {
        delay: f"""(match_id % 3 = 0 AND date_trunc('day', started) + INTERVAL 1 DAY
  <= (SELECT max(started) FROM v WHERE match_id % 3 <> 0) - INTERVAL {delay} MINUTE)"""
        for delay in (90, 10)
    }
    sql["stream_late_dropped"] = _matches(
        f"""SELECT CAST(hero_id AS VARCHAR) AS hero_id, {STARTED}, sum(win) / count(*) AS win_rate, count(*) AS count
  FROM p WHERE {_CLOSED.format(90)} AND NOT {late[90]} GROUP BY ALL"""
    )
    sql["stream_late_clusters_dropped"] = _matches(
        f"""SELECT cluster AS cluster_id, {STARTED}, CAST(count(*) * 10 AS BIGINT) AS num_of_players
  FROM v WHERE {_CLOSED.format(10)} AND NOT {late[10]} GROUP BY ALL"""
    )
    rejects = f"""SELECT 'malformed' AS reason, match_id FROM v WHERE match_id % 3 <> 0 AND match_id % 7 = 0
  UNION ALL SELECT 'late for heroes', match_id FROM v WHERE {late[90]}
  UNION ALL SELECT 'late for clusters', match_id FROM v WHERE {late[10]}"""
    sql["reject_rows"] = _matches(rejects)
    sql["reject_totals"] = _matches(f"SELECT reason, count(*) AS lines FROM ({rejects}) GROUP BY reason")
    outputs = {
        "hero_win_rate": (f"SELECT hero_id, {STARTED}, count(*) AS x FROM p WHERE {_CLOSED.format(90)} GROUP BY ALL", "x"),
        "region_num_of_players": (f"SELECT cluster, {STARTED}, count(*) * 10 AS x FROM v WHERE {_CLOSED.format(10)} GROUP BY ALL", "x"),
        "player_match": ("SELECT account_id AS x FROM pm", "x"),
        "daily_player": ("SELECT duration AS x FROM pm", "x"),
        "match_simple": (f"SELECT {_SIMPLE} AS x FROM v", "length(x)"),
        "messages": ("SELECT value AS x FROM messages", "length(x)"),
    }
    sql["stream_all_outputs"] = _matches(
        " UNION ALL ".join(
            f"SELECT '{name}' AS output, count(*) AS n, CAST(sum({total}) AS BIGINT) AS total FROM ({rows})"
            for name, (rows, total) in outputs.items()
        ),
        PLAYER_MATCH + WINDOWS,
    )
    sql["stream_rolling_win_rate"] = sql["hero_rolling_win_rate"]
    sql["stream_players_in_game"] = _matches(
        """SELECT cluster_id, time, delta, CAST(sum(delta) OVER (PARTITION BY cluster_id ORDER BY time) AS BIGINT) AS players
  FROM (SELECT cluster_id, time, CAST(sum(d) AS BIGINT) AS delta FROM (
    SELECT cluster AS cluster_id, start_time AS time, 10 AS d FROM v
    UNION ALL SELECT cluster, start_time + duration, -10 FROM v)
    WHERE time <= (SELECT max(start_time) FROM v) - 90 * 60 GROUP BY cluster_id, time)"""
    )
    sql["live_values_from_state"] = sql["stream_live_values"]
    sql["message_stream_values"] = _matches(
        "SELECT topic, key, printf('%.3f', win_rate) AS value FROM messages", WINDOWS
    )
    sql["stream_messages_batches"] = sql["stream_messages"]
    sql["stream_replays_dropped"] = sql["stream_hero_days"]
    sql["arrival_windows"] = _matches(
        """SELECT cluster AS cluster_id, (start_time + duration) // 3600 * 3600 AS window_start,
  CAST(count(*) * 10 AS BIGINT) AS num_of_players, max(start_time) AS latest FROM v
  WHERE ((start_time + duration) // 3600 + 1) * 3600 <= (SELECT max(start_time + duration) FROM v) GROUP BY ALL"""
    )
    sql["split_dump_roundtrip"] = sql["dump_roundtrip"].replace(_FLAT, _FLAT.replace(" FROM", ", true AS within FROM", 1))
    sql["order_price_bands"] = """WITH o AS (SELECT CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
  b AS (SELECT s_nationkey, CAST(min(round(s_acctbal * 100)) * 20 AS BIGINT) AS lo, CAST(max(round(s_acctbal * 100)) * 40 AS BIGINT) AS hi
    FROM supplier GROUP BY s_nationkey)
  SELECT s_nationkey, count(*) AS orders, CAST(sum(cents) AS BIGINT) AS cents FROM o JOIN b ON cents BETWEEN lo AND hi GROUP BY s_nationkey"""
    return sql
