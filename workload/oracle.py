"""The SQL of each query, for an engine that knows recursive queries and as-of joins."""

from __future__ import annotations

AS_OF = "2000-01-01 12:00:00"

MATCHES = """
m0 AS (
  SELECT o_orderkey AS match_id, o_orderdate::DATE AS matchdate, o_custkey // 5 AS pool,
         (o_custkey % 5)::INTEGER AS a, ((o_custkey + 1 + o_orderkey % 4) % 5)::INTEGER AS b,
         o_totalprice > 250000 AS won
  FROM orders),
m AS MATERIALIZED (
  SELECT match_id, matchdate, pool, a, b, won, 5 AS places,
         'c' || (pool * 5 + a) AS player1, 'c' || (pool * 5 + b) AS player2,
         CASE WHEN won THEN 6 ELSE (match_id % 6)::INTEGER END AS player1score,
         CASE WHEN won THEN (match_id % 6)::INTEGER ELSE 6 END AS player2score,
         CASE WHEN won THEN 'c' || (pool * 5 + a) ELSE 'c' || (pool * 5 + b) END AS winner,
         row_number() OVER (PARTITION BY pool ORDER BY matchdate, match_id) AS rn
  FROM m0)"""

# The same for other pools: player numbers 0..999 inside each pool.
OPEN = """
m0 AS (
  SELECT o_orderkey AS match_id, o_orderdate::DATE AS matchdate, {pool} AS pool,
         (o_custkey % 1000)::INTEGER AS a,
         ((o_custkey % 1000 + 1 + o_orderkey % 999) % 1000)::INTEGER AS b, o_totalprice > 250000 AS won
  FROM orders),
m AS MATERIALIZED (
  SELECT match_id, matchdate, pool, a, b, won, 1000 AS places, a::VARCHAR AS player1, b::VARCHAR AS player2,
         CASE WHEN won THEN a ELSE b END::VARCHAR AS winner,
         row_number() OVER (PARTITION BY pool ORDER BY matchdate, match_id) AS rn
  FROM m0)"""

# One pool of four players to each customer.
CROWDED = """
m0 AS (
  SELECT o_orderkey AS match_id, o_orderdate::DATE AS matchdate, 0 AS pool, (o_custkey * 4 + o_orderkey % 4)::INTEGER AS a,
         (o_custkey * 4 + o_orderkey % 4 + 1 + o_orderkey * 31 % 997)::INTEGER AS b, o_totalprice > 250000 AS won
  FROM orders),
m AS MATERIALIZED (
  SELECT match_id, matchdate, pool, a, b, won, (SELECT max(b) + 1 FROM m0) AS places, a::VARCHAR AS player1,
         b::VARCHAR AS player2, CASE WHEN won THEN a ELSE b END::VARCHAR AS winner,
         row_number() OVER (PARTITION BY pool ORDER BY matchdate, match_id) AS rn
  FROM m0)"""

# One step per match of a pool; the ratings of the pool are a list.
LOG = """
steps AS (
  SELECT pool, 0::BIGINT AS rn, [1500 FOR i IN range(max(places))] AS state,
         NULL::BIGINT AS match_id, 0 AS r1, 0 AS r2, 0 AS d
  FROM m GROUP BY pool
  UNION ALL
  SELECT pool, rn,
         [CASE WHEN i = a + 1 THEN r1 + d WHEN i = b + 1 THEN r2 - d ELSE state[i] END FOR i IN range(1, len(state) + 1)],
         match_id, r1, r2, d
  FROM (
    SELECT s.pool, n.rn, s.state, n.match_id, n.a, n.b, s.state[n.a + 1] AS r1, s.state[n.b + 1] AS r2,
           CASE WHEN n.won
                THEN round_even(32 * (1 - 1 / (1 + pow(10, (s.state[n.b + 1] - s.state[n.a + 1]) / 400.0))), 0)::INTEGER
                ELSE -round_even(32 * (1 - 1 / (1 + pow(10, (s.state[n.a + 1] - s.state[n.b + 1]) / 400.0))), 0)::INTEGER
           END AS d
    FROM steps s JOIN m n ON n.pool = s.pool AND n.rn = s.rn + 1)),
log AS MATERIALIZED (
  SELECT m.match_id, m.pool, m.player1, m.player2, r1 AS player1_elo_before, r2 AS player2_elo_before,
         r1 + d AS player1_elo_after, r2 - d AS player2_elo_after, d AS elo_change_p1, -d AS elo_change_p2,
         m.winner, m.matchdate
  FROM steps JOIN m ON m.match_id = steps.match_id)"""

SHOW_LOG = """
SELECT match_id, player1, player2, player1_elo_before, player2_elo_before, player1_elo_after, player2_elo_after,
       elo_change_p1, elo_change_p2, winner, matchdate::VARCHAR AS match_date FROM log"""

RANKS = """
ranks AS (
  SELECT player, arg_max(elo, (matchdate, match_id)) AS elo FROM (
    SELECT player1 AS player, player1_elo_after AS elo, matchdate, match_id FROM log
    UNION ALL SELECT player2, player2_elo_after, matchdate, match_id FROM log)
  GROUP BY player)"""

# Ratings and counts strictly before a day: the last row of each earlier day, by as-of join.
STATES = """
tall AS (
  SELECT player1 AS player, matchdate AS d, match_id, player1_elo_after AS own, player1_elo_after AS slot FROM log
  UNION ALL SELECT player2, matchdate, match_id, player2_elo_after, player1_elo_after FROM log),
days AS (
  SELECT player, d, own, slot, row_number() OVER (PARTITION BY player ORDER BY d, match_id) AS n FROM tall
  QUALIFY row_number() OVER (PARTITION BY player, d ORDER BY match_id DESC) = 1),
asof1 AS (SELECT q.match_id, f.own, f.slot, coalesce(f.n, 0) AS n
          FROM m q ASOF LEFT JOIN days f ON q.player1 = f.player AND q.matchdate > f.d),
asof2 AS (SELECT q.match_id, f.own, f.slot, coalesce(f.n, 0) AS n
          FROM m q ASOF LEFT JOIN days f ON q.player2 = f.player AND q.matchdate > f.d)"""

LINES = """
lines AS (
  SELECT l_orderkey AS id, l_linenumber AS line, 'bm' || l_linenumber AS bookmaker,
         1 + max(l_quantity) / 10 AS v1, 1 + max(l_extendedprice) / 20000 AS v2
  FROM lineitem GROUP BY ALL),
best AS (
  SELECT id, max(v1) FILTER (line NOT IN (2, 3)) AS b1, max(v2) FILTER (line <> 5) AS b2 FROM lines GROUP BY id)"""

PRED = """
pred AS (
  SELECT m.match_id, m.matchdate, m.player1, m.player2,
         coalesce(asof1.own, 1500)::DOUBLE AS e1, coalesce(asof2.own, 1500)::DOUBLE AS e2,
         asof1.n AS n1, asof2.n AS n2, b1, b2,
         1 / (1 + pow(10, (coalesce(asof2.own, 1500) - coalesce(asof1.own, 1500)) / 400.0)) AS p1
  FROM m JOIN asof1 USING (match_id) JOIN asof2 USING (match_id) LEFT JOIN best ON best.id = m.match_id)"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts) + "\n"


POOLED = (MATCHES, LOG)
R = "round({}, 9) AS {}".format

GATE = """
g AS (
  SELECT match_id, CASE WHEN match_id % 11 = 0 THEN NULL ELSE matchdate END AS matchdate,
         CASE WHEN match_id % 7 = 0 THEN NULL WHEN match_id % 17 = 0 THEN ' ' ELSE player1 END AS player1,
         CASE WHEN match_id % 29 = 0 THEN player1 ELSE player2 END AS player2,
         CASE WHEN match_id % 5 = 0 THEN NULL WHEN match_id % 23 = 0 THEN 'nobody' ELSE winner END AS winner
  FROM m),
f AS (
  SELECT *, matchdate IS NULL AS f1, player1 IS NULL AS f2, player2 IS NULL AS f3, winner IS NULL AS f4,
         NOT coalesce(winner = player1 OR winner = player2, false) AS f5,
         NOT coalesce(player1 <> player2, false) AS f6
  FROM g)"""

KEYED = """
batch AS (
  SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderdate::DATE AS day,
         o_orderkey, o_totalprice, o_orderstatus FROM orders),
target AS (
  SELECT * FROM batch WHERE o_orderstatus = 'F'
  QUALIFY o_custkey IS NULL OR row_number() OVER (PARTITION BY o_custkey, day ORDER BY o_orderkey) = 1),
fresh AS (
  SELECT * FROM batch
  WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_custkey = batch.o_custkey AND t.day = batch.day)
  QUALIFY o_custkey IS NULL OR row_number() OVER (PARTITION BY o_custkey, day ORDER BY o_orderkey) = 1)"""

FORECASTS = """
f AS (
  SELECT l_orderkey, l_linenumber, round(l_discount * 10, 9) AS p, round(1 - l_discount * 10, 9) AS q,
         l_discount * 10 AS raw,
         CASE l_returnflag WHEN 'A' THEN 'a' WHEN 'N' THEN 'b' ELSE 'x' END AS winner,
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 END AS y FROM lineitem)"""

LANDED = """
landed AS (
  SELECT match_id, matchdate, player1, CASE WHEN match_id % 31 = 0 THEN NULL ELSE player2 END AS player2,
         player1score, CASE WHEN match_id % 37 = 0 THEN NULL ELSE player2score END AS player2score,
         CASE WHEN match_id % 3 = 2 THEN NULL ELSE winner END AS winner
  FROM m)"""

STAR = """
l AS (
  SELECT CASE WHEN l_partkey % 18 = 0 THEN NULL WHEN l_partkey % 9 = 0 THEN 'alt ' || l_partkey
              ELSE 'part ' || l_partkey END AS name,
         CASE WHEN l_linenumber = 4 THEN 0 ELSE l_extendedprice END AS price, l_quantity::INTEGER AS volume
  FROM lineitem),
items AS (SELECT name, row_number() OVER (ORDER BY name) AS id FROM (SELECT DISTINCT name FROM l WHERE name IS NOT NULL))"""


def _symbols(text: str) -> str:
    return (f"[replace(x, '$', '') FOR x IN regexp_extract_all({text}, '\\$?[A-Z]{{2,5}}') "
            "IF x NOT IN ('WSB', 'DD', 'YOLO', 'ETF', 'LOL')]")


def _plain(text: str) -> str:
    decoded = f"regexp_replace({text}, '<[^>]*>', '', 'gs')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        decoded = f"replace({decoded}, '{entity}', '{char}')"
    return f"trim(regexp_replace({decoded}, '\\s+', ' ', 'g'))"


POSTS = """
p AS (SELECT doc_id AS id, 1700000000 + doc_id * 3600 AS created_utc, source AS title, text AS selftext,
             (n_chars % 1000)::INTEGER AS score, (n_chars % 97)::INTEGER AS num_comments FROM documents)"""

TITLE = _plain("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")
HEADING = _plain("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")

PAGED = """
SELECT l_suppkey AS market, CASE WHEN l_partkey % 6 = 0 THEN 'alt ' || l_partkey ELSE 'part ' || l_partkey END AS name,
       CASE WHEN l_partkey % 7 = 0 THEN 0 ELSE max(l_extendedprice) END AS price, sum(l_quantity)::INTEGER AS volume
FROM lineitem
WHERE (l_partkey % 120 + 1) % 9 <> 0 AND l_partkey % 12 <> 0
GROUP BY l_suppkey, l_partkey"""

ALL = {
    "elo_log": _with(*POOLED) + SHOW_LOG,
    "elo_incremental": _with(*POOLED) + SHOW_LOG,
    "late_match": _with(*POOLED) + SHOW_LOG,
    "stream_rated": _with(*POOLED) + SHOW_LOG,
    "stream_state_rated": _with(*POOLED) + SHOW_LOG,
    "late_match_snapshot": _with(*POOLED) + SHOW_LOG,
    "elo_from_versions": _with(*POOLED) + SHOW_LOG,
    "elo_frontier": _with(CROWDED, LOG) + SHOW_LOG,
    "rankings_in_parts": _with(*POOLED, RANKS) + "SELECT player, elo FROM ranks",
    "elo_rankings": _with(*POOLED, RANKS) + "SELECT player, elo FROM ranks",
    "elo_single_pool": _with(OPEN.format(pool="0"), LOG) + SHOW_LOG,
    "elo_hot_pool": _with(OPEN.format(pool="CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 40 END"), LOG)
    + SHOW_LOG,
    "register_entities": _with(MATCHES) + """
SELECT DISTINCT player, 1500 AS elo FROM (
  SELECT player1 AS player FROM m UNION SELECT player2 FROM m)
WHERE player NOT IN (SELECT player1 FROM m WHERE matchdate < DATE '1995-07-01'
                     UNION SELECT player2 FROM m WHERE matchdate < DATE '1995-07-01')""",
    "unprocessed": _with(MATCHES) + """
SELECT match_id, player1, player2, matchdate::VARCHAR AS matchdate FROM m
WHERE match_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "pending": _with(MATCHES) + """
SELECT pool, count(*) AS n FROM m
WHERE match_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') GROUP BY pool""",
    "pending_count": "SELECT count(*) AS unprocessed FROM orders WHERE o_orderstatus <> 'F'",
    "asof_own": _with(*POOLED, STATES) + """
SELECT match_id, coalesce(asof1.own, -1) AS player1_elo, coalesce(asof2.own, -1) AS player2_elo
FROM asof1 JOIN asof2 USING (match_id)""",
    "asof_first_slot": _with(*POOLED, STATES) + """
SELECT match_id, coalesce(asof1.slot, -1) AS player1_elo, coalesce(asof2.slot, -1) AS player2_elo
FROM asof1 JOIN asof2 USING (match_id)""",
    "asof_count": _with(*POOLED, STATES) + """
SELECT match_id, asof1.n AS player1_match_count, asof2.n AS player2_match_count
FROM asof1 JOIN asof2 USING (match_id)""",
    "asof_null_value": """
WITH f AS (SELECT o_custkey, o_orderdate::DATE AS d, o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS v
           FROM orders),
q AS (SELECT DISTINCT o_custkey, d FROM f)
SELECT q.o_custkey, q.d::VARCHAR AS day,
       coalesce(arg_max(f.v, (f.d, f.o_orderkey)) FILTER (f.v IS NOT NULL), -1.0) AS last, count(f.o_orderkey) AS n
FROM q LEFT JOIN f ON f.o_custkey = q.o_custkey AND f.d < q.d GROUP BY q.o_custkey, q.d""",
    "lookup_default": """
SELECT o_orderkey, coalesce(c_nationkey, -1)::BIGINT AS nation
FROM orders LEFT JOIN customer ON c_custkey = o_custkey * 2""",
    "predict": _with(*POOLED, STATES, LINES, PRED) + f"""
SELECT match_id, matchdate::VARCHAR AS matchdate, player1, player2, n1::INTEGER AS player1_match_count,
       n2::INTEGER AS player2_match_count, e1 AS player1_elo, e2 AS player2_elo,
       {R('p1', 'predicted_p1_prob')}, {R('1 - p1', 'predicted_p2_prob')},
       {R('b1', 'best_p1_odds')}, {R('1 / b1', 'best_p1_implied_prob')}, {R('p1 - 1 / b1', 'value_p1')},
       {R('b2', 'best_p2_odds')}, {R('1 / b2', 'best_p2_implied_prob')}, {R('1 - p1 - 1 / b2', 'value_p2')}
FROM pred""",
    "backtest": _with(*POOLED, STATES, LINES, PRED) + f"""
SELECT pred.match_id + 1 AS prediction_id, pred.matchdate::VARCHAR AS matchdate, pred.player1, pred.player2,
       r.winner AS actual_winner, n1::INTEGER AS player1_match_count, n2::INTEGER AS player2_match_count,
       e1 AS player1_elo, e2 AS player2_elo, {R('p1', 'predicted_p1_prob')}, {R('1 - p1', 'predicted_p2_prob')},
       {R('b1', 'best_p1_odds')}, {R('1 / b1', 'best_p1_implied_prob')},
       {R('b2', 'best_p2_odds')}, {R('1 / b2', 'best_p2_implied_prob')},
       {R('-ln(CASE WHEN r.winner = pred.player1 THEN p1 ELSE 1 - p1 END)', 'log_loss')}
FROM pred JOIN (SELECT player1, player2, matchdate, arg_min(winner, match_id) AS winner FROM m GROUP BY ALL) r
  USING (player1, player2, matchdate)
WHERE pred.matchdate < TIMESTAMP '{AS_OF}'""",
    "match_chain": _with(
        MATCHES.replace("m AS MATERIALIZED (", "mall AS (") + """,
kept AS (SELECT *, row_number() OVER (PARTITION BY player1, player2, matchdate ORDER BY match_id) AS nth FROM mall),
m AS MATERIALIZED (
  SELECT match_id, matchdate, pool, a, b, won, places, player1, player2, winner,
         row_number() OVER (PARTITION BY pool ORDER BY matchdate, match_id) AS rn FROM kept WHERE nth = 1)""",
        LOG, STATES.replace("FROM m q", "FROM mall q"), LINES, PRED.replace("FROM m JOIN", "FROM mall AS m JOIN")) + f"""
, done AS (
  SELECT row_number() OVER (ORDER BY match_id) AS prediction_id, * FROM pred)
SELECT row_number() OVER (ORDER BY prediction_id) AS id, prediction_id, done.player1, done.player2,
       r.winner AS actual_winner, n1::INTEGER AS player1_match_count, {R('p1', 'predicted_p1_prob')},
       {R('b2', 'best_p2_odds')},
       {R('-ln(CASE WHEN r.winner = done.player1 THEN p1 ELSE 1 - p1 END)', 'log_loss')}
FROM done JOIN (SELECT player1, player2, matchdate, winner FROM m) r USING (player1, player2, matchdate)
WHERE done.matchdate < TIMESTAMP '{AS_OF}'""",
    "odds_refresh": _with(*POOLED, RANKS, LINES) + f"""
, t AS (
  SELECT m.match_id AS id, b1, b2, m.match_id % 3 = 0 AS stored, best.id IS NOT NULL
           AND m.match_id % 17 <> 0 AND m.match_id % 19 <> 0 AS readable,
         CASE WHEN m.match_id % 4 = 0 OR m.match_id % 13 = 0 THEN NULL WHEN winner = player1 THEN 1 ELSE 0 END AS y,
         1 / (1 + pow(10, (y2.elo - y1.elo) / 400.0)) AS p, 1 / b1 + 1 / b2 AS total
  FROM m LEFT JOIN best ON best.id = m.match_id
  JOIN ranks y1 ON y1.player = m.player1 JOIN ranks y2 ON y2.player = m.player2),
u AS (SELECT *, readable AND y IS NOT NULL AND total IS NOT NULL AS scored, (1 / b1) / total AS n FROM t)
SELECT id,
       CASE WHEN readable THEN round(b1, 9) END AS best_odd_player1,
       CASE WHEN readable THEN round(1 / b1, 9) ELSE -1 END AS win_prob_player1,
       CASE WHEN readable THEN round(b2, 9) END AS best_odd_player2,
       CASE WHEN readable THEN round(1 / b2, 9) ELSE -1 END AS win_prob_player2,
       CASE WHEN readable THEN round(total - 1, 9) ELSE -1 END AS implied_margin,
       CASE WHEN readable THEN round((1 / b1) / total, 9) ELSE -1 END AS norm_prob_player1,
       CASE WHEN readable THEN round((1 / b2) / total, 9) ELSE -1 END AS norm_prob_player2,
       CASE WHEN stored THEN 0.5 WHEN readable THEN round(p, 9) END::DOUBLE AS elo_prob_player1,
       CASE WHEN stored THEN 0.5 WHEN readable THEN round(1 - p, 9) END::DOUBLE AS elo_prob_player2,
       CASE WHEN scored THEN round((p - y) * (p - y), 9) ELSE -1 END AS brier_elo,
       CASE WHEN scored THEN round((n - y) * (n - y), 9) ELSE -1 END AS brier_bookmaker,
       CASE WHEN scored THEN round(-(y * ln(p) + (1 - y) * ln(1 - p)), 9) ELSE -1 END AS logloss_elo,
       CASE WHEN scored THEN round(-(y * ln(n) + (1 - y) * ln(1 - n)), 9) ELSE -1 END AS logloss_bookmaker
FROM u""",
    "best_odds": _with(LINES) + f"SELECT id, {R('b1', 'best_p1')}, {R('b2', 'best_p2')} FROM best",
    "odds_variant": _with(LINES, """
priced AS (
  SELECT id, 'bm' || line || '_P1' AS name, v1 AS price FROM lines WHERE line <= 4
  UNION ALL SELECT id, 'bm' || line || '_P2', v2 FROM lines WHERE line <= 3
  UNION ALL SELECT id, 'bm3_P3', 7 FROM lines WHERE line = 3),
kept AS (SELECT *, id % 17 <> 0 AND id % 19 <> 0 AND id % 23 <> 0 AS readable FROM (SELECT DISTINCT id FROM lines))""") + """
SELECT k.id, readable, coalesce(string_agg(name, ',' ORDER BY name), '') AS names,
       round(max(price) FILTER (name LIKE '%_P1'), 9) AS best_p1, round(max(price) FILTER (name LIKE '%_P2'), 9) AS best_p2
FROM kept k LEFT JOIN priced p ON p.id = k.id AND readable GROUP BY k.id, readable""",
    "implied_edge": """
SELECT event_id, round(1 / nullif(v, 0), 9) AS implied, round(0.6 - 1 / nullif(v, 0), 9) AS edge
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 0 ELSE value END AS v FROM events)""",
    "devig": _with(LINES) + """
SELECT id, round(1 / b1 + 1 / b2 - 1, 9) AS margin, round((1 / b1) / (1 / b1 + 1 / b2), 9) AS n1,
       round((1 / b2) / (1 / b1 + 1 / b2), 9) AS n2 FROM best""",
    "win_probability": """
SELECT r1, r2, round(1 / (1 + pow(10, (r2 - r1) / 400)), 9) AS p1, round(1 - 1 / (1 + pow(10, (r2 - r1) / 400)), 9) AS p2, n
FROM (SELECT 1500 + l_quantity * 10 AS r1, 1500 + l_linenumber * 50 AS r2, count(*) AS n FROM lineitem GROUP BY ALL)""",
    "log_loss_winner": _with(FORECASTS) + """
SELECT l_orderkey, l_linenumber, winner, p,
       round(CASE WHEN winner = 'a' AND p > 0 THEN -ln(p) WHEN winner = 'b' AND q > 0 THEN -ln(q) END, 9) AS log_loss
FROM f""",
    "log_loss_clipped": _with(FORECASTS) + """
SELECT l_orderkey, l_linenumber, winner, p,
       round(-(y * ln(greatest(least(p, 1 - 1e-15), 1e-15)) + (1 - y) * ln(greatest(least(1 - p, 1 - 1e-15), 1e-15))), 9)
         AS log_loss FROM f""",
    "brier": _with(FORECASTS) + """
SELECT l_orderkey, l_linenumber, coalesce(y, -1) AS y, round((raw - y) * (raw - y), 9) AS brier FROM f""",
    "wide_to_map": """
SELECT l_orderkey, l_linenumber, concat_ws(',', 'flag=' || l_returnflag,
         CASE WHEN l_quantity > 25 THEN NULL ELSE 'size=low' END, 'status=' || l_linestatus,
         CASE WHEN l_tax > 0.04 THEN NULL ELSE 'tax=few' END) AS m FROM lineitem""",
    "match_sides": _with(MATCHES) + """
SELECT match_id, player1 AS player, player1score AS score FROM m
UNION ALL SELECT match_id, player2, player2score FROM m""",
    "quality_gate_clean": _with(MATCHES, GATE) + """
SELECT match_id, matchdate::VARCHAR AS matchdate, player1, player2, winner FROM f
WHERE NOT (f1 OR f2 OR f3 OR f4 OR f5 OR f6)""",
    "quality_gate_rejects": _with(MATCHES, GATE) + """
SELECT match_id, concat_ws(',', CASE WHEN f1 THEN 'matchdate' END, CASE WHEN f2 THEN 'player1' END,
         CASE WHEN f3 THEN 'player2' END, CASE WHEN f4 THEN 'winner' END,
         CASE WHEN f5 THEN 'winner_is_a_player' END, CASE WHEN f6 THEN 'two_players' END) AS failed
FROM f WHERE f1 OR f2 OR f3 OR f4 OR f5 OR f6""",
    "quality_gate_audit": _with(MATCHES, GATE) + """
SELECT count(*) AS rows_read, count(*) FILTER (f1 OR f2 OR f3 OR f4 OR f5 OR f6) AS rows_rejected,
       count(*) FILTER (NOT (f1 OR f2 OR f3 OR f4 OR f5 OR f6)) AS rows_clean,
       count(*) FILTER (f1) AS failed_matchdate, count(*) FILTER (f2) AS failed_player1,
       count(*) FILTER (f3) AS failed_player2, count(*) FILTER (f4) AS failed_winner,
       count(*) FILTER (f5) AS failed_winner_is_a_player, count(*) FILTER (f6) AS failed_two_players FROM f""",
    "quality_gate_blank": _with(MATCHES, GATE) + """
SELECT match_id, player1 FROM g WHERE matchdate IS NOT NULL AND trim(player1) <> ''""",
    "safe_casts": """
WITH t AS (
  SELECT event_id, CASE event_id % 6 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN event_id || '.7'
    WHEN 2 THEN ' ' || event_id || ' ' WHEN 3 THEN 'x' || event_id WHEN 4 THEN NULL
    ELSE '2024-01-' || lpad((event_id % 40)::VARCHAR, 2, '0') END AS t FROM events)
SELECT event_id, CASE WHEN event_id % 6 < 3 THEN event_id::INTEGER END AS as_int, trim(t) AS as_str,
       coalesce(trim(t), '') AS as_blank, coalesce(try_cast(t AS DOUBLE), 0) AS as_number,
       CASE WHEN event_id % 6 >= 3 THEN try_cast(t AS DATE) END::VARCHAR AS as_date FROM t""",
    "parse_datetimes": """
SELECT event_id, CASE WHEN event_id % 4 < 2 THEN strftime(ts, '%Y-%m-%d %H:%M:00') END AS start,
       CASE WHEN event_id % 4 < 2 THEN strftime(ts, '%Y-%m-%d') END AS day,
       CASE WHEN event_id % 4 < 2 THEN strftime(ts, '%H:%M:00') END AS clock,
       (ts::DATE + 1)::VARCHAR AS tomorrow, (ts::DATE - 30)::VARCHAR AS month_ago,
       strftime(make_timestamp((1700000000 + event_id) * 1000000), '%Y-%m-%d %H:%M:%S') AS moment FROM events""",
    "insert_if_absent": _with(KEYED) + """
SELECT o_orderkey, o_custkey, day::VARCHAR AS day, o_totalprice FROM fresh""",
    "insert_if_absent_bucketed": _with(KEYED) + """
SELECT o_orderkey, o_custkey, day::VARCHAR AS day, o_totalprice FROM target
UNION ALL SELECT o_orderkey, o_custkey, day::VARCHAR, o_totalprice FROM fresh""",
    "insert_if_absent_idempotent": _with(KEYED) + """
SELECT 1 AS run, count(*) AS n FROM fresh WHERE o_custkey IS NOT NULL UNION ALL SELECT 2, 0""",
    "load_audit": _with(KEYED) + """
SELECT rows_read, rows_attempted, rows_inserted, rows_attempted - rows_inserted AS rows_skipped FROM (
  SELECT (SELECT count(*) FROM batch) AS rows_read,
         (SELECT count(*) FROM batch WHERE o_custkey IS NOT NULL) AS rows_attempted,
         (SELECT count(*) FROM fresh WHERE o_custkey IS NOT NULL) AS rows_inserted)""",
    "surrogate_ids": _with(MATCHES) + """
SELECT 100 + row_number() OVER (ORDER BY matchdate, player1, player2, match_id) AS id, match_id FROM m""",
    "upsert_last_wins": """
SELECT coalesce(b.player, c_custkey) AS player, coalesce(b.elo, 1500.0) AS elo
FROM customer FULL JOIN (
  SELECT o_custkey AS player, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS elo FROM orders GROUP BY 1) b
  ON b.player = c_custkey""",
    "update_columns": """
SELECT c_custkey, CASE WHEN n > 9 THEN prio ELSE c_mktsegment END AS c_mktsegment,
       coalesce(top, c_acctbal) AS c_acctbal,
       CASE WHEN c_custkey % 2 = 0 THEN c_nationkey WHEN n IS NOT NULL THEN 99 END AS c_nationkey
FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS top, max(o_orderpriority) AS prio, count(*) AS n
                         FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    "truncate_and_load": "SELECT o_orderkey, round(o_totalprice * 2, 2) AS o_totalprice FROM orders",
    "append_rows": """
SELECT l_partkey, l_returnflag, 2 * count(*) AS n, round(max(l_extendedprice), 2) AS top
FROM lineitem GROUP BY 1, 2""",
    "csv_landing": _with(MATCHES, LANDED) + """
SELECT match_id, NOT (match_id % 3 = 0 AND match_id % 11 = 0) AS cells_fit, matchdate::VARCHAR AS matchdate,
       player1, player2, player1score, player2score, winner FROM landed
UNION ALL SELECT NULL, true, NULL, 'Player 1', 'Player 2', NULL, NULL, 'Winner' FROM m
WHERE match_id % 3 = 0 AND match_id % 101 = 0""",
    "csv_rejects": _with(MATCHES) + """
, t AS (
  SELECT match_id AS i, match_id || ',' || matchdate AS head,
         player1score || CASE WHEN match_id % 2 = 0 THEN '.0' ELSE '' END AS s1,
         CASE WHEN match_id % 37 = 0 THEN 'abc' ELSE player2score::VARCHAR END AS s2, player1 AS p1,
         CASE WHEN match_id % 31 = 0 THEN 'N/A' ELSE player2 END AS p2, winner AS w, matchdate FROM m),
u AS (
  SELECT CASE i % 3 WHEN 0 THEN concat_ws(',', head, p1, p2, s1, s2, w) || CASE WHEN i % 11 = 0 THEN ',,extra' ELSE '' END
                    WHEN 1 THEN concat_ws(',', w, s2, s1, p2, p1, matchdate, i)
                    ELSE concat_ws(',', head, p1, p2, s1, s2, '"90,5"') END AS raw,
         concat_ws(',', CASE WHEN p2 = 'N/A' THEN 'player2' END, CASE WHEN s2 = 'abc' THEN 'player2score' END,
                   CASE WHEN i % 3 = 2 THEN 'winner' END,
                   CASE WHEN i % 3 = 2 OR (p2 = 'N/A' AND w <> p1) THEN 'winner_is_a_player' END,
                   CASE WHEN p2 = 'N/A' THEN 'two_players' END,
                   CASE WHEN i % 3 = 0 AND i % 11 = 0 THEN 'cells_fit' END) AS failed FROM t)
SELECT raw, failed FROM u WHERE failed <> ''
UNION ALL SELECT 'Match Id,Date,Player 1,Player 2,Player 1 Score,Player 2 Score,Winner',
                 'matchdate,player1score,player2score,winner_is_a_player' FROM m
WHERE match_id % 3 = 0 AND match_id % 101 = 0""",
    "csv_wide": _with(MATCHES, LINES) + """
SELECT lines.id, line, matchdate::VARCHAR AS matchdate, player1,
       CASE WHEN lines.id % 41 = 0 THEN '' ELSE player2 END AS player2,
       concat_ws(',', CASE WHEN line NOT IN (2, 3) THEN 'book' || bk || '_P1' END,
                 CASE WHEN line <> 5 THEN 'book' || bk || '_P2' END) AS books,
       CASE WHEN line NOT IN (2, 3) THEN round(v1, 9) END AS best_p1,
       CASE WHEN line <> 5 THEN round(v2, 9) END AS best_p2
FROM (SELECT *, CASE WHEN line % 3 = 0 THEN 3 ELSE line % 3 END AS bk FROM lines) lines JOIN m ON m.match_id = lines.id""",
    "dated_csv": _with(MATCHES) + "SELECT match_id, matchdate::VARCHAR AS matchdate, player1 FROM m",
    "upcoming_job": _with(MATCHES, LINES) + """
, landed AS (
  SELECT matchdate, player1, CASE WHEN match_id % 41 = 0 THEN '' ELSE player2 END AS player2, match_id, line,
         CASE WHEN line NOT IN (2, 3) THEN round(v1, 9) END AS best_p1, CASE WHEN line <> 5 THEN round(v2, 9) END AS best_p2
  FROM m JOIN lines ON lines.id = m.match_id),
firsts AS (
  SELECT * FROM landed
  QUALIFY row_number() OVER (PARTITION BY matchdate, player1, player2 ORDER BY (line + 2) % 3, match_id, line) = 1)
SELECT row_number() OVER (ORDER BY matchdate, player1, player2) AS id, matchdate::VARCHAR AS matchdate, player1, player2,
       best_p1, best_p2 FROM firsts""",
    "stream_landed": "SELECT event_type, count(*) AS n, max(event_id) AS last FROM events GROUP BY 1",
    "star_load_prices": _with(STAR) + """
, paged AS ({PAGED}),
more AS (SELECT name, row_number() OVER (ORDER BY name) + (SELECT count(*) FROM items) AS id
         FROM (SELECT DISTINCT name FROM paged WHERE name NOT IN (SELECT name FROM items))),
known AS (SELECT name, id FROM items UNION ALL SELECT name, id FROM more),
listed AS (SELECT 1 AS market_id, name, price, volume FROM l UNION ALL SELECT 2, name, price, volume FROM paged)
SELECT id AS item_id, market_id, count(*) AS n, round(max(price), 2) AS price, sum(volume)::BIGINT AS volume,
       known.name AS item, market, fee_percent
FROM listed JOIN known USING (name)
JOIN (VALUES (1, 'east', 0.12::DOUBLE), (2, 'west', 0.02::DOUBLE)) k(market_id, market, fee_percent) USING (market_id)
GROUP BY ALL""".replace("{PAGED}", PAGED),
    "star_items": _with(STAR) + "SELECT id, name FROM items",
    "snapshot_pages": PAGED,
    "flat_json_items": _with(STAR) + """
SELECT name, 2 * count(*) AS n, round(max(price), 2) AS price, 2 * sum(volume)::BIGINT AS volume
FROM l WHERE name IS NOT NULL GROUP BY name""",
    "listing_filter": "SELECT p_partkey, p_brand FROM part WHERE p_brand = 'Brand#11'",
    "symbol_extract": _with(POSTS) + f"""
, s AS (SELECT id, {_symbols("title || ' ' || selftext")} AS t FROM p)
SELECT id, len(t)::INTEGER AS n, md5(array_to_string(t, ',')) AS tickers FROM s""",
    "newest_posts_symbols": _with(POSTS) + f"""
, bound AS (SELECT max(created_utc) - 86400 AS as_of FROM p)
SELECT id, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d %H:%M:%S') AS date, title, score, num_comments,
       array_to_string({_symbols("title || ' ' || selftext")}, ',') AS tickers
FROM p, bound WHERE created_utc BETWEEN as_of - 30 * 86400 AND as_of""",
    "newest_rows": """
SELECT event_id, ts::DATE::VARCHAR AS day FROM events ORDER BY ts::DATE DESC, event_id LIMIT 1000""",
    "newest_preview": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 3",
    "page_titles": f"""
SELECT page_id, {TITLE} AS title, {HEADING} AS heading, translate({TITLE}, ' :()', '_') AS slug FROM pages""",
    "page_links": f"""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a\\s[^<>]*>.*?</a>')) AS tag FROM pages),
b AS (SELECT page_id, {_plain('tag')} AS label, replace(regexp_extract(tag, '\\shref="([^"]*)"', 1), '&amp;', '&') AS href FROM a)
SELECT page_id, label, rtrim(CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://site.example' || href END, '/')
         || '/results/' AS url, count(*) AS n
FROM b WHERE label <> '' AND href <> '' GROUP BY ALL""",
    "match_pages": _with(MATCHES) + """
SELECT match_id, CASE WHEN match_id % 9 <> 0 THEN matchdate || ' ' || lpad((match_id % 24)::VARCHAR, 2, '0') || ':05:00' END AS start,
       CASE WHEN match_id % 9 <> 0 THEN matchdate::VARCHAR END AS "Date",
       CASE WHEN match_id % 9 <> 0 THEN lpad((match_id % 24)::VARCHAR, 2, '0') || ':05:00' END AS "Time",
       'Tom & ' || player1 AS p1, player2 AS p2,
       CASE WHEN match_id % 7 <> 0 THEN player1score::VARCHAR END AS s1,
       CASE WHEN match_id % 7 <> 0 THEN player2score::VARCHAR END AS s2,
       CASE WHEN match_id % 7 <> 0 THEN CASE WHEN winner = player1 THEN 'Tom & ' || player1 ELSE player2 END END AS "Winner",
       CASE WHEN match_id % 5 <> 0 THEN (match_id % 100) || '.5' END AS avg1,
       CASE WHEN match_id % 5 <> 0 THEN (match_id % 90) || '.25' END AS avg2 FROM m""",
    "blocks_to_odds": _with(LINES) + """
SELECT id, coalesce(string_agg('bm' || line || '_P1,bm' || line || '_P2', ',' ORDER BY line) FILTER (line <> 7), '') AS books,
       round(max(v1) FILTER (line NOT IN (2, 3, 7)), 9) AS best_p1, round(max(v2) FILTER (line NOT IN (4, 5, 7)), 9) AS best_p2
FROM lines GROUP BY id""",
    "match_list": """
SELECT o_orderkey, 'g_1__k' || o_orderkey AS element_id, 'k' || o_orderkey AS match_key,
       'https://site.example/match/k' || o_orderkey || '/' AS url FROM orders WHERE o_orderkey % 10 > 1""",
    "region_links": """
WITH k AS (
  SELECT c_custkey, 'World - ' || c_name AS label, 'https://site.example/w/' || c_custkey || '/results/' AS url FROM customer
  UNION ALL
  SELECT c_custkey, 'World - Cup (' || c_nationkey || '): A', 'https://other.example/' || c_custkey || '/results/' FROM customer)
SELECT *, replace(replace(replace(replace(label, ' ', '_'), ':', ''), '(', ''), ')', '') AS slug FROM k""",
    "pages_to_csv": _with(MATCHES) + """
SELECT matchdate::VARCHAR AS matchdate, count(*) AS n, count(*) FILTER (match_id % 7 <> 0) AS decided,
       sum(CASE WHEN match_id % 7 <> 0 THEN player1score END)::BIGINT AS points
FROM (SELECT CASE WHEN match_id % 9 <> 0 THEN matchdate END AS matchdate, match_id, player1score FROM m) GROUP BY matchdate""",
}

ALL["upcoming_pages_to_csv"] = _with(MATCHES, LINES) + """
SELECT 'Tom & ' || player1 AS player1, player2, '2002-01-02' AS matchdate, count(DISTINCT match_id) AS n,
       count(*) FILTER (line NOT IN (2, 3, 7)) + count(*) FILTER (line NOT IN (4, 5, 7)) AS quotes,
       round(max(v1) FILTER (line NOT IN (2, 3, 7)), 9) AS best_p1
FROM m JOIN lines ON lines.id = m.match_id GROUP BY ALL"""
ALL["odds_blocks"] = _with(LINES) + """
SELECT id, bookmaker, CASE WHEN line = 4 THEN 1 ELSE 2 END AS n,
       CASE WHEN line NOT IN (2, 3) THEN round(v1, 9) END AS p1,
       CASE WHEN line NOT IN (4, 5) THEN round(v2, 9) END AS p2 FROM lines WHERE line <> 7"""
ALL["results_job"] = _with(MATCHES, LANDED) + """
, ok AS (
  SELECT * FROM landed WHERE player2 IS NOT NULL AND player2score IS NOT NULL AND winner IS NOT NULL
    AND (winner = player1 OR winner = player2)
  QUALIFY row_number() OVER (PARTITION BY player1, player2, matchdate ORDER BY match_id % 3, match_id) = 1)
SELECT row_number() OVER (ORDER BY matchdate, player1, player2) AS match_id, matchdate::VARCHAR AS matchdate,
       player1, player2, player1score, player2score, winner
FROM ok"""
ALL["file_chain"] = _with(
    MATCHES.replace("m AS MATERIALIZED (", "mall AS (") + """,
ok AS (
  SELECT * FROM mall WHERE match_id % 31 <> 0 AND match_id % 37 <> 0 AND match_id % 3 <> 2
    AND NOT (match_id % 3 = 0 AND match_id % 11 = 0)
  QUALIFY row_number() OVER (PARTITION BY player1, player2, matchdate ORDER BY match_id % 3, match_id) = 1),
m AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY matchdate, player1, player2) AS match_id, matchdate, pool, a, b, won, places,
         player1, player2, winner,
         row_number() OVER (PARTITION BY pool ORDER BY matchdate, player1, player2) AS rn FROM ok)""",
    LOG, LINES, """
offered AS (
  SELECT matchdate, player1, CASE WHEN match_id % 41 = 0 THEN '' ELSE player2 END AS player2, match_id AS source, line,
         CASE WHEN line NOT IN (2, 3) THEN v1 END AS o1, CASE WHEN line <> 5 THEN v2 END AS o2
  FROM mall JOIN lines ON lines.id = mall.match_id),
up AS (
  SELECT row_number() OVER (ORDER BY matchdate, player1, player2) AS match_id, matchdate, player1, player2, o1, o2
  FROM offered
  QUALIFY row_number() OVER (PARTITION BY matchdate, player1, player2 ORDER BY (line + 2) % 3, source, line) = 1)""",
    STATES.replace("FROM m q", "FROM up q"), """
pred AS (
  SELECT up.*, asof1.n AS n1, 1 / (1 + pow(10, (coalesce(asof2.own, 1500) - coalesce(asof1.own, 1500)) / 400.0)) AS p1
  FROM up JOIN asof1 USING (match_id) JOIN asof2 USING (match_id)),
done AS (SELECT row_number() OVER (ORDER BY match_id) AS prediction_id, * FROM pred)""") + f"""
SELECT row_number() OVER (ORDER BY prediction_id) AS id, prediction_id, done.player1, done.player2,
       r.winner AS actual_winner, n1::INTEGER AS player1_match_count, {R('p1', 'predicted_p1_prob')},
       {R('o2', 'best_p2_odds')},
       {R('-ln(CASE WHEN r.winner = done.player1 THEN p1 ELSE 1 - p1 END)', 'log_loss')}
FROM done JOIN (SELECT player1, player2, matchdate, winner FROM m) r USING (player1, player2, matchdate)
WHERE done.matchdate < TIMESTAMP '{AS_OF}'"""
