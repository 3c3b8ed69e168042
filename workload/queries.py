"""One query per operator or job over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelmetrics import schemas
from duelmetrics.functions import convert, odds, scoring, text
from duelmetrics.functions import odds_variant as variant
from duelmetrics.functions.html import tag_text
from duelmetrics.operators import asof, elo, keyed, quality, ranking, reshape, star
from duelmetrics.plans import jobs, rating_store
from duelmetrics.plans.backtest import backtest as backtest_plan
from duelmetrics.plans.mentions import post_symbols, symbol_mentions
from duelmetrics.plans.predict import predict as predict_plan
from duelmetrics.plans.refresh import refresh_odds_scores
from duelmetrics.session import scratch_dir, stage
from duelmetrics.sources import bucketed
from duelmetrics.sources import csv_landing as landing
from duelmetrics.sources import json_payloads, pages, sinks, tables
from duelmetrics.streaming.landing import stream_landing, stream_ratings
from duelmetrics.streaming.rating_state import stream_state_ratings

from . import bindings as b

LOG_NUMBERS = ["player1_elo_before", "player2_elo_before", "player1_elo_after", "player2_elo_after",
               "elo_change_p1", "elo_change_p2"]
AS_OF = "2000-01-01 12:00:00"


def day(name: str) -> Column:
    return F.col(name).cast("date").cast("string").alias(name)


def rounded(name: str, places: int = 9) -> Column:
    return F.round(F.col(name), places).alias(name)


def joined(name: str) -> Column:
    return F.array_join(name, ",").alias(name)


def shown_log(log: DataFrame) -> DataFrame:
    return log.select("match_id", "player1", "player2", *LOG_NUMBERS, "winner", day("match_date"))


def pooled_log(spark: SparkSession, sf: str) -> DataFrame:
    return elo.elo_log(b.matches(spark, sf), None, "pool")


# ratings

def elo_log(spark, sf):
    return shown_log(pooled_log(spark, sf))


def elo_rankings(spark, sf):
    return ranking.latest_ratings(pooled_log(spark, sf))


def elo_incremental(spark, sf):
    """Two runs over a warehouse folder: older matches first, then all that are left."""
    root = scratch_dir(spark, "ratings")
    m = b.matches(spark, sf)
    jobs.update_ratings(spark, root, m.where("matchdate < date'1998-07-01'"), "pool")
    jobs.update_ratings(spark, root, m, "pool")
    return shown_log(jobs.read_ratings(spark, root, "pool", T.LongType())[0])


def elo_single_pool(spark, sf):
    """All matches in one pool: serial by nature, a stream through one task."""
    return shown_log(elo.elo_log(b.open_matches(spark, sf).withColumn("pool", F.lit(0)), None, "pool"))


def elo_hot_pool(spark, sf):
    """One pool holds a third of the matches; the others run beside it."""
    return shown_log(elo.elo_log(b.uneven_matches(spark, sf), None, "pool"))


def elo_frontier(spark, sf):
    """One pool of very many players, rated by rounds of joins."""
    return shown_log(elo.elo_log(b.crowded_matches(spark, sf), None, "pool", method="frontier"))


def _late(spark, sf):
    """(matches that land in time, matches of one order status that land late)."""
    m = b.matches(spark, sf)
    late = b.table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("match_id"))
    return m.join(late, "match_id", "left_anti").select(*m.columns), m.join(late, "match_id", "left_semi").select(*m.columns)


def late_match_snapshot(spark, sf):
    """Late matches are brought in from the snapshot before them; the corrected log is committed."""
    root = scratch_dir(spark, "store")
    for part in _late(spark, sf):
        rating_store.rate_matches(spark, root, part, "pool", period="year")
    return shown_log(rating_store.read_store(spark, root, "pool", T.LongType())[0])


def rankings_in_parts(spark, sf):
    """Two increments; the second rewrites the parts of the pools it touches."""
    root = scratch_dir(spark, "store")
    m = b.matches(spark, sf)
    for part in ("matchdate < date'1998-07-01'", "matchdate >= date'1998-07-01'"):
        rating_store.rate_matches(spark, root, m.where(part), "pool", period="year")
    return rating_store.read_store(spark, root, "pool", T.LongType())[1].select("player", "elo")


def elo_from_versions(spark, sf):
    """Three loads of gold and a rating run after the first and the third; a run opens only versions it has not seen."""
    root = scratch_dir(spark, "versions")
    m = b.matches(spark, sf)
    for k, part in enumerate(("matchdate < date'1994-01-01'", "matchdate between date'1994-01-01' and date'1996-12-31'",
                              "matchdate > date'1996-12-31'")):
        tables.commit_version(spark, f"{root}/gold", {"rows": m.where(part)})
        if k != 1:
            rating_store.rate_gold(spark, f"{root}/ratings", f"{root}/gold", m.schema, "pool", period="year")
    return shown_log(rating_store.read_store(spark, f"{root}/ratings", "pool", T.LongType())[0])


def stream_state_rated(spark, sf):
    """Four landed files, two micro-batches each time, the stream started again in between."""
    root = scratch_dir(spark, "stream")
    orders = b.table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    ends = ["1900-01-01", "1993-07-01", "1995-01-01", "1996-07-01", "2100-01-01"]
    for k, (low, high) in enumerate(zip(ends, ends[1:])):
        orders.where((day >= low) & (day < high)).coalesce(1).write.mode("append").parquet(f"{root}/landed")
        if k % 2:
            log = stream_state_ratings(spark, f"{root}/landed", orders.schema, f"{root}/checkpoint", f"{root}/log",
                                       b.matches_of, "pool", max_files=1)
    return shown_log(log)


def late_match(spark, sf):
    """The matches of one status arrive late; the pools they touch are then rated again."""
    root = scratch_dir(spark, "late")
    m = b.matches(spark, sf)
    late = b.table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("match_id"))
    jobs.update_ratings(spark, root, m.join(late, "match_id", "left_anti").select(*m.columns), "pool")
    jobs.update_ratings(spark, root, m, "pool")
    touched = m.join(late, "match_id", "left_semi").select("pool").distinct()
    return shown_log(jobs.replay_pools(spark, root, m, touched, "pool"))


def stream_rated(spark, sf):
    """A batch run over the oldest orders, then a stream that meets the others in three batches."""
    root = scratch_dir(spark, "stream")
    orders = b.table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    ends = [F.lit(d).cast("date") for d in ("1993-07-01", "1995-01-01", "1996-07-01")]
    jobs.update_ratings(spark, f"{root}/ratings", b.matches_of(orders.where(day < ends[0])), "pool")
    for part in (day.between(ends[0], ends[1]), (day > ends[1]) & (day < ends[2]), (day >= ends[2]) | day.isNull()):
        orders.where(part).write.mode("append").parquet(f"{root}/landed")
        stream_ratings(spark, f"{root}/landed", orders.schema, f"{root}/checkpoint", f"{root}/ratings", b.matches_of, "pool")
    return shown_log(jobs.read_ratings(spark, f"{root}/ratings", "pool", T.LongType())[0])


def register_entities(spark, sf):
    m = b.matches(spark, sf)
    known = ranking.latest_ratings(elo.elo_log(m.where("matchdate < date'1995-07-01'"), None, "pool"))
    return ranking.register_entities(known, m)


def unprocessed(spark, sf):
    o = b.table(spark, sf, "orders")
    done = o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("match_id"))
    return ranking.unprocessed(b.matches(spark, sf), done).select("match_id", "player1", "player2", day("matchdate"))


def pending(spark, sf):
    o = b.table(spark, sf, "orders")
    change_log = o.select(F.col("o_orderkey").alias("match_id"), (F.col("o_orderstatus") == "F").alias("processed"))
    return ranking.pending(b.matches(spark, sf), change_log).groupBy("pool").agg(F.count(F.lit(1)).alias("n"))


def pending_count(spark, sf):
    o = b.table(spark, sf, "orders")
    return ranking.pending_count(o.select((F.col("o_orderstatus") == "F").alias("processed")))


# point in time

def _asof(spark, sf, side):
    m = b.matches(spark, sf)
    requests = m.select("match_id", "matchdate", "player1", "player2")
    both = asof.asof_last(requests, pooled_log(spark, sf), side=side)
    return both.select("match_id", F.coalesce("player1_elo", F.lit(-1)).alias("player1_elo"),
                       F.coalesce("player2_elo", F.lit(-1)).alias("player2_elo"))


def asof_own(spark, sf):
    return _asof(spark, sf, "own")


def asof_first_slot(spark, sf):
    return _asof(spark, sf, "first")


def asof_count(spark, sf):
    m = b.matches(spark, sf).select("match_id", "matchdate", "player1", "player2")
    log = b.matches(spark, sf).selectExpr("match_id", "player1", "player2", "matchdate as match_date",
                                          "0 as player1_elo_after", "0 as player2_elo_after")
    return asof.asof_count(m, log).select("match_id", "player1_match_count", "player2_match_count")


def asof_null_value(spark, sf):
    """Every third price is unknown: it counts, but never hides an earlier one."""
    facts = b.table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderkey",
        F.expr("if(o_orderkey % 3 = 0, null, o_totalprice)").alias("price"))
    states = asof.asof_states(facts, facts, "o_custkey", "day", "o_orderkey", "price")
    return states.select("o_custkey", day("day"), F.coalesce("last", F.lit(-1.0)).alias("last"), "n")


def lookup_default(spark, sf):
    nations = tables.read_lookup(spark, f"{sf}/customer.parquet", "c_custkey", "c_nationkey")
    o = b.table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("asked"))
    found = tables.left_lookup(o, nations, "asked", "c_custkey", "c_nationkey", "nation", -1)
    return found.select("o_orderkey", F.col("nation").cast("bigint").alias("nation"))


PREDICTED = ["player1_elo", "player2_elo", "predicted_p1_prob", "predicted_p2_prob", "best_p1_odds",
             "best_p1_implied_prob", "value_p1", "best_p2_odds", "best_p2_implied_prob", "value_p2"]


def _predictions(spark, sf):
    return predict_plan(b.upcoming(spark, sf), pooled_log(spark, sf))


def predict(spark, sf):
    return _predictions(spark, sf).select(
        "match_id", day("matchdate"), "player1", "player2", "player1_match_count", "player2_match_count",
        *[rounded(c) for c in PREDICTED])


def backtest(spark, sf):
    made = _predictions(spark, sf).withColumn("id", F.col("match_id") + 1)
    results = keyed.first_per_key(b.matches(spark, sf).drop("pool"), ["player1", "player2", "matchdate"], ["match_id"])
    scored = backtest_plan(made, results, AS_OF)
    return scored.select("prediction_id", day("matchdate"), "player1", "player2", "actual_winner",
                         "player1_match_count", "player2_match_count",
                         *[rounded(c) for c in PREDICTED if not c.startswith("value")], rounded("log_loss"))


def _odds_table(spark, sf):
    """The odds table before a refresh: some probabilities stored, some winners unknown."""
    m = b.matches(spark, sf).selectExpr(
        "match_id as id", "player1", "player2",
        "case when match_id % 4 = 0 then null when match_id % 13 = 0 then 'nobody' else winner end as winner",
        "if(match_id % 3 = 0, 0.5D, null) as elo_prob_player1", "if(match_id % 3 = 0, 0.5D, null) as elo_prob_player2",
        "cast(null as double) as nothing", "-1.0D as old")
    old = {c: ("nothing" if c in ("best_odd_player1", "best_odd_player2") else "old")
           for c in schemas.ODDS_SCORES.names if c not in (*m.columns, "odds")}
    text_of = F.expr("case when id % 17 = 0 then 'not json' when id % 19 = 0 then '[1]' else odds end")
    t = m.join(b.odds(spark, sf), "id", "left").withColumn("odds", text_of)
    return t.select(*[F.col(old.get(c, c)).alias(c) for c in schemas.ODDS_SCORES.names])


def odds_refresh(spark, sf):
    fresh = refresh_odds_scores(_odds_table(spark, sf), ranking.latest_ratings(pooled_log(spark, sf)))
    return fresh.select("id", *[rounded(f.name) for f in schemas.ODDS_SCORES.fields
                                if f.dataType == T.DoubleType()])


# odds and scores

def _best(spark, sf):
    return b.odds(spark, sf).withColumn("m", odds.parse_odds("odds")).select(
        "id", odds.best_odds("m", "_P1").alias("best_p1"), odds.best_odds("m", "_P2").alias("best_p2"))


def best_odds(spark, sf):
    return _best(spark, sf).select("id", rounded("best_p1"), rounded("best_p2"))


def odds_variant(spark, sf):
    """Prices as quoted numbers, in nested objects and lists, among junk."""
    parsed = b.nested_odds(spark, sf).withColumn("v", variant.parse_odds_variant("odds"))
    prices = parsed.withColumn("prices", variant.named_prices("v"))
    names = F.array_join(F.array_sort(F.transform("prices", lambda p: p["name"])), ",")
    return prices.select("id", F.col("v").isNotNull().alias("readable"), F.coalesce(names, F.lit("")).alias("names"),
                         F.round(variant.best_price("prices", "_P1"), 9).alias("best_p1"),
                         F.round(variant.best_price("prices", "_P2"), 9).alias("best_p2"))


def implied_edge(spark, sf):
    e = b.table(spark, sf, "events").withColumn("price", F.expr("if(event_id % 10 = 0, 0, value)"))
    p = odds.implied("price")
    return e.select("event_id", F.round(p, 9).alias("implied"), F.round(odds.edge(F.lit(0.6), p), 9).alias("edge"))


def devig(spark, sf):
    t = _best(spark, sf).withColumns({"i1": odds.implied("best_p1"), "i2": odds.implied("best_p2")})
    return odds.devig(t, "i1", "i2", "margin", "n1", "n2").select("id", rounded("margin"), rounded("n1"), rounded("n2"))


def win_probability(spark, sf):
    li = b.table(spark, sf, "lineitem").withColumns({
        "r1": F.expr("1500 + l_quantity * 10"), "r2": F.expr("1500 + l_linenumber * 50")})
    both = scoring.probability_pair(li, "r1", "r2", "p1", "p2")
    return both.groupBy("r1", "r2").agg(F.round(F.max("p1"), 9).alias("p1"), F.round(F.max("p2"), 9).alias("p2"),
                                        F.count(F.lit(1)).alias("n"))


def _forecasts(spark, sf):
    li = b.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_discount * 10 as p", "1 - l_discount * 10 as q",
        "case l_returnflag when 'A' then 'a' when 'N' then 'b' else 'x' end as winner", "'a' as p1", "'b' as p2")
    return li


def log_loss_winner(spark, sf):
    f = _forecasts(spark, sf)
    return f.select("l_orderkey", "l_linenumber", "winner", F.round("p", 9).alias("p"), F.round(
        scoring.log_loss_winner("winner", "p1", "p2", F.round("p", 9), F.round("q", 9)), 9).alias("log_loss"))


def log_loss_clipped(spark, sf):
    f = _forecasts(spark, sf).withColumns({"y": scoring.outcome("winner", "p1", "p2"), "p": F.round("p", 9)})
    return f.select("l_orderkey", "l_linenumber", "winner", "p",
                    F.round(scoring.log_loss_clipped("p", "y"), 9).alias("log_loss"))


def brier(spark, sf):
    f = _forecasts(spark, sf).withColumn("y", scoring.outcome("winner", "p1", "p2"))
    return f.select("l_orderkey", "l_linenumber", F.coalesce("y", F.lit(-1)).alias("y"),
                    F.round(scoring.brier("p", "y"), 9).alias("brier"))


# reshaping

def wide_to_map(spark, sf):
    li = b.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_returnflag as flag", "l_linestatus as status",
        "if(l_quantity > 25, '', 'low') as size", "if(l_tax > 0.04, null, 'few') as tax")
    folded = reshape.wide_to_map(li, ["l_orderkey", "l_linenumber"], "m")
    return folded.select("l_orderkey", "l_linenumber", F.array_join(F.transform(
        F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("m"))


def match_sides(spark, sf):
    m = b.matches(spark, sf)
    return reshape.sides(m, {"player": ("player1", "player2"), "score": ("player1score", "player2score")},
                         keep=["match_id"])


# quality and conversion

def _gate_input(spark, sf):
    return b.matches(spark, sf).select(
        "match_id", F.expr("if(match_id % 11 = 0, null, matchdate)").alias("matchdate"),
        F.expr("if(match_id % 7 = 0, null, if(match_id % 17 = 0, ' ', player1))").alias("player1"),
        F.expr("if(match_id % 29 = 0, player1, player2)").alias("player2"),
        F.expr("if(match_id % 5 = 0, null, if(match_id % 23 = 0, 'nobody', winner))").alias("winner"))


def _gate(spark, sf):
    return quality.quality_gate(_gate_input(spark, sf), ["matchdate", "player1", "player2", "winner"],
                                rules=quality.two_player_rules())


def quality_gate_clean(spark, sf):
    return _gate(spark, sf).clean.select("match_id", day("matchdate"), "player1", "player2", "winner")


def quality_gate_rejects(spark, sf):
    return _gate(spark, sf).rejects.select("match_id", joined("failed"))


def quality_gate_audit(spark, sf):
    return _gate(spark, sf).audit


def quality_gate_blank(spark, sf):
    gate = quality.quality_gate(_gate_input(spark, sf), ["matchdate", "player1"], blank_is_null=True)
    return gate.clean.select("match_id", "player1")


def safe_casts(spark, sf):
    e = b.table(spark, sf, "events").withColumn("raw", F.expr(
        "case event_id % 6 when 0 then cast(event_id as string) when 1 then concat(event_id, '.7') "
        "when 2 then concat(' ', event_id, ' ') when 3 then concat('x', event_id) when 4 then 'NA' "
        "else concat('2024-01-', lpad(event_id % 40, 2, '0')) end"))
    t = convert.missing_to_null("raw")
    return e.select("event_id", convert.safe_int(t).alias("as_int"), convert.safe_str(t).alias("as_str"),
                    convert.blank_str(t).alias("as_blank"), convert.number_or_zero(t).alias("as_number"),
                    convert.safe_date(F.when(F.col("event_id") % 6 >= 3, t)).cast("string").alias("as_date"))


def parse_datetimes(spark, sf):
    e = b.table(spark, sf, "events").withColumn("raw", F.expr(
        "case event_id % 4 when 0 then date_format(ts, 'dd.MM.yyyy HH:mm') when 1 then date_format(ts, 'd.M.yyyy H:mm') "
        "when 2 then date_format(ts, 'yyyy-MM-dd HH:mm') else null end"))
    start = convert.parse_start_time("raw")
    return e.select("event_id", F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("start"),
                    convert.iso_day(start).alias("day"), convert.clock_of(start).alias("clock"),
                    convert.iso_day(convert.relative_day(F.col("ts"), 1)).alias("tomorrow"),
                    convert.iso_day(convert.relative_day(F.col("ts"), -30)).alias("month_ago"),
                    F.date_format(convert.from_epoch(F.lit(1700000000) + F.col("event_id")), "yyyy-MM-dd HH:mm:ss")
                    .alias("moment"))


# keyed writes

KEYED = ["o_custkey", "day"]


def _keyed_batch(spark, sf):
    """Orders keyed by customer and day; a null customer stands for an incomplete key."""
    o = b.table(spark, sf, "orders")
    return o.select(F.expr("if(o_orderkey % 50 = 0, null, o_custkey)").alias("o_custkey"),
                    F.col("o_orderdate").cast("date").alias("day"), "o_orderkey", "o_totalprice", "o_orderstatus")


def _keyed_target(spark, sf):
    settled = _keyed_batch(spark, sf).where("o_orderstatus = 'F'")
    return keyed.first_per_key(settled, KEYED, ["o_orderkey"])


def insert_if_absent(spark, sf):
    new = keyed.insert_if_absent(_keyed_target(spark, sf), _keyed_batch(spark, sf), KEYED, ["o_orderkey"])
    return new.select("o_orderkey", "o_custkey", day("day"), "o_totalprice")


def insert_if_absent_bucketed(spark, sf):
    """The whole bucketed table after the batch came twice; the second time only rows with a broken key are new."""
    target, batch = _keyed_target(spark, sf), _keyed_batch(spark, sf)
    path = scratch_dir(spark, "keyed")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    bucketed.bucketed_table(spark, name, path, batch.schema, KEYED, 8)
    for rows in (target, batch, batch.where("o_custkey is not null")):
        bucketed.insert_if_absent_bucketed(spark, name, rows, KEYED, 8, ["o_orderkey"])
    return spark.table(name).select("o_orderkey", "o_custkey", day("day"), "o_totalprice")


def insert_if_absent_idempotent(spark, sf):
    batch = _keyed_batch(spark, sf).where("o_custkey is not null")
    target = _keyed_target(spark, sf).where("o_custkey is not null")
    first = keyed.insert_if_absent(target, batch, KEYED, ["o_orderkey"])
    again = keyed.insert_if_absent(target.unionByName(first), batch, KEYED, ["o_orderkey"])
    counts = [df.agg(F.lit(run).alias("run"), F.count(F.lit(1)).alias("n")) for run, df in ((1, first), (2, again))]
    return counts[0].unionByName(counts[1])


def load_audit(spark, sf):
    batch, target = _keyed_batch(spark, sf), _keyed_target(spark, sf)
    attempted = batch.where("o_custkey is not null")
    return quality.load_audit(batch, attempted, keyed.insert_if_absent(target, attempted, KEYED, ["o_orderkey"]))


def surrogate_ids(spark, sf):
    m = b.matches(spark, sf).select("matchdate", "player1", "player2", "match_id")
    numbered = keyed.with_surrogate_ids(m, 100, ["matchdate", "player1", "player2", "match_id"])
    return numbered.select("id", "match_id")


def upsert_last_wins(spark, sf):
    o = b.table(spark, sf, "orders")
    c = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("player"), F.lit(1500.0).alias("elo"))
    batch = o.select(F.col("o_custkey").alias("player"), F.col("o_totalprice").alias("elo"), "o_orderdate", "o_orderkey")
    return keyed.upsert(c, batch, ["player"], ["o_orderdate", "o_orderkey"])


def update_columns(spark, sf):
    c = b.table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_mktsegment", "c_acctbal", "if(c_custkey % 2 = 0, c_nationkey, null) as c_nationkey")
    patch = b.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("c_acctbal"), F.max("o_orderpriority").alias("c_mktsegment"),
        F.max(F.lit(99)).alias("c_nationkey"), (F.count(F.lit(1)) > 9).alias("busy"))
    return keyed.update_columns(c, patch, "c_custkey", ["c_acctbal", "c_mktsegment", "c_nationkey"],
                                when={"c_mktsegment": "busy"}, keep_existing=["c_nationkey"])


def truncate_and_load(spark, sf):
    """Two reloads of one table, the second computed from the first."""
    root = scratch_dir(spark, "reload")
    n = b.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    tables.truncate_and_load(n, root)
    old = tables.read_latest(spark, root, "rows", n.schema)
    tables.truncate_and_load(old.withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2)), root)
    return tables.read_latest(spark, root, "rows", n.schema)


def append_rows(spark, sf):
    path = scratch_dir(spark, "facts")
    facts = b.table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice", "l_returnflag")
    for _ in range(2):
        tables.append_rows(facts, path, ["l_returnflag"])
    back = tables.read_table(spark, path, ["l_partkey", "l_returnflag", "l_extendedprice"])
    return back.groupBy("l_partkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("l_extendedprice"), 2).alias("top"))


# landed files

def _land_results(spark, sf, odd=False):
    """Results as CSV files with three different headers.

    With ``odd`` the first of them repeats its header between the rows and holds too long rows.
    """
    root = scratch_dir(spark, "landing")
    m = b.matches(spark, sf).select(
        F.col("match_id").alias("Match Id"), F.date_format("matchdate", "yyyy-MM-dd").alias("Date"),
        F.expr("concat(' ', player1, ' ')").alias("Player 1"),
        F.expr("if(match_id % 31 = 0, 'N/A', player2)").alias("Player 2"),
        F.expr("concat(player1score, if(match_id % 2 = 0, '.0', ''))").alias("Player 1 Score"),
        F.expr("if(match_id % 37 = 0, 'abc', cast(player2score as string))").alias("Player 2 Score"),
        F.col("winner").alias("Winner"))
    parts = [m.where("match_id % 3 = 0"),
             m.where("match_id % 3 = 1").select(*reversed(m.columns)),
             m.where("match_id % 3 = 2").drop("Winner").withColumn("Average, Player 1", F.lit("90,5"))]
    if odd:
        # One column of whole lines, for the extra cells have no name.
        line, head = F.concat_ws(",", *[F.trim(F.col(c).cast("string")) for c in m.columns]), ",".join(m.columns)
        lines = parts[0].select("Match Id", F.concat(line, F.expr("if(`Match Id` % 11 = 0, ',,extra', '')")).alias(head))
        again = lines.where("`Match Id` % 101 = 0").select(F.lit(head).alias(head))
        parts[0] = lines.select(head).union(again)
    for name, part in zip("abc", parts):
        sep = "\t" if len(part.columns) == 1 else ","
        part.write.option("header", True).option("sep", sep).option("escape", '"').csv(f"{root}/{name}")
    return f"{root}/*"


def csv_landing(spark, sf):
    columns = {"match_id": "Match Id", **schemas.RESULTS_CSV}
    rows = landing.read_csv_landing(spark, _land_results(spark, sf, odd=True), columns, with_source=True)
    typed = jobs.typed_results(rows, ["match_id", "cells_fit"])
    return typed.select(F.col("match_id").try_cast("bigint").alias("match_id"), "cells_fit", day("matchdate"), "player1", "player2",
                        "player1score", "player2score", "winner")


def csv_rejects(spark, sf):
    """The texts of the rows that the results load keeps back, and why."""
    warehouse = scratch_dir(spark, "warehouse")
    jobs.job_results_load(spark, _land_results(spark, sf, odd=True), warehouse)
    return jobs.read_rejects(spark, warehouse, "results", schemas.RESULTS_STAGED).select("raw", joined("failed"))


def _land_upcoming(spark, sf):
    """Odds files whose bookmaker columns differ; folder, file and line follow a fixed order."""
    root = scratch_dir(spark, "landing")
    lines = b.priced_lines(spark, sf).join(
        b.matches(spark, sf).select(F.col("match_id").alias("id"), "matchdate", "player1", "player2"), "id")
    for n in (1, 2, 3):
        # A range shuffle runs its input twice, so the prices become texts behind it.
        dealt = lines.where(F.col("line") % 3 == n % 3).repartitionByRange("id").sortWithinPartitions("id", "line")
        dealt.selectExpr("*", b.P1, b.P2).select(
            F.col("id").alias("Match Id"), F.date_format("matchdate", "yyyy-MM-dd").alias("Date"), F.col("player1").alias("Player 1"),
            F.expr("if(id % 41 = 0, null, player2)").alias("Player 2"),
            F.col("p1").alias(f"book{n}_P1"), F.col("p2").alias(f"book{n}_P2"),
            F.col("line").alias("No"),
        ).write.option("header", True).csv(f"{root}/{n}")
    return f"{root}/*"


def csv_wide(spark, sf):
    keys = {"id": "Match Id", "line": "No", **schemas.UPCOMING_CSV}
    rows = jobs.typed_upcoming(landing.read_csv_wide(spark, _land_upcoming(spark, sf), keys), ["id", "line"])
    # A column of its own is parsed once; in place it would be for each of the three values.
    rows, m = rows.withColumn("m", odds.parse_odds("odds")), F.col("m")
    return rows.select(F.col("id").cast("bigint").alias("id"), F.col("line").cast("int").alias("line"),
                       day("matchdate"), "player1", "player2",
                       F.array_join(F.array_sort(F.map_keys(m)), ",").alias("books"),
                       F.round(odds.best_odds(m, "_P1"), 9).alias("best_p1"),
                       F.round(odds.best_odds(m, "_P2"), 9).alias("best_p2"))


def dated_csv(spark, sf):
    """Written by the first day of the month and read back by the landing scan."""
    path = scratch_dir(spark, "dated")
    m = b.matches(spark, sf).select("match_id", "matchdate", "player1", F.trunc("matchdate", "month").alias("Date"))
    sinks.write_dated_csv(m, path, "Date")
    back = landing.read_csv_landing(spark, f"{path}/*", {c: c for c in ("match_id", "matchdate", "player1")})
    return back.select(F.col("match_id").cast("bigint").alias("match_id"), "matchdate", "player1")


def results_job(spark, sf):
    warehouse = scratch_dir(spark, "warehouse")
    jobs.job_results_load(spark, _land_results(spark, sf), warehouse)
    gold = tables.read_all(spark, f"{warehouse}/results_gold", "rows", schemas.RESULTS_GOLD)
    return gold.select("match_id", day("matchdate"), "player1", "player2", "player1score", "player2score", "winner")


def upcoming_job(spark, sf):
    warehouse = scratch_dir(spark, "warehouse")
    jobs.job_upcoming_load(spark, _land_upcoming(spark, sf), warehouse)
    gold = tables.read_all(spark, f"{warehouse}/upcoming_gold", "rows", schemas.UPCOMING)
    gold, m = gold.withColumn("m", odds.parse_odds("odds")), F.col("m")
    return gold.select("id", day("matchdate"), "player1", "player2",
                       F.round(odds.best_odds(m, "_P1"), 9).alias("best_p1"),
                       F.round(odds.best_odds(m, "_P2"), 9).alias("best_p2"))


def match_chain(spark, sf):
    """Ratings, predictions and backtest as jobs over one warehouse folder."""
    warehouse = scratch_dir(spark, "warehouse")
    m = b.matches(spark, sf)
    gold = keyed.first_per_key(m.withColumn("pool", F.col("pool").cast("string")), ["player1", "player2", "matchdate"], ["match_id"])
    tables.commit_version(spark, f"{warehouse}/results_gold", {"rows": gold.select(*schemas.RESULTS_GOLD.names)})
    tables.commit_version(spark, f"{warehouse}/upcoming_gold", {"rows": b.upcoming(spark, sf)})
    jobs.job_rating_update(spark, warehouse)
    jobs.job_predict(spark, warehouse, AS_OF)
    scored = jobs.job_backtest(spark, warehouse, AS_OF)
    return scored.select("id", "prediction_id", "player1", "player2", "actual_winner", "player1_match_count",
                         rounded("predicted_p1_prob"), rounded("best_p2_odds"), rounded("log_loss"))


def file_chain(spark, sf):
    """Landed results and odds to published tables, ratings, predictions and backtest; run twice.

    The second run reads the same files again and adds nothing.
    """
    warehouse = scratch_dir(spark, "warehouse")
    results, upcoming = _land_results(spark, sf, odd=True), _land_upcoming(spark, sf)
    pool = F.expr("try_cast(substring(trim(player1), 2) as bigint) div 5")
    for _ in range(2):
        jobs.job_results_load(spark, results, warehouse, pool=pool)
        jobs.job_upcoming_load(spark, upcoming, warehouse)
        jobs.job_rating_update(spark, warehouse)
        jobs.job_predict(spark, warehouse, AS_OF)
        jobs.job_backtest(spark, warehouse, AS_OF)
    scored = tables.read_all(spark, f"{warehouse}/backtest_log", "rows", schemas.BACKTEST_LOG)
    return scored.select("id", "prediction_id", "player1", "player2", "actual_winner", "player1_match_count",
                         rounded("predicted_p1_prob"), rounded("best_p2_odds"), rounded("log_loss"))


def stream_landed(spark, sf):
    root = scratch_dir(spark, "stream")
    schema = b.table(spark, sf, "events").schema

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/batch={batch_id}")

    stream_landing(spark, sf, schema, f"{root}/checkpoint", append, glob="events.parquet")
    return spark.read.parquet(f"{root}/rows").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))


# market

def _star_parts(spark, sf):
    li = b.table(spark, sf, "lineitem")
    return li.selectExpr(
        "if(l_partkey % 9 = 0, '', concat('part ', l_partkey)) as market_hash_name",
        "case when l_partkey % 18 = 0 then null when l_partkey % 9 = 0 then concat('alt ', l_partkey) end as name",
        "if(l_linenumber = 4, null, cast(l_extendedprice as string)) as min_price",
        "cast(l_quantity as string) as quantity")


def star_load_prices(spark, sf):
    """A flat listing for one market, then the landed pages of a paged one for another."""
    warehouse, path = scratch_dir(spark, "market"), scratch_dir(spark, "pages")
    jobs.job_market_snapshot(spark, warehouse, _star_parts(spark, sf), star.FLAT_FIELDS, "east", star.FLAT_FEE)
    b.paged_listings(spark, sf).write.json(path)
    paged = json_payloads.read_json_pages(spark, path)
    s = jobs.job_market_snapshot(spark, warehouse, paged, star.PAGED_FIELDS, "west", star.PAGED_FEE)
    return s.prices.groupBy("item_id", "market_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("price"), 2).alias("price"), F.sum("volume").alias("volume")) \
        .join(s.items.select(F.col("id").alias("item_id"), F.col("name").alias("item")), "item_id") \
        .join(s.markets.select(F.col("id").alias("market_id"), F.col("name").alias("market"), "fee_percent"), "market_id")


def star_items(spark, sf):
    s = star.load_star(schemas.empty(spark, schemas.MARKETS), schemas.empty(spark, schemas.ITEMS),
                       _star_parts(spark, sf), star.FLAT_FIELDS, "east", star.FLAT_FEE)
    return s.items


def snapshot_pages(spark, sf):
    path = scratch_dir(spark, "pages")
    b.paged_listings(spark, sf).write.json(path)
    schema = T.StructType([T.StructField("market", T.LongType()), *schemas.PAGED_LISTING.fields])
    items = json_payloads.read_json_pages(spark, path, schema, keep=["market"])
    return star.named_prices(items, star.PAGED_FIELDS, keep=["market"])


def flat_json_items(spark, sf):
    """Flat listings landed as JSON arrays, one array of two offers per line of text."""
    path = scratch_dir(spark, "flat")
    offer = F.struct("market_hash_name", "name", "min_price", "quantity")
    _star_parts(spark, sf).select(F.to_json(F.array(offer, offer)).alias("value")).write.text(path)
    items = json_payloads.read_json_items(spark, path)
    return star.named_prices(items, star.FLAT_FIELDS).groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("price"), 2).alias("price"), F.sum("volume").alias("volume"))


def listing_filter(spark, sf):
    p = b.table(spark, sf, "part")
    return json_payloads.listing_filter(p, p_brand="Brand#11").select("p_partkey", "p_brand")


# posts

def symbol_extract(spark, sf):
    found = post_symbols(b.posts(spark, sf))
    return found.select("id", F.size("tickers").alias("n"), F.md5(F.array_join("tickers", ",")).alias("tickers"))


def newest_posts_symbols(spark, sf):
    p = b.posts(spark, sf)
    last = p.agg(F.max("created_utc").alias("as_of")).first()["as_of"]
    found = symbol_mentions(p, int(last) - 3600 * 24)
    return found.select("id", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), "title", "score",
                        "num_comments", joined("tickers"))


def newest_rows(spark, sf):
    e = b.table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    return ranking.newest_rows(e, "day", "event_id", 1000).select("event_id", day("day"))


def newest_preview(spark, sf):
    o = b.table(spark, sf, "orders").orderBy("o_orderkey")
    return ranking.preview(o, 3).select("o_orderkey", "o_custkey")


# pages

def page_titles(spark, sf):
    p = b.table(spark, sf, "pages")
    return p.select("page_id", tag_text("html", "title").alias("title"), tag_text("html", "h1").alias("heading"),
                    text.slug(tag_text("html", "title")).alias("slug"))


def page_links(spark, sf):
    p = b.table(spark, sf, "pages")
    links = pages.extract_links(p, "html", "https://site.example", region=None, link_class=None, keep=["page_id"])
    return links.groupBy("page_id", "label", "url").agg(F.count(F.lit(1)).alias("n"))


def match_pages(spark, sf):
    rows = pages.extract_match_pages(b.match_pages(spark, sf), "html", keep=["match_id"])
    return rows.select("match_id", F.date_format("MatchDateTime", "yyyy-MM-dd HH:mm:ss").alias("start"),
                       day("Date"), "Time", F.col("Player 1").alias("p1"), F.col("Player 2").alias("p2"),
                       F.col("Player 1 Score").alias("s1"), F.col("Player 2 Score").alias("s2"), "Winner",
                       F.col("Average Player 1").alias("avg1"), F.col("Average Player 2").alias("avg2"))


def odds_blocks(spark, sf):
    found = pages.extract_odds_blocks(b.odds_pages(spark, sf), "html")
    # An inner explode would also filter by the array's size, and read each page once more for that.
    return found.select("id", F.explode_outer("blocks").alias("x")).where(F.col("x").isNotNull()).select(
        "id", F.col("x.bookmaker").alias("bookmaker"), F.size("x.odds").alias("n"),
        F.round(convert.number(F.get("x.odds", F.lit(0))), 9).alias("p1"),
        F.round(convert.number(F.get("x.odds", F.lit(1))), 9).alias("p2"))


def blocks_to_odds(spark, sf):
    found = pages.extract_odds_blocks(b.odds_pages(spark, sf), "html")
    m = reshape.blocks_to_odds_map(found, "blocks", "m")
    return m.select("id", F.array_join(F.array_sort(F.map_keys("m")), ",").alias("books"),
                    F.round(odds.best_odds("m", "_P1"), 9).alias("best_p1"),
                    F.round(odds.best_odds("m", "_P2"), 9).alias("best_p2"))


def match_list(spark, sf):
    return pages.extract_match_list(b.list_pages(spark, sf), "html", "https://site.example", keep=["o_orderkey"])


def region_links(spark, sf):
    found = pages.extract_links(b.menu_pages(spark, sf), "html", "https://site.example", keep=["c_custkey"])
    return found.select("c_custkey", "label", "url", text.slug("label").alias("slug"))


def pages_to_csv(spark, sf):
    """Match pages to CSV, one folder per month label, and back through the landing scan."""
    path = scratch_dir(spark, "page-csv")
    label = F.concat(F.lit("Season: "), F.regexp_extract("html", r"\d+\.(\d+\.\d+)", 1))
    jobs.job_pages_to_csv(b.match_pages(spark, sf).withColumn("label", label), "html", path, "label")
    back = jobs.typed_results(landing.read_csv_landing(spark, f"{path}/*", schemas.RESULTS_CSV))
    return back.groupBy("matchdate").agg(F.count(F.lit(1)).alias("n"), F.count("winner").alias("decided"),
                                         F.sum("player1score").alias("points")) \
        .select(day("matchdate"), "n", "decided", "points")


def upcoming_pages_to_csv(spark, sf):
    """Pages with players and odds to wide CSV, read back with the odds folded to a map."""
    path = scratch_dir(spark, "odds-csv")
    # Pages made here are far larger than the columns that Spark estimates their size by: never broadcast them.
    both = b.match_pages(spark, sf).withColumnRenamed("match_id", "id").join(
        b.odds_pages(spark, sf).withColumnRenamed("html", "odds_html").hint("merge"), "id")
    paged = both.select(F.concat("html", "odds_html").alias("html"))
    jobs.job_upcoming_pages_to_csv(paged, "html", path, "2002-01-01")
    back = landing.read_csv_wide(spark, f"{path}/*", schemas.UPCOMING_CSV)
    return back.groupBy("player1", "player2", "matchdate").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("odds")).alias("quotes"),
        F.round(F.max(odds.best_odds("odds", "_P1")), 9).alias("best_p1"))


ALL = {f.__name__: f for f in (
    elo_log, elo_rankings, elo_incremental, elo_single_pool, elo_hot_pool, elo_frontier, late_match,
    late_match_snapshot, rankings_in_parts, elo_from_versions, stream_rated, stream_state_rated, register_entities,
    unprocessed, pending, pending_count, asof_own, asof_first_slot, asof_count, asof_null_value, lookup_default, predict, backtest, odds_refresh,
    best_odds, odds_variant, implied_edge, devig, win_probability, log_loss_winner, log_loss_clipped, brier, wide_to_map,
    match_sides, quality_gate_clean, quality_gate_rejects, quality_gate_audit, quality_gate_blank, safe_casts,
    parse_datetimes, insert_if_absent, insert_if_absent_bucketed, insert_if_absent_idempotent, load_audit, surrogate_ids, upsert_last_wins,
    update_columns, truncate_and_load, append_rows, csv_landing, csv_rejects, csv_wide, dated_csv, results_job, upcoming_job,
    match_chain, file_chain, stream_landed, star_load_prices, star_items, snapshot_pages, flat_json_items, listing_filter,
    symbol_extract, newest_posts_symbols, newest_rows, newest_preview, page_titles, page_links, match_pages,
    odds_blocks, blocks_to_odds, match_list, region_links, pages_to_csv, upcoming_pages_to_csv)}
