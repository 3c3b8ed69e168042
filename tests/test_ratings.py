"""The rating fold against a plain sequential one, and its properties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from duelmetrics.operators import asof, elo, ranking
from duelmetrics.plans import jobs
from duelmetrics.sources import tables

SCHEMA = "match_id long, matchdate date, pool string, player1 string, player2 string, winner string"
START = dt.date(2024, 1, 1)


def random_matches(n, players, pools=1, seed=1, days=60, hot=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        pool = f"g{rng.randrange(pools)}"
        a, b = rng.sample(range(players), 2)
        if rng.random() < hot:
            a, b = 0, rng.randrange(1, players)
        p1, p2 = f"{pool}p{a}", f"{pool}p{b}"
        rows.append((i, START + dt.timedelta(days=rng.randrange(days)), pool, p1, p2, rng.choice([p1, p2])))
    return rows


def sequential(rows, state=None, k=32, base=1500):
    ratings, log = dict(state or {}), {}
    for i, day, _, p1, p2, winner in sorted(rows, key=lambda r: (r[1], r[0])):
        r1, r2 = ratings.get(p1, base), ratings.get(p2, base)
        rw, rl = (r1, r2) if winner == p1 else (r2, r1)
        gain = round(k * (1 - 1 / (1 + 10 ** ((rl - rw) / 400))))
        d = gain if winner == p1 else -gain
        ratings[p1], ratings[p2] = r1 + d, r2 - d
        log[i] = (r1, r2, r1 + d, r2 - d, d, -d)
    return log, ratings


def as_dict(log):
    cols = ["player1_elo_before", "player2_elo_before", "player1_elo_after", "player2_elo_after",
            "elo_change_p1", "elo_change_p2"]
    return {r["match_id"]: tuple(r[c] for c in cols) for r in log.select("match_id", *cols).collect()}


def ranks(df):
    return {r["player"]: r["elo"] for r in df.collect()}


@pytest.mark.parametrize("k, r1, r2, gain", [(32, 1500, 1500, 16), (33, 1500, 1500, 16), (32, 1600, 1400, 8), (32, 1400, 1600, 24)])
def test_worked_values(spark, k, r1, r2, gain):
    m = spark.createDataFrame([(1, START, "g", "a", "b", "a")], SCHEMA)
    state = spark.createDataFrame([("g", "a", r1), ("g", "b", r2)], "pool string, player string, elo int")
    assert as_dict(elo.elo_log(m, state, "pool", k=k)) == {1: (r1, r2, r1 + gain, r2 - gain, gain, -gain)}


def test_grouped_equals_sequential_over_pools(spark):
    rows = random_matches(3000, 8, pools=12)
    m = spark.createDataFrame(rows, SCHEMA)
    want, final = sequential(rows)
    log = elo.elo_log(m, None, "pool")
    assert as_dict(log) == want
    assert ranks(ranking.latest_ratings(log)) == final


def test_null_pool_is_a_pool(spark):
    rows = random_matches(800, 20)
    m = spark.createDataFrame(rows, SCHEMA).withColumn("pool", F.lit(None).cast("string"))
    assert as_dict(elo.elo_log(m, None, "pool")) == sequential(rows)[0]


def test_plan_sends_pools_to_several_tasks(spark):
    m = spark.createDataFrame(random_matches(50, 5, pools=3), SCHEMA)
    plan = elo.elo_log(m, None, "pool")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning(_pool" in plan


def test_hot_pool_and_state(spark):
    rows = random_matches(600, 300, hot=0.4, seed=3)
    start = [("g0", f"g0p{i}", 1400 + i) for i in range(0, 300, 3)] + [("g0", "idle", 1700)]
    state = spark.createDataFrame(start, "pool string, player string, elo int")
    log = elo.elo_log(spark.createDataFrame(rows, SCHEMA), state, "pool")
    assert as_dict(log) == sequential(rows, {p: e for _, p, e in start})[0]


def test_same_name_in_two_pools_has_two_ratings(spark):
    rows = [(1, START, "x", "a", "b", "a"), (2, START, "y", "a", "b", "b"), (3, START, "x", "a", "b", "a")]
    m = spark.createDataFrame(rows, SCHEMA)
    got = as_dict(elo.elo_log(m, None, "pool"))
    assert got[2][:2] == (1500, 1500) and got[3][:2] == (1516, 1484)


def test_log_is_zero_sum_and_chained(spark):
    rows = random_matches(500, 10, seed=9)
    log = elo.elo_log(spark.createDataFrame(rows, SCHEMA), None, "pool")
    got = sorted(log.collect(), key=lambda r: (r["match_date"], r["match_id"]))
    last = {}
    for r in got:
        assert r["elo_change_p1"] + r["elo_change_p2"] == 0
        for side in (1, 2):
            assert r[f"player{side}_elo_before"] == last.get(r[f"player{side}"], 1500)
            last[r[f"player{side}"]] = r[f"player{side}_elo_after"]


def test_odd_matches_are_rejected_or_kept(spark):
    rows = [(1, START, "g", "a", "b", "zz"), (2, START, "g", "a", "a", "a"), (3, START, "g", "a", "b", "b")]
    m = spark.createDataFrame(rows, SCHEMA)
    assert set(as_dict(elo.elo_log(m, None, "pool"))) == {3}
    kept = as_dict(elo.elo_log(m, None, "pool", invalid="keep"))
    # The stranger takes the points of side 1 and shows in the slot of side 2.
    assert kept[1] == (1500, 1500, 1484, 1516, -16, 16)
    assert kept[2][:2] == (1484, 1484) and kept[3][0] == 1484 - 16
    with pytest.raises(ValueError):
        elo.elo_log(m, None, "pool", invalid="drop")


@pytest.mark.parametrize("pool", ["x", None])
def test_incremental_run_equals_one_run(spark, tmp_path, pool):
    rows = random_matches(400, 12, seed=11)
    m = spark.createDataFrame(rows, SCHEMA).withColumn("pool", F.lit(pool).cast("string"))
    root = str(tmp_path / "ratings")
    for cut in (20, 40, 60):
        jobs.update_ratings(spark, root, m.where(F.col("matchdate") < F.lit(START + dt.timedelta(days=cut))), "pool")
    want, final = sequential(rows)
    log, rankings = jobs.read_ratings(spark, root)
    assert as_dict(log) == want and ranks(rankings) == final and rankings.count() == len(final)
    jobs.update_ratings(spark, root, m, "pool")
    assert jobs.read_ratings(spark, root)[0].count() == len(rows)


def test_late_match_is_rated_after_the_others_or_its_pool_replayed(spark, tmp_path):
    root = str(tmp_path / "ratings")
    first = spark.createDataFrame([(2, START + dt.timedelta(days=5), "x", "a", "b", "a"),
                                   (3, START, "y", "a", "b", "a")], SCHEMA)
    both = first.union(spark.createDataFrame([(1, START, "x", "a", "b", "a")], SCHEMA))
    jobs.update_ratings(spark, root, first, "pool")
    jobs.update_ratings(spark, root, both, "pool")
    log, rankings = jobs.read_ratings(spark, root)
    assert as_dict(log)[1][:2] == (1516, 1484)
    assert ranks(rankings.where("pool = 'x'")) == {"a": 1516 + 15, "b": 1484 - 15}
    again = as_dict(jobs.replay_pools(spark, root, both, both.where("match_id = 1").select("pool"), "pool"))
    assert again[1][:2] == (1500, 1500) and again[2][:2] == (1516, 1484) and again[3] == as_dict(log)[3]


def test_register_and_unprocessed(spark):
    m = spark.createDataFrame([(1, START, "g", "a", "b", "a"), (2, START, "g", None, "c", "c")], SCHEMA)
    known = spark.createDataFrame([("a", 1600)], "player string, elo int")
    assert sorted(map(tuple, ranking.register_entities(known, m).collect())) == [("b", 1500), ("c", 1500)]
    log = spark.createDataFrame([(1,)], "match_id long")
    assert [r["match_id"] for r in ranking.unprocessed(m, log).collect()] == [2]
    marks = spark.createDataFrame([(1, True), (2, False), (3, False)], "match_id long, processed boolean")
    assert [r["match_id"] for r in ranking.pending(m, marks).collect()] == [2]
    assert ranking.pending_count(marks).first()[0] == 2


LOG = [(1, "a", "b", 1510, 1490, 1), (2, "b", "c", 1480, 1520, 2), (3, "a", "c", 1515, 1510, 2)]


def small_log(spark):
    return spark.createDataFrame(
        [(i, a, b, x, y, dt.datetime(2024, 1, d)) for i, a, b, x, y, d in LOG],
        "match_id long, player1 string, player2 string, player1_elo_after int, player2_elo_after int, match_date timestamp")


def looked_up(spark, side, day):
    req = spark.createDataFrame([(1, dt.date(2024, 1, day), "b", "c")], "id long, matchdate date, player1 string, player2 string")
    r = asof.asof_both_sides(req, small_log(spark), side=side).first()
    return r["player1_elo"], r["player1_match_count"], r["player2_elo"], r["player2_match_count"]


def test_asof_worked_values(spark):
    assert looked_up(spark, "own", 2) == (1490, 1, None, 0)
    assert looked_up(spark, "first", 2) == (1510, 1, None, 0)
    assert looked_up(spark, "own", 3) == (1480, 2, 1510, 2)
    assert looked_up(spark, "first", 3) == (1480, 2, 1515, 2)


def test_null_value_never_hides_an_earlier_one(spark):
    log = spark.createDataFrame([(1, "b", "x", 1490, 1, dt.datetime(2024, 1, 2)), (2, "b", "x", 1510, 1, dt.datetime(2024, 1, 3)),
                                 (3, "b", "x", None, 1, dt.datetime(2024, 1, 3))], small_log(spark).schema)
    req = spark.createDataFrame([(1, dt.date(2024, 1, 4), "b", "q")], "id long, matchdate date, player1 string, player2 string")
    got = asof.asof_both_sides(req, log).first()
    assert (got["player1_elo"], got["player1_match_count"]) == (1510, 3)


def test_asof_against_brute_force(spark):
    rows = random_matches(400, 15, seed=21, days=25)
    log = elo.elo_log(spark.createDataFrame(rows, SCHEMA), None, "pool")
    facts = log.collect()
    req = spark.createDataFrame(rows, SCHEMA).select("match_id", "matchdate", "player1", "player2")
    for side in ("own", "first"):
        for r in asof.asof_both_sides(req, log, side=side).collect():
            for n in (1, 2):
                player = r[f"player{n}"]
                earlier = sorted((f["match_date"].date(), f["match_id"], f["player1_elo_after"]
                                  if side == "first" or f["player1"] == player else f["player2_elo_after"])
                                 for f in facts if player in (f["player1"], f["player2"])
                                 and f["match_date"].date() < r["matchdate"])
                assert r[f"player{n}_match_count"] == len(earlier)
                assert r[f"player{n}_elo"] == (earlier[-1][2] if earlier else None)


def test_self_match_counts_once(spark):
    log = spark.createDataFrame([(1, "a", "a", 1500, 1500, dt.datetime(2024, 1, 1))], small_log(spark).schema)
    req = spark.createDataFrame([(1, dt.date(2024, 1, 2), "a", "b")], "id long, matchdate date, player1 string, player2 string")
    assert asof.asof_count(req, log).first()["player1_match_count"] == 1


def test_asof_plan_has_no_product_and_one_python_node(spark):
    rows = random_matches(50, 5)
    m = spark.createDataFrame(rows, SCHEMA)
    plan = asof.asof_both_sides(m, elo.elo_log(m, None, "pool"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BatchEvalPython" not in plan and "FlatMapGroupsInPandas" not in plan


def test_repeated_tag_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "ratings")
    m = spark.createDataFrame(random_matches(30, 5), SCHEMA)
    jobs.update_ratings(spark, root, m, "pool", tag="stream-0")
    again = jobs.update_ratings(spark, root, m, "pool", tag="stream-0")
    assert again.count() == 30 and tables.versions(spark, root) == [1]
