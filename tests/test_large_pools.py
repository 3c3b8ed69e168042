"""Pools larger than a task's sort, and rounds that pass the driver by."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from duelmetrics.operators import elo, elo_frontier

SCHEMA = "match_id long, matchdate date, player1 string, player2 string, winner string, pool long"
STATE = "player string, elo int, pool long"


def many(n=400):
    import datetime
    draw = random.Random(5)
    rows = []
    for i in range(n):
        # Two pools are large; names recur in all pools, some winners are strangers, some play themselves.
        pool = draw.choice([None, None, None, 1, 1, 1, 2, 3])
        one, two = f"p{draw.randrange(12)}", f"p{draw.randrange(12)}"
        won = draw.choice([one, two, one, two, "p5", "stranger"])
        day = datetime.date(2024, 1, 1) + datetime.timedelta(days=draw.randrange(30))
        rows.append((i, day, one, two, won, pool))
    return rows


def logged(df):
    return sorted(df.collect(), key=lambda r: r["match_id"])


@pytest.mark.parametrize("invalid", ["reject", "keep"])
@pytest.mark.parametrize("held", [False, True])
def test_a_pool_in_slices_has_the_log_of_one_stream(spark, monkeypatch, invalid, held):
    m = spark.createDataFrame(many(), SCHEMA)
    state = spark.createDataFrame([("p1", 1700, None), ("p1", 1300, 1), ("p2", 1650, 1), ("p3", 1800, 2)], STATE) if held else None
    whole = logged(elo.elo_log(m, state, "pool", invalid=invalid))
    sizes = []
    fold = elo._run_fold

    def counted(rows, *args, **kwargs):
        sizes.append(rows.where("_kind = 1").groupBy("_pool").count().agg(F.max("count")).first()[0] or 0)
        return fold(rows, *args, **kwargs)

    monkeypatch.setattr(elo, "_run_fold", counted)
    monkeypatch.setattr(elo, "SLICE", 60)
    assert logged(elo.elo_log(m, state, "pool", invalid=invalid)) == whole
    assert len(sizes) > 3 and max(sizes) < 120


def test_matches_that_tie_stay_in_one_slice(spark, monkeypatch):
    rows = [Row(match_id=i // 40, matchdate="2024-01-01", player1=f"a{i}", player2=f"b{i}", winner=f"a{i}", pool=0) for i in range(200)]
    m = spark.createDataFrame(rows)
    monkeypatch.setattr(elo, "SLICE", 30)
    log = elo.elo_log(m, None, "pool")
    assert log.count() == 200 and log.where("player1_elo_after = 1516").count() == 200


def test_the_rounds_of_the_frontier_broadcast_nothing(spark, monkeypatch):
    plans = []
    stage = elo_frontier.stage

    def seen(df, label, *args):
        if label == "frontier":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label, *args)

    monkeypatch.setattr(elo_frontier, "stage", seen)
    m = spark.createDataFrame([r for r in many(60) if r[2] != r[3]], SCHEMA)
    elo.elo_log(m, None, "pool", method="frontier").count()
    assert len(plans) > 2 and not any("Broadcast" in p for p in plans[1:])
