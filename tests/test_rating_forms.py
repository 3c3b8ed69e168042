"""Other forms of the rating: rounds of joins, state of a stream, and the store in parts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_ratings import SCHEMA, START, as_dict, random_matches, ranks, sequential

from duelmetrics.operators import elo
from duelmetrics.plans import jobs, rating_store
from duelmetrics.sources import tables
from duelmetrics.streaming.rating_state import stream_state_ratings


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


# rounds of joins

@pytest.mark.parametrize("invalid", ["reject", "keep"])
def test_rounds_equal_the_stream(spark, invalid):
    """Ties of days, null pools, players against themselves, winners from outside, ratings held before."""
    rng = random.Random(8)
    rows = []
    for i, day, pool, p1, p2, winner in random_matches(240, 60, pools=2, seed=8, days=5):
        odd = rng.random()
        pool = None if pool == "g1" else pool
        if odd < 0.05:
            p2 = winner = p1
        elif odd < 0.1:
            winner = f"g0p{rng.randrange(60)}"
        elif odd < 0.13:
            winner = None
        rows.append((i, day if odd < 0.9 else None, pool, p1, p2, winner))
    state = spark.createDataFrame([(None, "g1p3", 1700), ("g0", "g0p1", 1321), ("g0", "g1p3", 1), ("g0", "idle", 1900)],
                                  "pool string, player string, elo int")
    m = frame(spark, rows)
    logs = [elo.elo_log(m, state, "pool", invalid=invalid, method=method) for method in ("stream", "frontier")]
    assert logs[0].columns == logs[1].columns
    assert as_dict(logs[1]) == as_dict(logs[0]) and len(as_dict(logs[1])) > 150


def test_rounds_of_one_pool_without_matches_left_over(spark):
    rows = random_matches(150, 100, seed=4, days=400)
    assert as_dict(elo.elo_log(frame(spark, rows), None, "pool", k=33, base=1000, method="frontier")) == sequential(rows, k=33, base=1000)[0]
    assert elo.elo_log(frame(spark, []), None, "pool", method="frontier").count() == 0
    with pytest.raises(ValueError):
        elo.elo_log(frame(spark, rows), None, "pool", method="guess")


# state of a stream

def test_stream_keeps_its_ratings_over_restarts(spark, tmp_path):
    rows = [(i, day, None if pool == "g2" else pool, p1, p2, w) for i, day, pool, p1, p2, w in random_matches(300, 9, pools=3, seed=5)]
    rows += [(900, START, "g0", "g0p1", "g0p1", "g0p1"), (901, START, "g0", "g0p1", "g0p2", "stranger")]
    landed, args = str(tmp_path / "landed"), (str(tmp_path / "checkpoint"), str(tmp_path / "log"))
    m = frame(spark, rows)
    for n, (low, high) in enumerate(((0, 15), (15, 30), (30, 45), (45, 60))):
        part = m.where((F.col("matchdate") >= F.lit(START + dt.timedelta(days=low))) & (F.col("matchdate") < F.lit(START + dt.timedelta(days=high))))
        part.coalesce(1).write.mode("append").parquet(landed)
        if n != 1:
            log = stream_state_ratings(spark, landed, m.schema, *args, lambda df: df, "pool", max_files=1)
    assert as_dict(log) == sequential([r for r in rows if r[0] < 900])[0]
    # Nothing new has landed: nothing is rated again.
    assert stream_state_ratings(spark, landed, m.schema, *args, lambda df: df, "pool").count() == 300


# store in parts

def stored(spark, root):
    log, rankings = rating_store.read_store(spark, root)
    return as_dict(log), ranks(rankings)


def options(**more):
    return {"groups": 4, "period": "month", **more}


def test_late_and_corrected_matches(spark, tmp_path):
    root = str(tmp_path)
    rows = random_matches(300, 9, pools=5, seed=12, days=120)
    rng = random.Random(3)
    late = {r[0] for r in rows if rng.random() < 0.2}
    rating_store.rate_matches(spark, root, frame(spark, [r for r in rows if r[0] not in late]), "pool", **options())
    for part in (lambda i: i % 2 == 0, lambda i: i % 2 == 1):
        rating_store.rate_matches(spark, root, frame(spark, [r for r in rows if r[0] in late and part(r[0])]), "pool", **options())
    assert stored(spark, root) == sequential(rows)
    # Winners are corrected, one of them to nobody, which leaves the match out.
    fixed = [(i, d, g, p1, p2, p1 if w == p2 else p2) if i % 40 == 0 else (i, d, g, p1, p2, "nobody") if i == 41 else (i, d, g, p1, p2, w)
             for i, d, g, p1, p2, w in rows]
    rating_store.rate_matches(spark, root, frame(spark, [r for r in fixed if r[0] % 40 == 0 or r[0] == 41]), "pool", **options())
    log, final = sequential([r for r in fixed if r[0] != 41])
    assert stored(spark, root) == (log, final)


def test_players_without_a_rated_match_have_the_base_rating(spark, tmp_path):
    root = str(tmp_path)
    rows = [(1, START, "x", "a", "b", "nobody"), (2, None, "x", "c", None, "c"), (3, START + dt.timedelta(days=40), "x", "b", "c", "b")]
    rating_store.rate_matches(spark, root, frame(spark, rows), "pool", **options())
    rating_store.rate_matches(spark, root, frame(spark, [(4, START + dt.timedelta(days=80), "x", "d", "e", None)]), "pool", **options())
    assert stored(spark, root)[1] == {"a": 1500, "b": 1516, "c": 1484, "d": 1500, "e": 1500}
    # The only match of its period is corrected away: its part is empty from then on.
    rating_store.rate_matches(spark, root, frame(spark, [(3, START + dt.timedelta(days=40), "x", "b", "c", None)]), "pool", **options())
    assert stored(spark, root) == ({}, {"a": 1500, "b": 1500, "c": 1500, "d": 1500, "e": 1500})


def test_a_run_touches_only_its_parts(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = random_matches(400, 9, pools=12, seed=2, days=120)
    first = [r for r in rows if r[0] >= 5]
    rating_store.rate_matches(spark, root, frame(spark, first), "pool", **options())
    before = tables.current_parts(spark, root, "log", 2)
    opened = []
    read = tables.read_parts
    monkeypatch.setattr(tables, "read_parts", lambda spark, paths, schema: (opened.extend(paths), read(spark, paths, schema))[1])
    pool = rows[0][2]
    day = START + dt.timedelta(days=95)
    rating_store.rate_matches(spark, root, frame(spark, [(1000, day, pool, f"{pool}p1", f"{pool}p2", f"{pool}p1")]), "pool", **options())
    after = tables.current_parts(spark, root, "log", 2)
    changed = [p for p in after if before.get(p) != after[p]]
    assert len({p.split("/")[0] for p in changed}) == 1 and all(p.split("=")[-1] >= "2024-04-01" for p in changed)
    assert len(before) > len(changed) > 0
    # Of the log only the periods from that day on were opened, and one snapshot before them and the last.
    assert {p for p in opened if "/log/" in p} == {before[p] for p in changed if p in before}
    assert len([p for p in opened if "/snapshots/" in p]) == 2
    assert stored(spark, root)[0] == sequential([*first, (1000, day, pool, f"{pool}p1", f"{pool}p2", f"{pool}p1")])[0]


def test_only_new_versions_of_gold_are_opened(spark, tmp_path):
    root, gold = str(tmp_path / "ratings"), str(tmp_path / "gold")
    rows = random_matches(200, 9, pools=3, seed=7)
    for k in range(3):
        tables.commit_version(spark, gold, {"rows": frame(spark, [r for r in rows if r[0] % 3 == k])})
        if k != 1:
            new = rating_store.rate_gold(spark, root, gold, frame(spark, []).schema, "pool", **options())
            wanted = {0: {"v1"}, 2: {"v2", "v3"}}[k]
            assert {f.rsplit("/rows/", 1)[0].rsplit("/", 1)[1] for f in new.inputFiles()} == wanted
    assert stored(spark, root)[0] == sequential(rows)[0]
    done = tables.versions(spark, root)
    assert rating_store.rate_gold(spark, root, gold, frame(spark, []).schema, "pool", **options()).count() == 0
    assert tables.versions(spark, root) == done


def test_nothing_to_rate(spark, tmp_path):
    assert rating_store.rate_matches(spark, str(tmp_path), frame(spark, []), "pool", **options()) is None
    assert stored(spark, str(tmp_path)) == ({}, {})
    m = frame(spark, random_matches(10, 4))
    first = rating_store.rate_matches(spark, str(tmp_path), m, "pool", tag="a", **options())
    assert rating_store.rate_matches(spark, str(tmp_path), m, "pool", tag="a", **options()) == first
    assert jobs.read_ratings(spark, str(tmp_path / "other"))[0].count() == 0


def test_merged_versions_hold_all_rows_once(spark, tmp_path):
    root, gold = str(tmp_path / "ratings"), str(tmp_path / "gold")
    schema = frame(spark, []).schema
    rows = random_matches(120, 9, pools=2, seed=17)
    assert tables.merge_versions(spark, gold, {"rows": schema}) is None
    for k in range(4):
        tables.commit_version(spark, gold, {"rows": frame(spark, [r for r in rows if r[0] % 4 == k])})
        if k % 2:
            assert tables.merge_versions(spark, gold, {"rows": schema}) == tables.merge_versions(spark, gold, {"rows": schema})
        if k == 2:
            rating_store.rate_gold(spark, root, gold, schema, "pool", **options())
        assert sorted(r.match_id for r in tables.read_all(spark, gold, "rows", schema).collect()) == [i for i in range(120) if i % 4 <= k]
    assert len(tables.read_all(spark, gold, "rows", schema).inputFiles()) <= 2 and tables.added_versions(spark, gold) == [1, 2, 4, 5]
    assert tables.newest_max(spark, gold, "rows", schema, "match_id") == 119
    # The merged versions bring nothing new to rate.
    new = rating_store.rate_gold(spark, root, gold, schema, "pool", **options())
    assert {r.match_id % 4 for r in new.collect()} == {3}
    assert stored(spark, root) == sequential(rows)


def test_predictions_take_ratings_from_the_store(spark, tmp_path):
    rows = [(i, d, None, p1, p2, w) for i, d, _, p1, p2, w in random_matches(60, 6, seed=3)]
    gold = frame(spark, rows).selectExpr("match_id", "matchdate", "player1", "player2", "1 as player1score", "2 as player2score", "winner", "pool")
    upcoming = spark.createDataFrame([(1, START + dt.timedelta(days=90), "g0p1", "g0p2", '{"x_P1": "2"}')], "id long, matchdate date, player1 string, player2 string, odds string")
    made = []
    for kind in (jobs.job_rating_update, jobs.job_rating_store):
        warehouse = str(tmp_path / kind.__name__)
        tables.commit_version(spark, f"{warehouse}/results_gold", {"rows": gold})
        tables.commit_version(spark, f"{warehouse}/upcoming_gold", {"rows": upcoming})
        kind(spark, warehouse)
        made.append([tuple(r) for r in jobs.job_predict(spark, warehouse, "2025-01-01 12:00:00").collect()])
    assert made[0] == made[1] and len(made[0]) == 1 and made[0][0][5] != 1500
