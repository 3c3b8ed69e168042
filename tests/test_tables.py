"""Keyed writes, versions, gate, star schema."""

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from duelmetrics import schemas
from duelmetrics.operators import keyed, quality, ranking, reshape, star
from duelmetrics.plans import jobs
from duelmetrics.plans.mentions import symbol_mentions
from duelmetrics.session import scratch_dir
from duelmetrics.sources import json_payloads, sinks, tables

KV = "k string, d int, v string, at int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_first_writer_wins_inside_the_batch_and_against_the_target(spark):
    target = spark.createDataFrame([("a", 1, "old", 0)], KV)
    batch = spark.createDataFrame([("a", 1, "x", 1), ("b", 1, "late", 5), ("b", 1, "early", 2), ("b", 2, "y", 3)], KV)
    new = keyed.insert_if_absent(target, batch, ["k", "d"], ["at"])
    assert rows(new) == [("b", 1, "early", 2), ("b", 2, "y", 3)]
    assert keyed.insert_if_absent(target.union(new), batch, ["k", "d"], ["at"]).isEmpty()


def test_pruned_target_gives_the_same_rows(spark):
    target = spark.createDataFrame([("a", d, "old", 0) for d in range(50)], KV)
    batch = spark.createDataFrame([("a", 49, "x", 1), ("a", 51, "y", 1), ("b", 49, "z", 1), ("c", None, "w", 1)], KV)
    plain, pruned = (keyed.insert_if_absent(target, batch, ["k", "d"], ["at"], prune_by=p) for p in (None, "d"))
    assert rows(plain) == rows(pruned) and len(rows(plain)) == 3


def test_rows_with_a_null_key_never_clash(spark):
    target = spark.createDataFrame([(None, 1, "old", 0)], KV)
    batch = spark.createDataFrame([(None, 1, "x", 1), (None, 1, "x", 1)], KV)
    assert keyed.insert_if_absent(target, batch, ["k", "d"]).count() == 2


def test_key_only_batch(spark):
    target = spark.createDataFrame([("a",)], "name string")
    batch = spark.createDataFrame([("a",), ("b",), ("b",)], "name string")
    assert rows(keyed.insert_if_absent(target, batch, ["name"])) == [("b",)]


def test_map_column_survives_the_fold(spark):
    batch = spark.createDataFrame([("a", {"x": "1"}, 2), ("a", {"x": "0"}, 1)], "k string, m map<string,string>, at int")
    assert rows(keyed.first_per_key(batch, ["k"], ["at"])) == [("a", {"x": "0"}, 1)]


def test_upsert_last_value_wins(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "player string, elo int")
    batch = spark.createDataFrame([("b", 5, 1), ("b", 7, 2), ("c", 9, 1)], "player string, elo int, at int")
    assert rows(keyed.upsert(target, batch, ["player"], ["at"])) == [("a", 1), ("b", 7), ("c", 9)]


def test_update_columns_by_condition(spark):
    target = spark.createDataFrame([(1, 1, 1, None), (2, 2, 2, 2), (3, 3, 3, 3)], "id int, a int, b int, c int")
    patch = spark.createDataFrame([(1, 10, 10, 10, True), (2, 20, 20, 20, False)], "id int, a int, b int, c int, ok boolean")
    got = keyed.update_columns(target, patch, "id", ["a", "b", "c"], when={"b": "ok"}, keep_existing=["c"])
    assert rows(got) == [(1, 10, 10, 10), (2, 20, 2, 2), (3, 3, 3, 3)]


def test_surrogate_ids_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(6)
    got = keyed.with_surrogate_ids(df, 50, ["x"]).collect()
    assert sorted((r["id"], r["x"]) for r in got) == [(51 + i, i) for i in range(1000)]


def test_versions_replace_append_and_ignore_unfinished(spark, tmp_path):
    root = str(tmp_path / "t")
    one = spark.createDataFrame([("a", 1)], schemas.RANKINGS)
    assert tables.read_latest(spark, root, "rows", schemas.RANKINGS).isEmpty()
    tables.truncate_and_load(one, root)
    old = tables.read_latest(spark, root, "rows", schemas.RANKINGS)
    tables.truncate_and_load(old.withColumn("elo", (F.col("elo") + 1).cast("int")), root)
    one.write.parquet(f"{root}/v9/rows")
    assert rows(tables.read_latest(spark, root, "rows", schemas.RANKINGS)) == [("a", 2)]
    assert rows(tables.read_all(spark, root, "rows", schemas.RANKINGS)) == [("a", 1), ("a", 2)]


def test_reload_keeps_the_newest_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    for elo in (1, 2, 3):
        tables.truncate_and_load(spark.createDataFrame([("a", elo)], schemas.RANKINGS), root)
    assert tables.versions(spark, root) == [2, 3] and not (tmp_path / "t" / "v1").exists()
    assert rows(tables.read_latest(spark, root, "rows", schemas.RANKINGS)) == [("a", 3)]


def test_jobs_leave_nothing_staged(spark, tmp_path):
    left = Path(scratch_dir(spark, "probe").removeprefix("file:")).parent
    before = set(left.iterdir()) if left.exists() else set()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r.csv").write_text(
        "Date,Player 1,Player 2,Player 1 Score,Player 2 Score,Winner\n2024-01-01,a,b,3,1,a\n2024-01-02,a,b,3,1,b")
    warehouse = str(tmp_path / "wh")
    jobs.job_results_load(spark, str(tmp_path / "in"), warehouse).collect()
    jobs.job_rating_update(spark, warehouse).collect()
    listing = spark.createDataFrame([("knife", None, "10.5", "3")], schemas.FLAT_LISTING)
    jobs.job_market_snapshot(spark, warehouse, listing, star.FLAT_FIELDS, "east", star.FLAT_FEE)
    assert set(left.iterdir()) == before


def test_lookup_with_default(spark, tmp_path):
    path = str(tmp_path / "ranks")
    spark.createDataFrame([("a", 1600)], "player string, elo int").write.parquet(path)
    looked = tables.left_lookup(spark.createDataFrame([("a",), ("z",)], "p string"),
                                tables.read_lookup(spark, path, "player", "elo"), "p", "player", "elo", "e", 1500)
    assert rows(looked) == [("a", 1600), ("z", 1500)]


def gate_rows(spark):
    return spark.createDataFrame(
        [("a", "b", "a"), ("a", None, "a"), ("", "b", "b"), ("a", "b", "z"), ("a", "a", "a"), (None, None, None)],
        "player1 string, player2 string, winner string")


def test_gate_counts_and_reasons(spark):
    gate = quality.quality_gate(gate_rows(spark), ["player1", "player2", "winner"])
    assert gate.clean.count() == 4
    assert {tuple(r["failed"]) for r in gate.rejects.collect()} == {("player2",), ("player1", "player2", "winner")}
    audit = gate.audit.first().asDict()
    assert audit == {"rows_read": 6, "rows_rejected": 2, "rows_clean": 4, "failed_player1": 1,
                     "failed_player2": 2, "failed_winner": 1}


def test_gate_options(spark):
    strict = quality.quality_gate(gate_rows(spark), ["player1"], blank_is_null=True, rules=quality.two_player_rules())
    assert rows(strict.clean) == [("a", "b", "a")]
    long = spark.createDataFrame([("x" * 101,), ("y",)], "player1 string")
    assert quality.quality_gate(long, [], rules=quality.length_rules(["player1"])).clean.count() == 1


def test_star_load_of_two_markets(spark, tmp_path):
    warehouse = str(tmp_path)
    listed = [("knife", None, "10.5", "3"), ("", "gloves", None, None), (None, "", "1", "1"), ("knife", None, "11", "x")]
    flat = spark.createDataFrame(listed, schemas.FLAT_LISTING)
    first = jobs.job_market_snapshot(spark, warehouse, flat, star.FLAT_FIELDS, "east", star.FLAT_FEE)
    assert rows(first.items) == [(1, "gloves"), (2, "knife")]
    assert rows(first.prices) == [(1, 1, 0.0, 0), (2, 1, 10.5, 3), (2, 1, 11.0, 0)]
    paged = spark.createDataFrame([("axe", None, "2", "1"), ("knife", None, "9", "4")],
                                  "market_hash_name string, name string, sell_min_price string, sell_num string")
    second = jobs.job_market_snapshot(spark, warehouse, paged, star.PAGED_FIELDS, "west", star.PAGED_FEE)
    assert rows(second.markets) == [(1, "east", 0.12), (2, "west", 0.02)]
    assert rows(second.items) == [(1, "gloves"), (2, "knife"), (3, "axe")]
    assert second.prices.count() == 5 and (2, 2, 9.0, 4) in rows(second.prices)


def test_paged_listing_rules(spark, tmp_path):
    page = '{"data": {"page_num": %d, "total_page": 200, "items": [{"name": "i%d"}]}}'
    lines = [page % (n, n) for n in (1, 100, 101, 300)] + ['{"msg": "no data"}', '{"data": {"items": [{"name": "bare"}]}}']
    (tmp_path / "p.json").write_text("\n".join(lines))
    got = json_payloads.read_json_pages(spark, str(tmp_path / "p.json"))
    assert sorted(r["name"] for r in got.collect()) == ["bare", "i1", "i100", "i101", "i300"]
    capped = json_payloads.read_json_pages(spark, str(tmp_path / "p.json"), max_page=100)
    assert sorted(r["name"] for r in capped.collect()) == ["bare", "i1", "i100"]


def test_flat_listing_array_over_several_lines(spark, tmp_path):
    (tmp_path / "f.json").write_text('[\n {"market_hash_name": "a", "min_price": 1.5, "quantity": 2},\n {"name": "b"}\n]')
    got = json_payloads.read_json_items(spark, str(tmp_path), multi_line=True)
    assert rows(got.select("market_hash_name", "name", "min_price")) == [("a", None, "1.5"), (None, "b", None)]
    assert json_payloads.listing_filter(got, name="b").count() == 1


def test_mentions_read_the_whole_time_range(spark):
    now = 40 * 86400
    posts = [(str(i), float(now - i * 86400), "GME", "$YOLO", i, 0) for i in range(0, 40)]
    df = spark.createDataFrame(posts, "id string, created_utc double, title string, selftext string, score int, num_comments int")
    assert symbol_mentions(df, now).count() == 31
    assert symbol_mentions(df, now - 20 * 86400).count() == 20
    assert symbol_mentions(df, now).first()["tickers"] == ["GME", "YOLO"]
    many = spark.range(3000).selectExpr("cast(id as string) AS id", "cast(id as double) AS created_utc", "'GME' AS title", "'' AS selftext", "1 AS score", "0 AS num_comments")
    assert symbol_mentions(many, 3000).count() == 3000
    assert ranking.preview(df, 3).count() == 3


def test_maps_and_sides(spark):
    wide = spark.createDataFrame([("x", "1.5", "", None)], "k string, A_P1 string, A_P2 string, B_P1 string")
    folded = reshape.wide_to_map(wide, ["k"])
    assert folded.first()["odds"] == {"A_P1": "1.5"}
    assert rows(reshape.map_to_wide(folded, "odds", ["A_P1", "B_P1"])) == [("x", "1.5", None)]
    assert reshape.wide_to_map(wide.select("k"), ["k"]).first()["odds"] == {}
    m = spark.createDataFrame([(1, "a", "b"), (2, "a", "a")], "id int, player1 string, player2 string")
    assert rows(reshape.sides(m, {"p": ("player1", "player2")}, ["id"])) == [(1, "a"), (1, "b"), (2, "a")]


def test_dated_csv_skips_nothing_but_empty(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "a", {"k": "v"}), (dt.date(2024, 1, 2), "b", {})],
                               "Date date, p string, m map<string,string>")
    path = str(tmp_path / "out")
    assert not sinks.write_dated_csv(df.limit(0), path, "Date")
    assert sinks.write_dated_csv(df, path, "Date")
    back = spark.read.option("header", True).option("escape", '"').csv(f"{path}/date_folder=2024-01-01")
    assert rows(back) == [("2024-01-01", "a", '{"k":"v"}')]


def test_append_keeps_duplicates(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, 2.0, 3)], schemas.PRICES)
    for _ in range(2):
        tables.append_rows(df, str(tmp_path / "f"), ["market_id"])
    assert tables.read_table(spark, str(tmp_path / "f"), ["price"]).count() == 2
