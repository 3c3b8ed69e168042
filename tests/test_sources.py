"""Landed CSV files, stored pages, streams and the whole chain of jobs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duelmetrics import schemas
from duelmetrics.functions.odds import parse_odds
from duelmetrics.operators import reshape
from duelmetrics.plans import jobs
from duelmetrics.sources import csv_landing, pages, sinks, tables
from duelmetrics.streaming.landing import stream_landing, stream_ratings

HEADER = "MatchDateTime,Date,Time,Player 1,Player 2,Player 1 Score,Player 2 Score,Winner,Average Player 1,Average Player 2"


def land(folder, files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def results_files(folder):
    def line(day, p1, p2, s1, s2, w):
        return f"{day} 20:00:00,{day},20:00:00,{p1},{p2},{s1},{s2},{w},90.1,88.2"

    return land(folder, {
        "a.csv": "\n".join([HEADER,
                            line("2024-01-01", " Ann ", "Bob", "3.0", "1", "Ann"),
                            line("2024-01-01", "Cid", "Dan", "abc", "1", "Dan"),
                            line("2024-01-02", "Cid", "Dan", "", "1", "Dan"),
                            line("2024-01-03", "NA", "Dan", "2", "1", "Dan"),
                            line("", "Eve", "Dan", "2", "1", "Dan"),
                            line("2024-01-04", "Eve", "Dan", "2", "1", ""),
                            line("2024-01-05", "Eve", "Dan", "2", "1", "Zoe"),
                            line("2024-01-05", "Eve", "Eve", "2", "1", "Eve")]),
        "b.csv": "\n".join(["﻿Winner,Player 2,Player 1,Date,Player 2 Score,Player 1 Score",
                            "Bob,Bob,Ann,2024-01-01,6,5", "Bob,Bob,Ann,2024-01-08,6,5", "Ann,Ann,Bob,2024-01-01,6,5"]),
        "c.csv": "Date,Player 1,Player 2\n2024-01-09,Ann,Bob",
        "d.csv": "", "e.csv": HEADER + "\n", "notes.txt": "Date\n2024-01-01",
    })


def test_landing_reads_by_name_whatever_the_header(spark, tmp_path):
    got = csv_landing.read_csv_landing(spark, results_files(tmp_path / "in"), schemas.RESULTS_CSV)
    typed = jobs.typed_results(got).collect()
    assert len(typed) == 12
    first = [r for r in typed if r["player1"] == "Ann" and r["player1score"] == 3][0]
    assert (first["matchdate"], first["winner"], first["player2score"]) == (dt.date(2024, 1, 1), "Ann", 1)
    assert [r["winner"] for r in typed if r["matchdate"] == dt.date(2024, 1, 9)] == [None]


def test_repeated_headers_and_long_rows_are_counted(spark, tmp_path):
    text = "Date,Player 1,Player 2,Player 1 Score,Player 2 Score,Winner"
    landing = land(tmp_path / "in", {
        "a.csv": "\n".join(["", text, "2024-01-01,Ann,Bob,3,1,Ann", text, "2024-01-02,Ann,Bob,3,1,Ann,extra",
                            "2024-01-03,Ann,Bob,3,1,Ann,,", '2024-01-04,"A, nn",Bob,3,1,Bob', "2024-01-05,Ann,Bob,x"]),
        "b.csv": "Player 1,Player 2\nAnn,Bob,left over\nAnn,Bob"})
    warehouse = str(tmp_path / "wh")
    audit = jobs.job_results_load(spark, landing, warehouse).first()
    assert (audit["rows_read"], audit["rows_clean"], audit["failed_cells_fit"]) == (8, 3, 2)
    kept_back = jobs.read_rejects(spark, warehouse, "results", schemas.RESULTS_STAGED).collect()
    raw = {r["raw"].rstrip(","): r["failed"] for r in kept_back}
    assert set(raw) == {text, "2024-01-02,Ann,Bob,3,1,Ann,extra", "2024-01-05,Ann,Bob,x", "Ann,Bob,left over", "Ann,Bob"}
    assert raw["2024-01-02,Ann,Bob,3,1,Ann,extra"] == ["cells_fit"]
    rows = csv_landing.read_csv_landing(spark, landing, schemas.RESULTS_CSV, with_source=True)
    assert rows.where(~F.col("cells_fit")).count() == 2 and rows.count() == 8


def test_results_job_gates_and_keeps_the_first(spark, tmp_path):
    landing, warehouse = results_files(tmp_path / "in"), str(tmp_path / "wh")
    audit = jobs.job_results_load(spark, landing, warehouse).first().asDict()
    assert (audit["rows_read"], audit["rows_clean"], audit["rows_inserted"], audit["rows_skipped"]) == (12, 4, 3, 1)
    assert audit["failed_two_players"] >= 1 and audit["failed_player1score"] == 3
    gold = tables.read_all(spark, f"{warehouse}/results_gold", "rows", schemas.RESULTS_GOLD)
    got = sorted(tuple(r) for r in gold.select("match_id", "player1", "player2", "player1score").collect())
    assert got == [(1, "Ann", "Bob", 3), (2, "Bob", "Ann", 5), (3, "Ann", "Bob", 5)]
    assert jobs.job_results_load(spark, landing, warehouse).first()["rows_inserted"] == 0


def upcoming_files(folder):
    return land(folder, {
        "1.csv": "Date,Player 1,Player 2,X_P1,X_P2\n2024-02-01,Ann,Bob,1.8,2.1\n2024-02-01,Cid,Dan,,\n2024-02-02,Eve,Bob,1.5,",
        "2.csv": "Player 2,Y_P2,Date,Player 1,Y_P1,Y_P1\nBob,2.2,2024-02-01,Ann,1.9,1\n,2.0,2024-02-03,Ann,1.2,1\nDan,3,,Ann,2,1",
    })


def test_upcoming_job_folds_odds_and_first_odds_stay(spark, tmp_path):
    warehouse = str(tmp_path / "wh")
    audit = jobs.job_upcoming_load(spark, upcoming_files(tmp_path / "in"), warehouse).first()
    assert (audit["rows_read"], audit["rows_clean"], audit["rows_inserted"]) == (6, 5, 4)
    gold = tables.read_all(spark, f"{warehouse}/upcoming_gold", "rows", schemas.UPCOMING)
    got = {(r["player1"], r["player2"]): r["m"] for r in gold.withColumn("m", parse_odds("odds")).collect()}
    assert got == {("Ann", "Bob"): {"X_P1": "1.8", "X_P2": "2.1"}, ("Cid", "Dan"): {}, ("Eve", "Bob"): {"X_P1": "1.5"},
                   ("Ann", ""): {"Y_P1": "1.2", "Y_P2": "2.0", "Y_P1.1": "1"}}
    strict = jobs.job_upcoming_load(spark, str(tmp_path / "in"), str(tmp_path / "wh2"), blank_is_null=True).first()
    assert strict["rows_clean"] == 4


def test_chain_of_jobs(spark, tmp_path):
    warehouse = str(tmp_path / "wh")
    jobs.job_results_load(spark, results_files(tmp_path / "r"), warehouse)
    jobs.job_rating_update(spark, warehouse)
    land(tmp_path / "u", {"u.csv": "Date,Player 1,Player 2,X_P1,X_P2\n2024-01-08,Ann,Bob,1.8,2.1\n2024-01-08,Bob,Ann,0,x"})
    jobs.job_upcoming_load(spark, str(tmp_path / "u"), warehouse)
    made = {r["player1"]: r for r in jobs.job_predict(spark, warehouse, "2024-01-07 12:00:00").collect()}
    # Both matches of the first day count, the one of the day itself does not.
    assert (made["Ann"]["player1_elo"], made["Ann"]["player1_match_count"]) == (1500 + 16 + 15, 2)
    assert made["Ann"]["best_p1_implied_prob"] == pytest.approx(1 / 1.8)
    assert made["Bob"]["best_p1_odds"] == 0 and made["Bob"]["best_p1_implied_prob"] is None
    assert made["Bob"]["value_p1"] is None and made["Bob"]["best_p2_odds"] is None
    assert jobs.job_predict(spark, warehouse, "2024-01-09").count() == 0
    assert jobs.job_backtest(spark, warehouse, "2024-01-08 00:00:00").count() == 0
    scored = jobs.job_backtest(spark, warehouse, "2024-01-08 00:00:01").collect()
    assert [(r["player1"], r["actual_winner"]) for r in scored] == [("Ann", "Bob")]
    assert scored[0]["log_loss"] == pytest.approx(-__import__("math").log(1 - made["Ann"]["predicted_p1_prob"]))
    assert jobs.job_backtest(spark, warehouse, "2024-03-01").count() == 0


def test_odds_refresh_job(spark, tmp_path):
    warehouse = str(tmp_path / "wh")
    blank = dict.fromkeys(schemas.ODDS_SCORES.names)
    both = '{"A_P1": "1.8", "A_P2": "2.1"}'
    given = [dict(blank, id=1, player1="a", player2="b", odds=both, winner="a"),
             dict(blank, id=2, player1="a", player2="b", odds=both, winner="zz", elo_prob_player1=0.3, elo_prob_player2=0.7),
             dict(blank, id=3, player1="a", player2="b", odds="not json", winner="a", brier_elo=9.0),
             dict(blank, id=4, player1="a", player2="b", odds='{"A_P1": ""}', winner="a", brier_elo=9.0)]
    df = spark.createDataFrame([tuple(g[c] for c in schemas.ODDS_SCORES.names) for g in given], schemas.ODDS_SCORES)
    tables.truncate_and_load(df, f"{warehouse}/odds_scores")
    got = {r["id"]: r for r in jobs.job_odds_refresh(spark, warehouse).collect()}
    assert got[1]["norm_prob_player1"] == pytest.approx(0.538462, abs=1e-6)
    assert got[1]["elo_prob_player1"] == 0.5 and got[1]["brier_elo"] == 0.25
    assert got[2]["elo_prob_player1"] == 0.3 and got[2]["brier_elo"] is None and got[2]["best_odd_player1"] == 1.8
    assert got[3]["brier_elo"] == 9.0 and got[3]["elo_prob_player1"] is None
    assert got[4]["brier_elo"] == 9.0 and got[4]["elo_prob_player1"] == 0.5 and got[4]["best_odd_player1"] is None


PAGE = """<div class="duelParticipant"><div class="duelParticipant__startTime"><div>1.2.2025 20:05</div></div>
<div class="duelParticipant__home duelParticipant--winner"><a class="participant__participantName x">Ann &amp; Co</a></div>
<div class="detailScore__wrapper"><span>6</span><span class="d">-</span><span>2</span></div>
<div class="duelParticipant__away"><div class="participant__participantName"><a>Bob</a></div></div></div>
<div class="section__prematchOdds">
<div class="wclOddsContent"><div class="bookmaker"><a title="X"></a></div>
<button data-testid="wcl-oddsCell"><span data-testid="wcl-oddsValue">1.8</span></button>
<button data-testid="wcl-oddsCell"><span data-testid="wcl-oddsValue">-</span></button></div>
<div class="wclOddsContent"><button data-testid="wcl-oddsCell"><span data-testid="wcl-oddsValue">9</span></button></div>
<div class="wclOddsContent"><div class="bookmaker"><a title="Y"></a></div><button data-testid="wcl-oddsCell">?</button></div>
</div>
<div class="wcl-row_OFViZ"><div>unlabelled</div></div>
<div class="wcl-row_OFViZ"><div class="wcl-homeValue_-iJBW"><strong>91.5</strong></div>
<div class="wcl-category_7qsgP"><strong>Durchschnitt (3 Darts)</strong></div><div class="wcl-awayValue_rQvxs"><strong>88</strong></div></div>"""


def page_rows(spark, *pages_):
    return spark.createDataFrame([(i, p) for i, p in enumerate(pages_)], "page_id long, html string")


def test_match_page(spark):
    got = pages.extract_match_pages(page_rows(spark, PAGE), "html").first()
    assert tuple(got) == (dt.datetime(2025, 2, 1, 20, 5), dt.date(2025, 2, 1), "20:05:00", "Ann & Co", "Bob",
                          "6", "2", "Ann & Co", "91.5", "88")


def test_match_page_with_absent_fields(spark):
    no_score = PAGE.replace("detailScore__wrapper", "x").replace("20:05", "later").replace(">Bob<", "><")
    no_block = PAGE.replace("duelParticipant__startTime", "x")
    no_average = PAGE.replace("Durchschnitt", "Schnitt")
    got = pages.extract_match_pages(page_rows(spark, no_score, no_block, no_average), "html", ["page_id"]).collect()
    assert sorted(r["page_id"] for r in got) == [0, 2]
    by = {r["page_id"]: r for r in got}
    assert by[0]["Date"] is None and by[0]["Player 1 Score"] is None and by[0]["Winner"] is None
    assert by[2]["Average Player 1"] is None and by[2]["Winner"] == "Ann & Co"


def test_odds_blocks_and_upcoming_rows(spark):
    df = pages.extract_odds_blocks(page_rows(spark, PAGE, "<p>none</p>"), "html")
    got = {r["page_id"]: r["blocks"] for r in df.collect()}
    assert [(b["bookmaker"], b["odds"]) for b in got[0]] == [("X", ["1.8", None]), ("Y", [None])] and got[1] == []
    rows = jobs.upcoming_of_pages(page_rows(spark, PAGE), "html", "2025-01-31").first()
    assert (rows["Date"], rows["Player 1"]) == ("2025-02-01", "Ann & Co")
    assert rows["odds"] == {"X_P1": "1.8", "X_P2": None, "Y_P1": None, "Y_P2": None}


def test_upcoming_pages_to_wide_csv(spark, tmp_path):
    path = str(tmp_path / "odds")
    jobs.job_upcoming_pages_to_csv(page_rows(spark, PAGE), "html", path, "2025-01-31")
    back = csv_landing.read_csv_wide(spark, f"{path}/*", schemas.UPCOMING_CSV).first()
    assert tuple(back) == ("2025-02-01", "Ann & Co", "Bob", {"X_P1": "1.8"})


def test_later_block_of_one_bookmaker_wins(spark):
    df = spark.sql("select array(named_struct('bookmaker', 'X', 'odds', array('1')), named_struct('bookmaker', null, "
                   "'odds', array('2', '3')), named_struct('bookmaker', 'X', 'odds', array('4', '5'))) as b")
    got = reshape.blocks_to_odds_map(df, "b").first()["odds"]
    assert got == {"Unknown_P1": "2", "Unknown_P2": "3", "X_P1": "4", "X_P2": "5"}


def test_match_list_and_menu(spark):
    html = ('<div class="event__match event__match__header" id="g_1_h"></div><div class="event__match"></div>'
            '<div id="g_1__abc" class="x event__match"></div><div class="event__matches" id="g_1_no"></div>')
    df = page_rows(spark, html)
    got = pages.extract_match_list(df, "html", "https://s.example").collect()
    assert [(r["match_key"], r["url"]) for r in got] == [("abc", "https://s.example/match/abc/")]
    assert pages.extract_match_list(df, "html", "https://s.example", require_id=False).count() == 2
    menu = ('<div class="lmc__block"><span class="lmc__elementName">Asia</span><a class="lmc__templateHref" href="/x">X</a></div>'
            '<div class="lmc__block"><span class="lmc__elementName"> WORLD </span><a class="lmc__templateHref" href="/w/">W</a>'
            '<a class="lmc__templateHref" href="http://o.example/c">C</a><a class="lmc__templateHref" href="">no</a></div>')
    got = pages.extract_links(page_rows(spark, menu), "html", "https://s.example").collect()
    assert [tuple(r) for r in got] == [("WORLD - W", "https://s.example/w/results/"), ("WORLD - C", "http://o.example/c/results/")]


def test_pages_to_csv_and_back(spark, tmp_path):
    path = str(tmp_path / "csv")
    jobs.job_pages_to_csv(page_rows(spark, PAGE), "html", path)
    back = csv_landing.read_csv_landing(spark, f"{path}/*", schemas.RESULTS_CSV).first()
    assert tuple(back) == ("2025-02-01", "Ann & Co", "Bob", "6", "2", "Ann & Co")
    labelled = str(tmp_path / "labelled")
    jobs.job_pages_to_csv(page_rows(spark, PAGE).withColumn("label", F.lit("World - Cup: A")), "html", labelled, "label")
    assert [p.name for p in (tmp_path / "labelled").iterdir() if p.is_dir()] == ["label=World_-_Cup_A"]


ORDERS = "match_id long, matchdate date, player1 string, player2 string, winner string, pool string"


def test_stream_equals_batch(spark, tmp_path):
    day = dt.date(2024, 1, 1)
    rows = [(i, day + dt.timedelta(days=i // 4), f"p{i % 5}", f"p{(i + 1 + i % 4) % 5}", f"p{i % 5}", "x") for i in range(40)]
    rows = [r for r in rows if r[2] != r[3]]
    landing = str(tmp_path / "in")
    args = (landing, spark.createDataFrame([], ORDERS).schema, str(tmp_path / "ck"), str(tmp_path / "ratings"), lambda b: b, "pool")
    for part in (rows[:15], rows[15:]):
        spark.createDataFrame(part, ORDERS).coalesce(1).write.mode("append").parquet(landing)
        stream_ratings(spark, *args)
    stream_ratings(spark, *args)
    jobs.update_ratings(spark, str(tmp_path / "batch"), spark.createDataFrame(rows, ORDERS), "pool")
    for i in (0, 1):
        streamed, batch = (jobs.read_ratings(spark, str(tmp_path / d))[i] for d in ("ratings", "batch"))
        assert sorted(map(tuple, streamed.collect()), key=str) == sorted(map(tuple, batch.collect()), key=str)
    assert len(tables.versions(spark, str(tmp_path / "ratings"))) == 2


def test_streams_go_on_from_a_batch_run_and_from_each_other(spark, tmp_path):
    day = dt.date(2024, 1, 1)
    rows = [(i, day + dt.timedelta(days=i), f"p{i % 3}", f"p{(i + 1) % 3}", f"p{i % 3}", None) for i in range(9)]
    root = str(tmp_path / "ratings")
    jobs.update_ratings(spark, root, spark.createDataFrame(rows[:3], ORDERS), "pool")
    for n in (1, 2):
        landing = str(tmp_path / f"in{n}")
        spark.createDataFrame(rows[3 * n:3 * n + 3], ORDERS).coalesce(1).write.parquet(landing)
        stream_ratings(spark, landing, spark.createDataFrame([], ORDERS).schema, str(tmp_path / f"ck{n}"), root, lambda b: b, "pool")
    jobs.update_ratings(spark, str(tmp_path / "batch"), spark.createDataFrame(rows, ORDERS), "pool")
    for i in (0, 1):
        streamed, batch = (jobs.read_ratings(spark, str(tmp_path / d))[i] for d in ("ratings", "batch"))
        assert sorted(map(tuple, streamed.collect()), key=str) == sorted(map(tuple, batch.collect()), key=str)


def test_stream_picks_up_new_files_only(spark, tmp_path):
    seen = []
    folder = land(tmp_path / "in", {"a.csv": "1,x\n2,y\n"})
    schema = spark.createDataFrame([], "n int, v string").schema

    def run():
        stream_landing(spark, folder, schema, str(tmp_path / "ck"), lambda b, i: seen.append(sorted(r["n"] for r in b.collect())),
                       format="csv", glob="*.csv", max_files=1)

    run()
    land(tmp_path / "in", {"b.csv": "3,z\n"})
    run()
    run()
    assert seen == [[1, 2], [3]]


def test_sinks_write_labels(spark, tmp_path):
    df = spark.createDataFrame([("a", "l1")], "x string, slug string")
    sinks.write_labelled_csv(df, str(tmp_path / "o"), "slug")
    assert (tmp_path / "o" / "label=l1").is_dir()


def test_folder_without_rows_gives_an_empty_table(spark, tmp_path):
    folder = land(tmp_path / "in", {"d.csv": "", "e.csv": HEADER + "\n"})
    assert csv_landing.read_csv_landing(spark, folder, schemas.RESULTS_CSV).isEmpty()
    nothing = land(tmp_path / "none", {})
    assert csv_landing.read_csv_wide(spark, nothing, schemas.UPCOMING_CSV).isEmpty()
