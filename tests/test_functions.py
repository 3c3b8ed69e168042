"""Column functions on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duelmetrics.functions import convert, odds, scoring, text


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expr).collect()]


def test_safe_int_takes_whole_part_and_never_raises(spark):
    got = one(spark, ["3", "3.0", "3.7", " 4 ", "abc", "", None, "1.5d", "NaN", "0x1p3"], convert.safe_int("x"))
    assert got == [3, 3, 3, 4, None, None, None, None, None, None]


def test_missing_tokens_become_null_and_text_is_trimmed(spark):
    got = one(spark, ["NA", "null", " Bo ", "", "N/A", "None", "na"], convert.safe_str(convert.missing_to_null("x")))
    assert got == [None, None, "Bo", None, None, None, "na"]


def test_blank_str_turns_missing_into_empty(spark):
    assert one(spark, [None, " a "], convert.blank_str("x")) == ["", "a"]


def test_dates_and_start_times(spark):
    assert one(spark, ["2025-02-01", "soon", None], convert.safe_date("x")) == [dt.date(2025, 2, 1), None, None]
    got = one(spark, ["01.02.2025 09:05", "1.2.2025 9:05", "2025-02-01 09:05", None], convert.parse_start_time("x"))
    assert got == [dt.datetime(2025, 2, 1, 9, 5)] * 2 + [None, None]
    assert one(spark, ["1.2.2025 9:05"], convert.clock_of(convert.parse_start_time("x"))) == ["09:05:00"]


def test_number_or_zero_and_names(spark):
    assert one(spark, ["1.5", None, "x", ""], convert.number_or_zero("x")) == [1.5, 0.0, 0.0, 0.0]
    df = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b"), ("", "")], "p string, q string")
    assert [r[0] for r in df.select(convert.first_non_empty("p", "q")).collect()] == ["b", "b", "a", None]


def test_relative_day_and_epoch(spark):
    assert one(spark, [0], convert.iso_day(convert.relative_day("2025-03-01", -1)), "long") == ["2025-02-28"]
    assert one(spark, [86400], F.date_format(convert.from_epoch("x"), "yyyy-MM-dd HH:mm"), "long") == ["1970-01-02 00:00"]


ODDS = ['{"A_P1": 1.85, "A_P2": 1.95, "B_P1": "1.9"}', "{}", "null", '{"A_P1": ""}', '{"A_P1": "x"}',
        '{"A_P1": 0}', '{"A_P1": "NaN"}', "[1]", "not json", None]


def test_best_odds_skip_unreadable_values(spark):
    m = odds.parse_odds("x")
    assert one(spark, ODDS, odds.best_odds(m, "_P1")) == [1.9, None, None, None, None, 0.0, None, None, None, None]
    assert one(spark, ODDS[:2], odds.best_odds(m, "_P2")) == [1.95, None]
    assert one(spark, ODDS[-2:], odds.odds_to_json(m)) == ["{}", "{}"]


def test_implied_edge_and_margin(spark):
    assert one(spark, [1.8, 0.0, None], F.round(odds.implied("x"), 6), "double") == [0.555556, None, None]
    got = one(spark, [1.8, 0.0], F.round(odds.edge(F.lit(0.6), odds.implied("x")), 6), "double")
    assert got == [0.044444, None]
    df = spark.createDataFrame([(1 / 1.8, 1 / 2.1), (0.5, None), (0.5, 0.0)], "a double, b double")
    rows = odds.devig(df, "a", "b").collect()
    assert [round(v, 6) for v in rows[0][2:]] == [0.031746, 0.538462, 0.461538]
    assert list(rows[1][2:]) == [None] * 3 and list(rows[2][2:]) == [None] * 3


def test_expected_score_overflow_is_zero(spark):
    df = spark.createDataFrame([(1500, 1500), (1600, 1400), (0, 1000000)], "a int, b int")
    got = [r[0] for r in df.select(scoring.expected_score("a", "b")).collect()]
    assert got[0] == 0.5 and got[1] == pytest.approx(0.759747, abs=1e-6) and got[2] == 0.0


def test_scores(spark):
    df = spark.createDataFrame([(0.6, 1), (0.0, 1), (None, 1), (1.0, 1)], "p double, y int")
    loss = [r[0] for r in df.select(scoring.log_loss_clipped("p", "y")).collect()]
    assert loss[0] == pytest.approx(0.510826, abs=1e-6) and loss[1] == pytest.approx(34.538776, abs=1e-6)
    assert loss[2] is None and loss[3] == pytest.approx(0, abs=1e-12)
    assert df.select(scoring.brier("p", "y")).first()[0] == pytest.approx(0.16)


def test_winner_log_loss_is_unclipped(spark):
    df = spark.createDataFrame([("a", 0.6), ("b", 0.6), ("x", 0.6), ("a", 0.0), ("a", None)], "w string, p double")
    got = [r[0] for r in df.select(scoring.log_loss_winner("w", F.lit("a"), F.lit("b"), "p", 1 - F.col("p"))).collect()]
    assert got[0] == pytest.approx(0.510826, abs=1e-6) and got[1] == pytest.approx(0.916291, abs=1e-6)
    assert got[2:] == [None, None, None]


def test_symbols_compare_the_blacklist_before_the_dollar_goes(spark):
    raw = ["$YOLO YOLO GME ABCDEFGH $TSLA a DD", "lower", ""]
    assert one(spark, raw, text.extract_symbols("x")) == [["YOLO", "GME", "ABCDE", "FGH", "TSLA"], [], []]
    assert one(spark, raw[:1], text.extract_symbols("x", strip_first=True)) == [["GME", "ABCDE", "FGH", "TSLA"]]


def test_slugs_ids_and_dashes(spark):
    assert one(spark, ["World - Cup (2024): A"], text.slug("x")) == ["World_-_Cup_2024_A"]
    assert one(spark, ["g_1__k9", "g_1_"], text.clean_element_id("x")) == ["k9", ""]
    assert one(spark, ["-", " 1.5 "], text.dash_to_null("x")) == [None, "1.5"]
