"""Stored pages: each part is looked for once, and large pages are never broadcast."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duelmetrics.functions.html import class_attr, section, sections
from duelmetrics.sources import pages
from workload import queries


@pytest.fixture
def small_tables(spark, tmp_path):
    day = dt.datetime(1995, 1, 2)
    spark.createDataFrame([(i, i, day, 1000.0 * i) for i in range(1, 9)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, n, 5.0, 100.0 * n) for i in range(1, 9) for n in range(1, 8)],
                          "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_pages_are_not_broadcast(spark, small_tables, monkeypatch):
    class Seen(Exception):
        pass

    def seen(paged, *_):
        assert paged.count() == 8
        raise Seen(plan(paged, "executedPlan"))

    monkeypatch.setattr(queries.jobs, "job_upcoming_pages_to_csv", seen)
    with pytest.raises(Seen) as found:
        queries.upcoming_pages_to_csv(spark, small_tables)
    assert "SortMergeJoin" in str(found.value) and "Broadcast" not in str(found.value)


def test_blocks_of_a_page_are_read_once(spark, small_tables):
    df = queries.odds_blocks(spark, small_tables)
    # The sections of a page, and inside them the cells of a block.
    assert plan(df).count("regexp_extract_all(") == 2
    assert df.count() == 8 * 6


def test_scores_of_a_page_are_looked_for_once(spark):
    df = spark.createDataFrame([("x",)], "html string")
    found = plan(pages.extract_match_pages(df, "html"))
    assert found.count(f"(?:{pages.SCORE})(?:\\s[^\"]*)?\"[^<>]*>") == 1


@pytest.mark.parametrize("until", [(), ("b",), ("b", "c-d")])
def test_sections_equal_the_lazy_patterns(spark, until):
    texts = ['<p class="a">one', '<p class="a">c class= cl\nclass="x"<p class="b">two', '<p class="a x">éc<i class="c-d">c</i><p class="a">',
             '<p class="a"></p>class="bb"<p class="z b">x<p class="a">ccc', '', 'class="ab">', '<p class="a"', None, '<p class="a"><p class="b">']
    df = spark.createDataFrame([(t,) for t in texts], "html string")
    rest = rf"(.*?)(?={class_attr(*until)}|\z)" if until else r"(.*)\z"
    old = F.nullif(F.regexp_extract("html", rf"(?s){class_attr('a')}[^<>]*>{rest}", 1), F.lit(""))
    all_old = F.regexp_extract_all("html", F.lit(rf"(?s){class_attr('a')}[^<>]*>.*?(?={class_attr('a')}|\z)"), F.lit(0))
    for row in df.select(section("html", "a", until), old, sections("html", "a"), all_old).collect():
        assert row[0] == row[1] and row[2] == row[3]
    assert "*?" not in section("html", "a", ("b",))._jc.toString() + sections("html", "a")._jc.toString()


def test_a_section_of_megabytes(spark):
    df = spark.range(1).select(F.concat(F.lit('<p class="a">'), F.repeat(F.lit('c<p class="x">text</p>'), 200_000)).alias("html"))
    assert df.select(F.length(section("html", "a", ("b",))), F.length(sections("html", "a")[0])).first() == (4_400_000, 4_400_010)


@pytest.mark.parametrize("name", ["csv_wide", "upcoming_job"])
def test_odds_of_a_row_are_parsed_once(spark, small_tables, name):
    df = getattr(queries, name)(spark, small_tables)
    assert plan(df).count("from_json(") == 1
    assert df.count() == {"csv_wide": 56, "upcoming_job": 8}[name]
