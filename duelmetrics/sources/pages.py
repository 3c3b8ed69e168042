"""Rows out of stored match, list and menu pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.convert import clock_of, parse_start_time
from ..functions.html import (attr, class_attr, first_text, has_class, has_class_in_tag, plain,
                              section, sections)
from ..functions.text import clean_element_id, dash_to_null

# Class names and labels of the pages.
START, HOME, AWAY, WINNER = (
    "duelParticipant__startTime", "duelParticipant__home", "duelParticipant__away",
    "duelParticipant--winner")
NAME, SCORE = "participant__participantName", "detailScore__wrapper"
STAT_ROW, STAT_LABEL, STAT_HOME, STAT_AWAY = (
    "wcl-row_OFViZ", "wcl-category_7qsgP", "wcl-homeValue_-iJBW", "wcl-awayValue_rQvxs")
AVERAGE_LABEL = "Durchschnitt (3 Darts)"
ODDS_SECTION, ODDS_BLOCK, BOOKMAKER = "section__prematchOdds", "wclOddsContent", "bookmaker"
ODDS_CELL, ODDS_VALUE = 'data-testid="wcl-oddsCell"', 'data-testid="wcl-oddsValue"'
MATCH, MATCH_HEADER = "event__match", "event__match__header"
MENU_BLOCK, MENU_NAME, MENU_LINK = "lmc__block", "lmc__elementName", "lmc__templateHref"


def _markup_in(scope: Column, token: str, inner: str = "") -> Column:
    """Markup of the first element of class ``token``, or of ``inner`` right inside it."""
    return F.regexp_extract(scope, rf"(?s){class_attr(token)}[^<>]*>({inner}.*?)(?=</)", 1)


def _text_in(scope: Column, token: str, inner: str = "") -> Column:
    return plain(F.nullif(_markup_in(scope, token, inner), F.lit("")))


def extract_match_pages(df: DataFrame, html_col: str, keep: list[str] = ()) -> DataFrame:
    """Start, players, scores, winner and averages of each match page.

    Pages without a start time block are no match pages. A field that is absent is null
    and the row stays; both names, the result fields and both averages are null together.
    """
    html = F.col(html_col)
    start = first_text(section(html, START, until=(HOME, AWAY)), r"<div(?:\s[^>]*)?>")
    home = _text_in(section(html, HOME, until=(AWAY, SCORE)), NAME)
    away = _text_in(section(html, AWAY, until=(HOME, SCORE, STAT_ROW, ODDS_SECTION)), NAME)
    spans = F.regexp_extract_all(section(html, SCORE, until=(AWAY, HOME, STAT_ROW, ODDS_SECTION)),
                                 F.lit(r"(?s)<span(?:\s[^>]*)?>(.*?)</span>"), F.lit(1))
    winner = _text_in(section(html, WINNER, until=(HOME, AWAY, SCORE, STAT_ROW)), NAME)
    # The first row with the label decides, also when its values are missing.
    strong = r"\s*<strong(?:\s[^>]*)?>"
    average = F.get(F.filter(sections(html, STAT_ROW), lambda r: F.contains(
        plain(_markup_in(r, STAT_LABEL, strong)), F.lit(AVERAGE_LABEL))), F.lit(0))

    # Columns of their own: what two fields are read from is looked for once.
    found = df.where(has_class(html, START)).withColumns({"_average": average, "_spans": spans}).select(
        *keep, parse_start_time(start).alias("start"), home.alias("home"), away.alias("away"),
        plain(F.get("_spans", F.lit(0))).alias("s1"), plain(F.get("_spans", F.lit(2))).alias("s2"),
        winner.alias("w"), _text_in(F.col("_average"), STAT_HOME, strong).alias("a1"),
        _text_in(F.col("_average"), STAT_AWAY, strong).alias("a2"))

    def together(name: str, *needed: str) -> Column:
        whole = F.lit(True)
        for n in needed:
            whole = whole & F.col(n).isNotNull()
        return F.when(whole, F.col(name))

    return found.select(
        *keep,
        F.col("start").alias("MatchDateTime"),
        F.to_date("start").alias("Date"),
        clock_of("start").alias("Time"),
        together("home", "home", "away").alias("Player 1"),
        together("away", "home", "away").alias("Player 2"),
        together("s1", "s1", "s2", "w").alias("Player 1 Score"),
        together("s2", "s1", "s2", "w").alias("Player 2 Score"),
        together("w", "s1", "s2", "w").alias("Winner"),
        together("a1", "a1", "a2").alias("Average Player 1"),
        together("a2", "a1", "a2").alias("Average Player 2"))


def extract_odds_blocks(df: DataFrame, html_col: str, out: str = "blocks") -> DataFrame:
    """Add ``array<struct<bookmaker, odds array>>``, one entry per readable odds block.

    A price shown as a dash, or a cell without a readable price, is null; a block without
    a bookmaker link is skipped.
    """
    blocks = sections(section(F.col(html_col), ODDS_SECTION), ODDS_BLOCK)
    link = rf'(?s){class_attr(BOOKMAKER)}[^<>]*>.*?(<a(?:\s[^<>]*)?>)'

    cell = rf"(?s)<button[^<>]*{ODDS_CELL}[^<>]*>(.*?)</button>"
    price = rf"(?s)<span[^<>]*{ODDS_VALUE}[^<>]*>(.*?)</"

    raw = F.transform(blocks, lambda x: F.struct(
        F.regexp_extract(x, link, 1).alias("tag"),
        F.transform(F.regexp_extract_all(x, F.lit(cell), F.lit(1)),
                    lambda c: plain(F.regexp_extract(c, price, 1))).alias("texts")))
    found = F.transform(F.filter(raw, lambda x: x["tag"] != ""), lambda x: F.struct(
        plain(F.regexp_extract(x["tag"], r'\stitle="([^"]*)"', 1)).alias("bookmaker"),
        F.transform(x["texts"], lambda t: F.nullif(dash_to_null(t), F.lit(""))).alias("odds")))
    empty = F.array().cast("array<struct<bookmaker:string,odds:array<string>>>")
    return df.withColumn(out, F.coalesce(found, empty))


def extract_match_list(df: DataFrame, html_col: str, base_url: str, keep: list[str] = (),
                       path: str = "/match/%s/", require_id: bool = True) -> DataFrame:
    """One row per match element of a list page: its id, the cleaned id and the detail URL.

    Header elements are dropped, and so are elements without id unless ``require_id`` is off.
    """
    tags = F.regexp_extract_all(F.col(html_col), F.lit(rf"<[^<>]*{class_attr(MATCH)}[^<>]*>"), F.lit(0))
    rows = df.select(*keep, F.explode(tags).alias("tag")) \
        .where(~has_class_in_tag(F.col("tag"), MATCH_HEADER)) \
        .select(*keep, attr(F.col("tag"), "id").alias("element_id"))
    if require_id:
        rows = rows.where(F.col("element_id").isNotNull())
    clean = clean_element_id(F.coalesce("element_id", F.lit("")))
    return rows.select(*keep, "element_id", clean.alias("match_key"),
                       F.concat(F.lit(base_url), F.replace(F.lit(path), F.lit("%s"), clean)).alias("url"))


def page_links(html: Column, link_class: str | None = None) -> Column:
    """``array<struct<name, href>>`` of the anchors (of one class) that have both."""
    tag = rf"<a\s[^<>]*{class_attr(link_class)}[^<>]*>" if link_class else r"<a\s[^<>]*>"
    anchors = F.regexp_extract_all(html, F.lit(rf"(?s){tag}.*?</a>"), F.lit(0))
    read = F.transform(anchors, lambda a: F.struct(
        F.nullif(plain(a), F.lit("")).alias("name"),
        F.replace(attr(F.regexp_extract(a, r"^<[^<>]*>", 0), "href"), F.lit("&amp;"), F.lit("&")).alias("href")))
    return F.filter(read, lambda a: a["name"].isNotNull() & a["href"].isNotNull())


def absolute_url(base_url: Column | str, href: Column, suffix: str = "") -> Column:
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    full = F.when(href.startswith("http"), href).otherwise(F.concat(base, href))
    return F.concat(F.rtrim(full, F.lit("/")), F.lit(suffix))


def extract_links(df: DataFrame, html_col: str, base_url: Column | str, region: str | None = "world",
                  keep: list[str] = (), link_class: str | None = MENU_LINK,
                  suffix: str = "/results/") -> DataFrame:
    """(label, url) of the links of one region of a menu page.

    The region is the first whose trimmed, lower-cased name equals ``region``; ``None``
    takes the links of the whole page.
    """
    html = F.col(html_col)
    if region is None:
        scope = df.select(*keep, F.lit(None).cast("string").alias("region"), html.alias("_scope"))
    else:
        blocks = F.transform(sections(html, MENU_BLOCK), lambda b: F.struct(
            _text_in(b, MENU_NAME).alias("name"), b.alias("text")))
        block = F.get(F.filter(blocks, lambda b: F.lower(b["name"]) == region.lower()), F.lit(0))
        scope = df.select(*keep, block.alias("_block")).select(
            *keep, F.col("_block.name").alias("region"), F.col("_block.text").alias("_scope"))
    links = scope.select(*keep, "region", F.explode(page_links(F.col("_scope"), link_class)).alias("_link"))
    label = F.col("_link.name") if region is None else F.concat("region", F.lit(" - "), F.col("_link.name"))
    return links.select(*keep, label.alias("label"),
                        absolute_url(base_url, F.col("_link.href"), suffix).alias("url"))
