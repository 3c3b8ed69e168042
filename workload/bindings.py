"""Matches, odds, posts, listings and pages built from the test tables.

The test data has no contests, so orders stand in: an order is a match between two
customers of one small pool, and its line items are the bookmakers' prices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches_of(table(spark, sf_dir, "orders"))


def matches_of(orders: DataFrame) -> DataFrame:
    """match_id, matchdate, pool, player1, player2, scores, winner; one row per order."""
    return orders.select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_orderdate").cast("date").alias("matchdate"),
        F.expr("o_custkey div 5").alias("pool"),
        F.expr("concat('c', o_custkey)").alias("player1"),
        F.expr("concat('c', (o_custkey div 5) * 5 + (o_custkey + 1 + o_orderkey % 4) % 5)").alias("player2"),
        (F.col("o_totalprice") > 250000).alias("first_won"),
    ).select(
        "match_id", "matchdate", "pool", "player1", "player2",
        F.expr("if(first_won, 6, cast(match_id % 6 as int))").alias("player1score"),
        F.expr("if(first_won, cast(match_id % 6 as int), 6)").alias("player2score"),
        F.expr("if(first_won, player1, player2)").alias("winner"))


def open_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders as matches of one pool of 1,000 players."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("match_id"), F.col("o_orderdate").cast("date").alias("matchdate"),
        F.expr("cast(o_custkey % 1000 as string)").alias("player1"),
        F.expr("cast((o_custkey % 1000 + 1 + o_orderkey % 999) % 1000 as string)").alias("player2"),
        (F.col("o_totalprice") > 250000).alias("first_won"),
    ).selectExpr("match_id", "matchdate", "player1", "player2", "if(first_won, player1, player2) as winner")


def crowded_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as matches of one pool of very many players: four to each customer."""
    o = table(spark, sf_dir, "orders")
    first = F.expr("o_custkey * 4 + o_orderkey % 4")
    return o.select(
        F.col("o_orderkey").alias("match_id"), F.col("o_orderdate").cast("date").alias("matchdate"), F.lit(0).alias("pool"),
        first.cast("string").alias("player1"), (first + 1 + F.expr("o_orderkey * 31 % 997")).cast("string").alias("player2"),
        (F.col("o_totalprice") > 250000).alias("first_won"),
    ).selectExpr("match_id", "matchdate", "pool", "player1", "player2", "if(first_won, player1, player2) as winner")


def uneven_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The open matches, split into pools of which the first holds a third of all."""
    m = open_matches(spark, sf_dir)
    return m.withColumn("pool", F.expr("if(match_id % 3 = 0, 0, match_id % 40)"))


def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quantity and price per (order, line number).

    Dealt by order, so that joins and groups by order need no further shuffle.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return li.repartition("l_orderkey").groupBy(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line")).agg(
        F.max("l_quantity").alias("q"), F.max("l_extendedprice").alias("e"))


#: The texts of a line's two prices; some are unreadable.
P1 = "case when line = 2 then '' when line = 3 then 'n/a' else cast(1 + q / 10 as string) end as p1"
P2 = "case when line = 5 then 'NaN' else cast(1 + e / 20000 as string) end as p2"


def quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price pair per (order, line number); some prices are unreadable."""
    return priced_lines(spark, sf_dir).selectExpr("id", "line", "concat('bm', line) as bookmaker", P1, P2)


def odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, odds) with the odds of an order as a JSON object, numbers bare or quoted."""
    lines = quoted_lines(spark, sf_dir).withColumn("entry", F.expr(
        "concat('\"', bookmaker, '_P1\": \"', p1, '\", \"', bookmaker, '_P2\": ', "
        "if(p2 = 'NaN', '\"NaN\"', p2))"))
    return lines.groupBy("id").agg(
        F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_set("entry")), ", "), F.lit("}")).alias("odds"))


def nested_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, odds): an order's prices as JSON of every shape, by line number; some texts hold no object."""
    lines = quoted_lines(spark, sf_dir).drop("p1", "p2").join(
        table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line")).agg(
            (1 + F.max("l_quantity") / 10).cast("string").alias("p1"), (1 + F.max("l_extendedprice") / 20000).cast("string").alias("p2")),
        ["id", "line"])
    shapes = {1: '"bm1_P1": "{1}", "bm1_P2": {2}', 2: '"bm2": {"P1": {1}, "P2": "{2}", "limit": {"P1": 900}, "open": true}',
              3: '"bm3": [{1}, "{2}", 7, null]', 4: '"bm4_P1": " {1} ", "bm4_P2": "n/a"', 5: '"bm5_P1": null, "bm5_P2": true',
              6: '"bm6_P1": "NaN", "bm6_P2": "Infinity"', 7: '"bm7_P1": {}, "bm7_P2": []'}
    shape = F.element_at(F.create_map(*(x for n, s in shapes.items() for x in (F.lit(n), F.lit(s)))), F.col("line").cast("int"))
    entry = F.replace(F.replace(shape, F.lit("{1}"), F.col("p1")), F.lit("{2}"), F.col("p2"))
    whole = lines.groupBy("id").agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(entry)), ", "), F.lit("}")).alias("odds"))
    return whole.withColumn("odds", F.expr("case when id % 17 = 0 then 'not json' when id % 19 = 0 then concat('[', odds, ']') "
                                           "when id % 23 = 0 then concat(substr(odds, 1, length(odds) - 1), ', \"x\": 1, \"x\": 2}') else odds end"))


def upcoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match as it stood before it was played: id, matchdate, players, odds."""
    m = matches(spark, sf_dir).withColumnRenamed("match_id", "id")
    return m.join(odds(spark, sf_dir), "id", "left").select("id", "matchdate", "player1", "player2", "odds")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.selectExpr(
        "doc_id as id", "cast(1700000000 + doc_id * 3600 as double) as created_utc", "source as title",
        "text as selftext", "cast(n_chars % 1000 as int) as score", "cast(n_chars % 97 as int) as num_comments")


def match_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detail page per match; some lack a time, a result or the averages.

    The narrow orders are spread over all cores first, as stored pages would be.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    m = matches_of(orders.repartition(spark.sparkContext.defaultParallelism))
    return m.select("match_id", F.concat(
        F.lit('<html><body><div class="duelParticipant"><div class="duelParticipant__startTime"><div>'),
        F.expr("if(match_id % 9 = 0, 'soon', concat(date_format(matchdate, 'd.M.yyyy'), ' ', match_id % 24, ':05'))"),
        F.lit('</div></div><div class="duelParticipant__home'),
        F.expr("if(winner = player1 and match_id % 7 <> 0, ' duelParticipant--winner', '')"),
        F.lit('"><div class="participant__participantName"><a href="/p">'),
        F.expr("concat('Tom &amp; ', player1)"),
        F.lit('</a></div></div><div class="detailScore__wrapper">'),
        F.expr("concat('<span>', player1score, '</span><span>-</span><span>', player2score, '</span>')"),
        F.lit('</div><div class="duelParticipant__away'),
        F.expr("if(winner = player2 and match_id % 7 <> 0, ' duelParticipant--winner', '')"),
        F.lit('"><div class="participant__participantName">'), F.col("player2"),
        F.lit('</div></div></div><div class="wcl-row_OFViZ"><div class="wcl-homeValue_-iJBW"><strong>1</strong></div>'
              '<div class="wcl-category_7qsgP"><strong>180s</strong></div>'
              '<div class="wcl-awayValue_rQvxs"><strong>2</strong></div></div>'),
        F.when(F.expr("match_id % 5 <> 0"), F.concat(
            F.lit('<div class="wcl-row_OFViZ"><div class="wcl-homeValue_-iJBW"><strong>'),
            F.expr("concat(match_id % 100, '.5')"),
            F.lit('</strong></div><div class="wcl-category_7qsgP"><strong>Durchschnitt (3 Darts)</strong></div>'
                  '<div class="wcl-awayValue_rQvxs"><strong>'),
            F.expr("concat(match_id % 90, '.25')"), F.lit("</strong></div></div>"))).otherwise(F.lit("")),
        F.lit("</body></html>")).alias("html"))


def odds_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per order with one odds block per line number."""
    lines = quoted_lines(spark, sf_dir)
    cell = ('<button data-testid="wcl-oddsCell" class="x"><span data-testid="wcl-oddsValue">', "</span></button>")
    block = F.concat(
        F.lit('<div class="wclOddsContent">'),
        F.when(F.expr("line <> 7"), F.expr(
            "concat('<div class=\"bookmaker\"><a href=\"#\" title=\"', bookmaker, '\">go</a></div>')")).otherwise(F.lit("")),
        F.lit(cell[0]), F.expr("if(line = 3, '-', p1)"), F.lit(cell[1]),
        F.when(F.expr("line <> 4"), F.concat(F.lit(cell[0]), F.col("p2"), F.lit(cell[1]))).otherwise(F.lit("")),
        F.lit("</div>"))
    return lines.withColumn("block", block).groupBy("id").agg(
        F.concat(F.lit('<div class="section__prematchOdds">'),
                 F.array_join(F.array_sort(F.collect_set("block")), ""), F.lit("</div>")).alias("html"))


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list element per order: a header, an element without id, or a match."""
    o = table(spark, sf_dir, "orders")
    return o.selectExpr("o_orderkey", """
        case when o_orderkey % 10 = 0 then '<div class="event__match event__match__header" id="g_1_head">x</div>'
             when o_orderkey % 10 = 1 then '<div class="event__match">x</div>'
             else concat('<div id="g_1__k', o_orderkey, '" class="event__match event__match--static">x</div>') end
        as html""")


def menu_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A menu page per customer with an opened and a closed region."""
    c = table(spark, sf_dir, "customer")
    return c.selectExpr("c_custkey", """
        concat('<div class="lmc__block"><span class="lmc__elementName">Europe</span>',
               '<a class="lmc__templateHref" href="/eu">Euro</a></div>',
               '<div class="lmc__block lmc__blockOpened"><span class="lmc__elementName"> World </span>',
               '<a class="lmc__templateHref" href="/w/', c_custkey, '/">', c_name, '</a>',
               '<a class="lmc__templateHref" href="https://other.example/', c_custkey, '"> Cup (', c_nationkey, '): A </a>',
               '<a class="lmc__templateHref" href="/none"></a></div>') as html""")


def paged_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON pages of five items; every supplier is a market with a listing of its own.

    Every ninth page came back without data.
    """
    li = table(spark, sf_dir, "lineitem")
    items = li.groupBy("l_suppkey", "l_partkey").agg(
        F.max("l_extendedprice").alias("price"), F.sum("l_quantity").alias("volume"))
    # A run lists 600 parts, five on a page, and reports more pages than are read.
    items = items.selectExpr("*", "l_partkey div 600 as run", "cast(l_partkey % 120 + 1 as int) as page_num")
    item = F.struct(
        F.expr("if(l_partkey % 6 = 0, '', concat('part ', l_partkey))").alias("market_hash_name"),
        F.expr("case when l_partkey % 12 = 0 then null when l_partkey % 6 = 0 then concat('alt ', l_partkey) "
               "else 'unused' end").alias("name"),
        F.expr("if(l_partkey % 7 = 0, null, cast(price as string))").alias("sell_min_price"),
        F.expr("cast(cast(volume as bigint) as string)").alias("sell_num"))
    pages = items.groupBy("l_suppkey", "run", "page_num").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return pages.select(
        F.col("l_suppkey").alias("market"),
        F.when(F.expr("page_num % 9 <> 0"),
               F.struct("page_num", F.lit(120).alias("total_page"), "items")).alias("data"),
        F.when(F.expr("page_num % 9 = 0"), F.lit("try again")).alias("msg"))
