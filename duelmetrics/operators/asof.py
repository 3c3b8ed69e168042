"""Point-in-time lookup and count: facts of a key strictly before a day.

Facts are first folded to one row per (key, day), with map-side combine, so that a key
with a third of all facts still reaches the window as at most one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .reshape import sides


def asof_states(requests: DataFrame, facts: DataFrame, key: str, day: str,
                order: str, value: str, last: str = "last", count: str = "n") -> DataFrame:
    """For each distinct (key, day) of ``requests``: the last earlier ``value`` and how many.

    ``facts`` holds (key, day, order, value); within a day the highest ``order`` counts, and
    a fact without a value counts but is never the last.
    """
    by_day = facts.groupBy(key, day).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("v"), F.count(F.lit(1)).alias("n"))
    asked = requests.select(key, day).distinct()
    number = F.unix_date(day).alias("_number")
    marks = by_day.select(key, day, number, "v", "n", F.lit(False).alias("asked")).unionByName(
        asked.select(key, day, number, F.lit(None).cast(by_day.schema["v"].dataType).alias("v"),
                     F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("asked")))
    # RANGE, not ROWS: facts of the same day are outside the frame.
    before = Window.partitionBy(key).orderBy("_number").rangeBetween(Window.unboundedPreceding, -1)
    looked_up = marks.select(key, day, "asked", F.last("v", ignorenulls=True).over(before).alias(last),
                             F.coalesce(F.sum("n").over(before), F.lit(0)).alias(count))
    return looked_up.where("asked").drop("asked")


def rating_facts(log: DataFrame, side: str = "own") -> DataFrame:
    """The rating log as (player, day, match_id, elo), one row per side.

    ``own`` takes the rating of the player itself; ``first`` always takes that of side 1.
    """
    if side not in ("own", "first"):
        raise ValueError("side must be 'own' or 'first'")
    second = "player2_elo_after" if side == "own" else "player1_elo_after"
    dated = log.withColumn("day", F.col("match_date").cast("date"))
    return sides(dated, {"player": ("player1", "player2"), "elo": ("player1_elo_after", second)},
                 keep=["day", "match_id"])


def attach_states(requests: DataFrame, states: DataFrame, key: str, day: str | Column,
                  names: dict[str, str]) -> DataFrame:
    """Left-join ``states`` (player, day, ...) to ``requests`` for the player in column ``key``."""
    day = F.col(day) if isinstance(day, str) else day
    right = states.select(F.col("player").alias("_player"), F.col("day").alias("_day"),
                          *[F.col(s).alias(n) for s, n in names.items()])
    hit = (requests[key] == right["_player"]) & (day == right["_day"])
    return requests.join(right, hit, "left").drop("_player", "_day")


def asof_both_sides(requests: DataFrame, log: DataFrame, date: str = "matchdate",
                    side: str = "own", p1: str = "player1", p2: str = "player2") -> DataFrame:
    """Add ``player{1,2}_elo`` and ``player{1,2}_match_count`` as of each request's day."""
    asked = sides(requests, {"player": (p1, p2)}, keep=[F.col(date).cast("date").alias("day")])
    states = asof_states(asked, rating_facts(log, side), "player", "day", "match_id", "elo",
                         last="elo", count="n")
    out = requests.withColumn("_on", F.col(date).cast("date"))
    for key, name in ((p1, "player1"), (p2, "player2")):
        out = attach_states(out, states, key, F.col("_on"),
                            {"elo": f"{name}_elo", "n": f"{name}_match_count"})
    return out.drop("_on").fillna(0, ["player1_match_count", "player2_match_count"])


def asof_last(requests: DataFrame, log: DataFrame, date: str = "matchdate", side: str = "own",
              p1: str = "player1", p2: str = "player2") -> DataFrame:
    both = asof_both_sides(requests, log, date, side, p1, p2)
    return both.drop("player1_match_count", "player2_match_count")


def asof_count(requests: DataFrame, log: DataFrame, date: str = "matchdate",
               p1: str = "player1", p2: str = "player2") -> DataFrame:
    return asof_both_sides(requests, log, date, "own", p1, p2).drop("player1_elo", "player2_elo")
