"""Bookmaker odds: parsing, best price, implied probability, edge, margin removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .convert import col, number


def parse_odds(c: Column | str) -> Column:
    """JSON object text to ``map<string,string>``; anything but an object gives null.

    Values stay strings: asking for doubles would turn the whole map null as soon as one
    number is quoted.
    """
    text = col(c)
    is_object = F.trim(text).startswith("{")
    return F.when(is_object, F.from_json(text, "map<string,string>"))


def odds_to_json(c: Column | str) -> Column:
    """The stored form of an odds map; a missing map is the empty object."""
    return F.coalesce(F.to_json(col(c)), F.lit("{}"))


def best_odds(odds: Column | str, suffix: str) -> Column:
    """Largest readable value among the keys that contain ``suffix``; null if there is none."""
    side = F.map_values(F.map_filter(col(odds), lambda k, v: F.contains(k, F.lit(suffix))))
    return F.array_max(F.transform(side, number))


def implied(odds: Column | str) -> Column:
    """1 / odds, null for missing and for zero odds."""
    o = col(odds)
    return F.when(o != 0, F.lit(1.0) / o)


def edge(probability: Column | str, implied_probability: Column | str) -> Column:
    return col(probability) - F.nullif(col(implied_probability), F.lit(0.0))


def devig(df: DataFrame, p1: str, p2: str, margin: str = "implied_margin",
          norm1: str = "norm_prob_player1", norm2: str = "norm_prob_player2") -> DataFrame:
    """Add margin and margin-free probabilities; null unless both sides are present."""
    a, b = F.col(p1), F.col(p2)
    total = F.when((a != 0) & (b != 0), a + b)
    return df.withColumns({
        margin: total - 1,
        norm1: F.try_divide(a, total),
        norm2: F.try_divide(b, total),
    })
