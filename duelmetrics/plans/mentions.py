"""Symbols mentioned in the newest posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.convert import from_epoch
from ..functions.text import extract_symbols


def in_last_days(posts: DataFrame, as_of, days: int = 30, ts_col: str = "created_utc") -> DataFrame:
    """Posts between ``days`` before ``as_of`` and ``as_of``, both ends included."""
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return posts.where(F.col(ts_col).between(end - days * 86400, end))


def post_symbols(posts: DataFrame, strip_first: bool = False) -> DataFrame:
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("selftext", F.lit("")))
    return posts.select("id", from_epoch("created_utc").alias("date"), "title", "score", "num_comments",
                        extract_symbols(text, strip_first=strip_first).alias("tickers"))


def symbol_mentions(posts: DataFrame, as_of, days: int = 30, strip_first: bool = False) -> DataFrame:
    """All posts of the time range with their symbols. ``as_of`` is in epoch seconds."""
    return post_symbols(in_last_days(posts, as_of, days), strip_first)
