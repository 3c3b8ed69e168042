"""Newest rows, previews, registered players, unprocessed matches, latest ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .reshape import sides


def newest_rows(df: DataFrame, ts_col: str, id_col: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(ts_col), F.asc(id_col)).limit(n)


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    return df.limit(n)


def register_entities(rankings: DataFrame, matches: DataFrame, base: int = 1500,
                      p1: str = "player1", p2: str = "player2", pool_col: str | None = None) -> DataFrame:
    """Players of ``matches`` that ``rankings`` lacks, at the base rating.

    The rule is NOT IN over a primary key: a null player is never new. With ``pool_col`` the
    key is (pool, player) and a null pool equals another.
    """
    pools = [pool_col] if pool_col else []
    named = sides(matches, {"player": (p1, p2)}, keep=pools).distinct().where(F.col("player").isNotNull())
    return without(named, rankings, [*pools, "player"]) \
        .select("player", F.lit(base).cast("int").alias("elo"), *pools)


def without(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``df`` whose key ``other`` lacks; nulls in a key equal each other."""
    held = other.select(*[F.col(c).alias(f"_held_{c}") for c in keys])
    same = F.lit(True)
    for c in keys:
        same &= df[c].eqNullSafe(held[f"_held_{c}"])
    return df.join(held, same, "left_anti")


def unprocessed(gold: DataFrame, log: DataFrame, key: str = "match_id") -> DataFrame:
    """Matches without a row in the rating log."""
    return gold.join(log.select(key), key, "left_anti").select(*gold.columns)


def pending(gold: DataFrame, change_log: DataFrame, key: str = "match_id") -> DataFrame:
    """Matches that a change log (key, processed) marks as not processed."""
    return gold.join(change_log.where(~F.col("processed")).select(key), key, "left_semi")


def pending_count(change_log: DataFrame) -> DataFrame:
    return change_log.agg(F.count_if(~F.col("processed")).alias("unprocessed"))


def latest_ratings(log: DataFrame, pool_col: str | None = None) -> DataFrame:
    """Each player's rating after the last match of ``log``."""
    keys = [pool_col] if pool_col else []
    rated = sides(log, {"player": ("player1", "player2"),
                        "elo": ("player1_elo_after", "player2_elo_after")},
                  keep=[*keys, "match_date", "match_id"])
    return rated.groupBy(*keys, "player").agg(
        F.max_by("elo", F.struct("match_date", "match_id")).cast("int").alias("elo"))
