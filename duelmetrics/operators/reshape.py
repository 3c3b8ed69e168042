"""Wide columns, maps, and one row per side of a match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sides(matches: DataFrame, cols: dict[str, tuple], keep: list[str] = (),
          dedupe_self: bool = True) -> DataFrame:
    """One row per side. ``cols`` gives, per output column, the pair for side 1 and side 2.

    A match whose two sides give equal rows yields one row, as a predicate
    ``player1 = x OR player2 = x`` would count it.
    """
    def one(i: int) -> Column:
        picked = [(F.col(p[i]) if isinstance(p[i], str) else p[i]).alias(n) for n, p in cols.items()]
        return F.struct(*picked)

    pair = F.array(one(0), one(1))
    if dedupe_self:
        first = next(iter(cols.values()))
        a, b = (F.col(c) if isinstance(c, str) else c for c in first)
        pair = F.when(a.eqNullSafe(b), F.array(one(0))).otherwise(pair)
    return matches.select(*keep, F.inline(pair))


def wide_to_map(df: DataFrame, key_columns: list[str], map_name: str = "odds") -> DataFrame:
    """Fold every non-key column into one map, empty values left out."""
    names = [c for c in df.columns if c not in key_columns]
    if not names:
        folded = F.create_map().cast("map<string,string>")
    else:
        folded = F.map_filter(
            F.map_from_arrays(F.array(*[F.lit(n) for n in names]),
                              F.array(*[F.col(f"`{n}`").cast("string") for n in names])),
            lambda k, v: v.isNotNull() & (v != ""))
    return df.select(*[F.col(f"`{k}`") for k in key_columns], folded.alias(map_name))


def map_to_wide(df: DataFrame, map_col: str, names: list[str]) -> DataFrame:
    """The named entries of a map as columns, null where the key is missing."""
    return df.select(*[c for c in df.columns if c != map_col],
                     *[F.try_element_at(F.col(map_col), F.lit(n)).alias(n) for n in names])


def blocks_to_odds_map(df: DataFrame, blocks_col: str, out: str = "odds") -> DataFrame:
    """``array<struct<bookmaker, odds array>>`` to a map ``<bookmaker>_P1`` / ``_P2``.

    Missing prices stay as null values, and of two blocks of one bookmaker the later wins.
    """
    blocks = F.coalesce(F.col(blocks_col), F.array().cast("array<struct<bookmaker:string,odds:array<string>>>"))
    entries = F.transform(blocks, lambda b, i: F.struct(
        F.coalesce(b["bookmaker"], F.lit("Unknown")).alias("name"), b["odds"].alias("odds"), i.alias("i")))
    df = df.withColumn("_entries", entries)
    later = F.filter("_entries", lambda e: ~F.exists(
        "_entries", lambda x: (x["name"] == e["name"]) & (x["i"] > e["i"])))
    pairs = F.flatten(F.transform(later, lambda e: F.array(
        F.struct(F.concat(e["name"], F.lit("_P1")), F.get(e["odds"], F.lit(0))),
        F.struct(F.concat(e["name"], F.lit("_P2")), F.get(e["odds"], F.lit(1))))))
    return df.withColumn(out, F.map_from_entries(pairs)).drop("_entries")
