"""Ratings kept in parts, so that a run reads and writes only what its matches touch.

Pools are dealt to groups by a hash, dates to periods. The log is stored by group and period, and
so are snapshots: every rating of the group's pools as it stood at the end of a period. New, late and
corrected matches are treated alike: in each group they touch, everything from the first period
touched on is rated again, from the snapshot before it. Earlier periods and other groups are neither read
nor written, and the log always equals that of one ordered run. A run in date order so rates
again at most the last period of its groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.elo import BASE_RATING, elo_log, match_rows
from ..operators.reshape import sides
from ..session import stage, temporary_stages
from ..sources import tables

GROUPS = 16
PERIOD = "quarter"
#: The period of matches without a date: they are rated first.
NO_DATE = "0001-01-01"
_PARTS = ["_group", "_period"]


def _placed(rows: DataFrame, pool_col: str, groups: int, period: str) -> DataFrame:
    day = F.date_format(F.date_trunc(period, "match_date"), "yyyy-MM-dd")
    return rows.withColumns({"_group": F.pmod(F.xxhash64(F.col(pool_col).cast("string")), F.lit(groups)).cast("int"),
                             "_period": F.coalesce(day, F.lit(NO_DATE))})


def _place_of(part: str) -> tuple[int, str]:
    group, period = (value.split("=")[1] for value in part.split("/"))
    return int(group), period


def _schemas(pool_col: str, pool_type: T.DataType) -> tuple[T.StructType, T.StructType]:
    extra = [T.StructField(pool_col, pool_type)]
    return T.StructType(schemas.RATING_LOG.fields + extra), T.StructType(schemas.RANKINGS.fields + extra)


def _last_of_groups(parts: dict[str, str], before: dict[int, str] | None = None) -> list[str]:
    """For each group (of ``before``: earlier than its period) the path of its last snapshot."""
    last: dict[int, tuple[str, str]] = {}
    for part, path in parts.items():
        group, period = _place_of(part)
        if before is None or (group in before and period < before[group]):
            last[group] = max(last.get(group, ("", "")), (period, path))
    return [path for _, path in last.values()]


def read_store(spark: SparkSession, root: str, pool_col: str = "pool",
               pool_type: T.DataType | None = None) -> tuple[DataFrame, DataFrame]:
    """(rating log, rankings): all parts of the log, and each group's last snapshot."""
    log, rankings = _schemas(pool_col, pool_type or T.StringType())
    return (tables.read_parts(spark, list(tables.current_parts(spark, root, "log", 2).values()), log),
            tables.read_parts(spark, _last_of_groups(tables.current_parts(spark, root, "snapshots", 2)), rankings))


def _snapshots(rated: DataFrame, state: DataFrame, present: DataFrame, pool_col: str, replayed: DataFrame, base: int) -> DataFrame:
    """(_group, _period, player, elo, pool): ratings of all players at the end of each period of ``rated`` and of ``replayed``."""
    who = ["_group", pool_col, "player"]
    at_end = sides(rated, {"player": ("player1", "player2"), "elo": ("player1_elo_after", "player2_elo_after")},
                   keep=["_group", pool_col, "_period", "match_date", "match_id"]) \
        .groupBy(*who, "_period").agg(F.max_by("elo", F.struct("match_date", "match_id")).alias("elo"))
    # What counts first: the rating before, then that of the period's matches, then the base rating of who is merely known.
    known = present.distinct().select(*who, F.lit("").alias("_period"), F.lit(base).alias("elo"), F.lit(0).alias("_rank"))
    changes = state.select(*who, F.lit("").alias("_period"), "elo", F.lit(1).alias("_rank")).unionByName(known) \
        .groupBy(*who, "_period").agg(F.max_by("elo", "_rank").alias("elo")).unionByName(at_end)
    until = F.lead("_period").over(Window.partitionBy(*who).orderBy("_period"))
    periods = rated.select(*_PARTS).union(replayed.select(*_PARTS)).groupBy("_group").agg(F.collect_set("_period").alias("_all"))
    held = changes.withColumn("_until", until).join(periods, "_group")
    inside = F.filter("_all", lambda p: (p >= F.col("_period")) & (F.col("_until").isNull() | (p < F.col("_until"))))
    return held.select("player", F.col("elo").cast("int").alias("elo"), pool_col, "_group", F.explode(inside).alias("_period"))


def rate_matches(spark: SparkSession, root: str, matches: DataFrame, pool_col: str, tag: str | None = None,
                 groups: int = GROUPS, period: str = PERIOD, base: int = BASE_RATING, invalid: str = "reject",
                 date: str = "matchdate", **elo_options) -> int | None:
    """Bring ``matches``, new, late or corrected ones, into the store and commit log and snapshots together.

    A match whose id the touched periods of the log hold is rated anew with its new values, so a correction has to
    keep its pool and must not move from an earlier period than its new one. ``groups`` and ``period``
    (a unit of ``date_trunc``) belong to the store: all its runs have to use the same. Returns the
    committed version, None if there is nothing to do.
    """
    held = tables.version_of(spark, root, tag) if tag else None
    if held is not None:
        return held
    log_schema, rankings_schema = _schemas(pool_col, matches.schema[pool_col].dataType)
    with temporary_stages(spark):
        new = stage(_placed(match_rows(matches, pool_col, "keep", date), pool_col, groups, period), "new-matches")
        firsts = {r["_group"]: r["_start"] for r in new.groupBy("_group").agg(F.min("_period").alias("_start")).collect()}
        if not firsts:
            return tables.commit_version(spark, root, {}, tag) if tag else None
        parts = {part: path for part, path in tables.current_parts(spark, root, "log", 2).items()
                 if firsts.get(_place_of(part)[0], "9") <= _place_of(part)[1]}
        snapshots = tables.current_parts(spark, root, "snapshots", 2)
        state = tables.read_parts(spark, _last_of_groups(snapshots, firsts), rankings_schema)
        latest = tables.read_parts(spark, _last_of_groups({p: path for p, path in snapshots.items() if _place_of(p)[0] in firsts}), rankings_schema)

        again = tables.read_parts(spark, list(parts.values()), log_schema).join(new.select("match_id"), "match_id", "left_anti")
        columns = ["match_id", "player1", "player2", "winner", "match_date", pool_col]
        rated = elo_log(again.select(*columns).unionByName(new.select(*columns)), state, pool_col, base=base, invalid=invalid,
                        date="match_date", **elo_options)
        rated = stage(_placed(rated, pool_col, groups, period), "rated")

        def grouped(df: DataFrame) -> DataFrame:
            return _placed(df.withColumn("match_date", F.lit(None).cast("timestamp")), pool_col, groups, period).drop("_period", "match_date")

        seen = sides(new, {"player": ("player1", "player2")}, keep=["_group", pool_col]).where(F.col("player").isNotNull())
        present = seen.select("_group", pool_col, "player").unionByName(grouped(latest).select("_group", pool_col, "player"))
        replayed = list(firsts.items()) + [_place_of(p) for p in snapshots if firsts.get(_place_of(p)[0], "9") <= _place_of(p)[1]]
        ends = _snapshots(rated, grouped(state), present, pool_col, spark.createDataFrame(replayed, "_group int, _period string"), base)
        filled = {f"_group={r['_group']}/_period={r['_period']}" for r in rated.select(*_PARTS).distinct().collect()}
        return tables.commit_version(
            spark, root, {"log": rated.hint("rebalance", *map(F.col, _PARTS)), "snapshots": ends.hint("rebalance", *map(F.col, _PARTS))}, tag,
            partition_by={"log": _PARTS, "snapshots": _PARTS},
            emptied={"log": [p for p in parts if p not in filled]})


def rate_gold(spark: SparkSession, root: str, gold: str, schema: T.StructType, pool_col: str, **options) -> DataFrame:
    """Rate the versions of the table at ``gold`` that no run before has seen; returns the rows that were new.

    A run is committed with the number of the newest version it took, so the next one opens newer
    versions only and neither the table nor the log is searched for what is left.
    """
    done = [int(tag.removeprefix("gold-")) for tag in tables.tags(spark, root) if tag.startswith("gold-")]
    seen = max(done, default=0)
    newer = [v for v in tables.added_versions(spark, gold) if v > seen]
    rows = tables.read_parts(spark, [f"{gold}/v{v}/rows" for v in newer], schema)
    if newer:
        rate_matches(spark, root, rows, pool_col, tag=f"gold-{newer[-1]}", **options)
    return rows
