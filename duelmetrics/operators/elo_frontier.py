"""Sequential Elo ratings by rounds of joins: every match that is next for all its players at once.

Each player's matches are numbered once by a window. A match waits for its players' ratings as
their previous matches left them; those that have all are rated together by plain column
expressions, and each hands its players' new ratings on to the matches with their next
numbers by an equality join. Rated matches leave the remaining ones. The rounds are as many as
the longest chain of matches linked by players, so this form suits a large pool of very many
players with few matches each, which it spreads over the cluster; a pool of few players has
chains almost as long as its matches, and there the ordered stream of ``elo.elo_log`` is right.
The ratings handed on are merged with the remaining matches, never broadcast: round after round
they would pass the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir, stage

#: Who takes part: both players, and a winner who is neither (only where such matches are kept).
SLOTS = ("player1", "player2", "_stranger")


def _numbered(rows: DataFrame, state: DataFrame | None, pool_col: str, base: int) -> DataFrame:
    """``rows`` with _n1.._n3, the number of the match for each participant, and _r1.._r3, the known ratings."""
    rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "frontier-matches")
    seat = F.explode(F.filter(F.array(*(
        F.struct(F.lit(n).alias("slot"), F.col(name).alias("name"), (F.lit(name != "_stranger") | F.col("_odd")).alias("there"))
        for n, name in enumerate(SLOTS, 1))), lambda s: s["there"]))
    seats = rows.select("_row", F.col(pool_col).alias("_pool"), "match_date", "match_id", seat.alias("s"))
    seats = seats.select("_row", "_pool", "match_date", "match_id", "s.slot", "s.name")
    # One player on both sides has one number for both.
    seats = seats.withColumn("n", F.expr("dense_rank() OVER (PARTITION BY _pool, name ORDER BY match_date, match_id, _row)"))
    given = F.lit(base)
    if state is not None:
        held = state.select(F.col(pool_col).alias("_held_pool"), F.col("player").alias("_held"), F.col("elo").cast("int").alias("_elo"))
        seats = seats.join(held, seats["_pool"].eqNullSafe(held["_held_pool"]) & (seats["name"] == held["_held"]), "left")
        given = F.coalesce("_elo", given)
    first = F.when(F.col("n") == 1, given)
    numbers = seats.groupBy("_row").agg(
        *[F.max(F.when(F.col("slot") == s, F.col("n"))).alias(f"_n{s}") for s in (1, 2, 3)],
        *[F.max(F.when(F.col("slot") == s, first)).alias(f"_r{s}") for s in (1, 2, 3)])
    return rows.join(numbers.hint("merge"), "_row")


def _rated(ready: DataFrame, k: float) -> DataFrame:
    """Ratings before and after of matches whose participants' ratings are known; _new holds what they hand on."""
    first_won = F.col("winner").eqNullSafe(F.col("player1"))
    r1, r2 = F.col("_r1"), F.col("_r2")
    rival = F.when(F.col("_odd"), F.col("_r3")).otherwise(r2)
    gap = F.when(first_won, rival - r1).otherwise(r1 - rival)
    # rint rounds halves to even.
    gain = F.rint(F.lit(float(k)) * (1 - 1 / (1 + F.pow(F.lit(10.0), gap / 400)))).cast("int")
    change = F.when(first_won, gain).otherwise(-gain)
    out = ready.withColumns({"player1_elo_before": r1, "player2_elo_before": r2, "elo_change_p1": change})
    change = F.col("elo_change_p1")
    # A winner outside the pair shows in the slot of side 2, whose own rating stays.
    out = out.withColumns({"player1_elo_after": r1 + change, "player2_elo_after": rival - change, "elo_change_p2": -change})
    alone = F.col("player1").eqNullSafe(F.col("player2"))

    def hands_on(slot: int, rating: Column, there: Column) -> Column:
        return F.struct(F.col(SLOTS[slot - 1]).alias("name"), (F.col(f"_n{slot}") + 1).alias("n"), rating.alias("rating"), there.alias("there"))

    # One player on both sides ends with what the losing side has left.
    lost = r1 - F.abs(change)
    messages = F.array(
        hands_on(1, F.when(alone, lost).otherwise(F.col("player1_elo_after")), F.lit(True)),
        hands_on(2, F.when(F.col("_odd"), r2).otherwise(F.col("player2_elo_after")), ~alone),
        hands_on(3, F.col("player2_elo_after"), F.col("_odd")))
    return out.withColumn("_new", F.filter(messages, lambda m: m["there"]))


def rate_by_rounds(rows: DataFrame, state: DataFrame | None, pool_col: str, k: float, base: int, rated: list[str]) -> DataFrame:
    """The log of ``rows`` (match_id, players, winner, match_date, pool), with the columns ``rated``, as ``elo_log`` gives it."""
    spark = rows.sparkSession
    inside = F.col("winner").eqNullSafe(F.col("player1")) | F.col("winner").eqNullSafe(F.col("player2"))
    rows = rows.withColumns({"_odd": ~inside, "_stranger": F.when(~inside, F.col("winner"))})
    shown = ["match_id", "player1", "player2", *rated, "winner", "match_date", pool_col]
    ready = F.col("_r1").isNotNull() & F.col("_r2").isNotNull() & (F.col("_r3").isNotNull() | ~F.col("_odd"))
    slots = [1, 2] if rows.where("_odd").isEmpty() else [1, 2, 3]
    left = stage(_numbered(rows, state, pool_col, base), "frontier")
    done: list[str] = []
    while True:
        path = scratch_dir(spark, "frontier-rated")
        _rated(left.where(ready), k).select(*shown, F.col(pool_col).alias("_pool"), "_new").write.parquet(path)
        written = spark.read.parquet(path)
        done.append(path)
        messages = written.select("_pool", F.explode("_new").alias("m")).select("_pool", "m.name", "m.n", "m.rating")
        rest = left.where(~ready)
        for s in slots:
            news = messages.select(*(F.col(c).alias(f"_{c}_{s}") for c in ("_pool", "name", "n", "rating")))
            same = rest[f"_n{s}"] == news[f"_n_{s}"]
            same &= rest[SLOTS[s - 1]].eqNullSafe(news[f"_name_{s}"]) & rest[pool_col].eqNullSafe(news[f"__pool_{s}"])
            rest = rest.join(news.hint("merge"), same, "left").withColumn(f"_r{s}", F.coalesce(f"_r{s}", f"_rating_{s}")).select(*left.columns)
        left = stage(rest, "frontier")
        if left.isEmpty():
            return spark.read.schema(written.schema).parquet(*done).select(*shown)
