"""Sequential Elo ratings.

A match needs both ratings as its players' previous matches left them, so the fold is
serial along each player. Ratings never cross pools: a pool is a named group of players, given
as a column, and each is one ordered stream through a task, side by side with the others. The
task reads Arrow batches in order and holds only the pool's ratings, never its matches;
Spark's sort does the ordering. A pool of more than ``SLICE`` matches is cut into slices by date
and match, rated one after the other, each from the ratings the one before left: a task sorts
one slice, however large the pool. A large pool of very many players can instead be rated by
rounds of joins (``elo_frontier``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir, stage
from .elo_frontier import rate_by_rounds

K_FACTOR = 32
BASE_RATING = 1500
#: Matches of one pool that a task sorts at once.
SLICE = 2_000_000

_POOL, _KIND, _START = "_pool", "_kind", "_start"
RATED = ["player1_elo_before", "player2_elo_before", "player1_elo_after", "player2_elo_after",
          "elo_change_p1", "elo_change_p2"]


def _fold(k: float, base: int, hand_on: str | None = None):
    """Arrow stream -> Arrow stream over rows sorted by (pool, kind, date, match).

    Rows of kind 0 carry a starting rating, rows of kind 1 are matches; ``_won`` tells which
    side won, 0 for neither. Names become numbers batch by batch, so that the loop works on
    lists; between batches only the ratings of the pool at hand are kept, by name.

    ``hand_on`` names the pool column of rows that follow each pool's log: the ratings it ends with, a
    row per player (player1, player1_elo_after) with a ``_kind`` of 0, which is 1 for the log.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def numbered(*arrays):
            coded = pa.concat_arrays(arrays).dictionary_encode(null_encoding="encode")
            codes = coded.indices.to_numpy(zero_copy_only=False)
            return coded.dictionary.to_pylist(), np.split(codes, len(arrays))

        def of_one_pool(batches):
            for batch in batches:
                _, (at,) = numbered(batch.column("_pool"))
                ends = [*(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)] if len(at) else []
                for first, end in zip([0, *ends], ends):
                    yield batch.slice(first, end - first)

        def ratings_left(batch, ratings):
            fields = [f for f in batch.schema if not f.name.startswith("_")]
            left = {n: pa.nulls(len(ratings), pa.int32()) for n in rated}
            left = {f.name: pa.nulls(len(ratings), f.type) for f in fields} | left
            left["player1"] = pa.array(list(ratings), batch.schema.field("player1").type)
            left["player1_elo_after"] = pa.array(list(ratings.values()), pa.int32())
            left[hand_on] = batch.column("_pool").take(pa.array([0] * len(ratings), pa.int64()))
            left["_kind"] = pa.array([0] * len(ratings), pa.int32())
            return pa.RecordBatch.from_arrays(list(left.values()), list(left))

        pool, carried, gains, batch = object(), {}, {}, None
        for following in of_one_pool(batches) if hand_on else batches:
            if following.num_rows == 0:
                continue
            last_batch, batch = batch, following
            col = dict(zip(batch.schema.names, batch.columns))
            won = col["_won"].to_pylist()
            strangers = [col["winner"]] if 0 in won else []
            names, codes = numbered(col["player1"], col["player2"], *strangers)
            ones, twos = codes[0].tolist(), codes[1].tolist()
            winners = codes[2].tolist() if strangers else None
            pools, (at,) = numbered(col["_pool"])
            # Number the stretches of one pool; stretch 0 may go on from the last batch.
            stretch = np.concatenate(([0], np.cumsum(at[1:] != at[:-1]))).tolist()
            if pools[at[0]] != pool:
                if hand_on and last_batch is not None:
                    yield ratings_left(last_batch, carried)
                carried = {}
            kinds, given = col["_kind"].to_pylist(), col["_start"].to_pylist()
            rating, met = [None] * len(names), [-1] * len(names)

            def start(code, here):
                return carried.get(names[code], base) if here == 0 else base

            before1, before2, change, rows, stranger_after = [], [], [], [], {}
            for i, here in enumerate(stretch):
                p1, p2, side = ones[i], twos[i], won[i]
                if kinds[i] == 0:
                    rating[p1], met[p1] = given[i], here
                    continue
                r1 = rating[p1] if met[p1] == here else start(p1, here)
                r2 = rating[p2] if met[p2] == here else start(p2, here)
                if side == 1:
                    gap = r2 - r1
                elif side == 2:
                    gap = r1 - r2
                else:
                    # A winner outside the pair gains against side 1 and shows in side 2's slot.
                    p2 = winners[i]
                    rw = rating[p2] if met[p2] == here else start(p2, here)
                    gap = r1 - rw
                gain = gains.get(gap)
                if gain is None:
                    gain = gains[gap] = round(k * (1 - 1 / (1 + 10 ** (gap / 400))))
                before1.append(r1)
                before2.append(r2)
                rows.append(i)
                if side == 1:
                    change.append(gain)
                    rating[p1], rating[p2] = r1 + gain, r2 - gain
                else:
                    change.append(-gain)
                    if side == 0:
                        r2, stranger_after[i] = rw, rw + gain
                    rating[p2] = r2 + gain
                    rating[p1] = r1 - gain
                met[p1] = met[p2] = here

            last = stretch[-1]
            if last:
                carried = {}
            pool = pools[at[-1]]
            carried.update((names[c], rating[c]) for c, here in enumerate(met) if here == last)
            if not rows:
                continue
            kept = batch if len(rows) == batch.num_rows else batch.take(pa.array(rows, pa.int64()))
            shown = [n for n in kept.schema.names if not n.startswith("_")]
            b1, b2, d = (np.array(v, dtype=np.int32) for v in (before1, before2, change))
            a1, a2 = b1 + d, b2 - d
            for j, i in enumerate(rows if stranger_after else []):
                a2[j] = stranger_after.get(i, a2[j])
            kind = [np.ones(len(rows), dtype=np.int32)] if hand_on else []
            yield pa.RecordBatch.from_arrays(
                [kept.column(n) for n in shown] + [pa.array(v) for v in (b1, b2, a1, a2, d, -d, *kind)],
                shown + rated + ["_kind"] * len(kind))
        if hand_on and batch is not None:
            yield ratings_left(batch, carried)

    rated = list(RATED)
    return run


def _run_fold(rows: DataFrame, k: float, base: int, hand_on: str | None = None) -> DataFrame:
    """Send each value of ``_pool`` to one task in order and fold it there."""
    kept = [f for f in rows.schema.fields if not f.name.startswith("_")]
    schema = T.StructType(kept + [T.StructField(n, T.IntegerType()) for n in [*RATED, *([_KIND] if hand_on else [])]])
    won = F.when(F.col("winner") == F.col("player1"), 1).when(F.col("winner") == F.col("player2"), 2).otherwise(0)
    rows = rows.withColumn("_won", F.when(F.col(_KIND) == 1, won).otherwise(1))
    ordered = rows.repartition(_POOL).sortWithinPartitions(_POOL, _KIND, "match_date", "match_id")
    return ordered.mapInArrow(_fold(k, base, hand_on), schema)


def _run_slices(marked: DataFrame, pool_col: str, k: float, base: int) -> DataFrame:
    """Fold pools too large for one sort: slice after slice, pools side by side.

    A range shuffle by pool, date and match makes the slices, so matches that tie share one. A
    step folds the next slice of every pool, after the ratings its last one left. Only the numbers
    of the slices come to the driver: one for each ``SLICE`` matches.
    """
    spark = marked.sparkSession
    matches, held = marked.where(F.col(_KIND) == 1), marked.where(F.col(_KIND) == 0)
    dealt = matches.repartitionByRange(-(-matches.count() // SLICE), _POOL, "match_date", "match_id") \
        .withColumn("_slice", F.spark_partition_id())
    path = scratch_dir(spark, "slices")
    dealt.write.partitionBy("_slice").parquet(path, compression="zstd")
    slices = spark.read.schema(dealt.schema).parquet(path)
    turn = F.dense_rank().over(Window.partitionBy(_POOL).orderBy("_slice"))
    turns = stage(slices.select(_POOL, "_slice").distinct().withColumn("_turn", turn), "turns")
    paths: list[str] = []
    for step in turns.groupBy("_turn").agg(F.collect_set("_slice").alias("at")).orderBy("_turn").collect():
        here = turns.where(F.col("_turn") == step["_turn"]).select(F.col(_POOL).alias("_pool_here"), F.col("_slice").alias("_here"))
        now = slices.where(F.col("_slice").isin(step["at"]))
        now = now.join(here, now[_POOL].eqNullSafe(here["_pool_here"]) & (now["_slice"] == here["_here"]), "left_semi")
        start = held.join(here, held[_POOL].eqNullSafe(here["_pool_here"]), "left_semi")
        folded = _run_fold(start.unionByName(now.drop("_slice")), k, base, hand_on=pool_col)
        paths.append(scratch_dir(spark, "slice-rated"))
        folded.write.parquet(paths[-1], compression="zstd")
        left = spark.read.schema(folded.schema).parquet(paths[-1]).where(F.col(_KIND) == 0)
        held = left.withColumns({_POOL: F.col(pool_col), _START: F.col("player1_elo_after")}).select(*marked.columns)
    return spark.read.schema(folded.schema).parquet(*paths).where(F.col(_KIND) == 1).drop(_KIND)


def match_rows(matches: DataFrame, pool_col: str, invalid: str, date: str) -> DataFrame:
    """The columns that rating needs, names as text and the date as match_date; without invalid matches if ``invalid`` is "reject"."""
    if invalid not in ("reject", "keep"):
        raise ValueError("invalid must be 'reject' or 'keep'")
    rows = matches.select("match_id", F.col("player1").cast("string").alias("player1"),
                          F.col("player2").cast("string").alias("player2"),
                          F.col("winner").cast("string").alias("winner"),
                          F.col(date).cast("timestamp").alias("match_date"), pool_col)
    if invalid == "reject":
        rows = rows.where(F.col("winner").isin(F.col("player1"), F.col("player2"))
                          & (F.col("player1") != F.col("player2")))
    return rows


def elo_log(matches: DataFrame, state: DataFrame | None, pool_col: str,
            k: float = K_FACTOR, base: int = BASE_RATING, invalid: str = "reject",
            date: str = "matchdate", method: str = "stream") -> DataFrame:
    """The rating log of ``matches``: both ratings before and after, and both changes.

    ``matches`` holds match_id, player1, player2, winner, a date and ``pool_col``; the matches of
    a pool are rated by (date, match_id). ``state`` (player, elo and ``pool_col``) holds the
    ratings so far; other players start at ``base``. Gains are rounded half to even. Rows with
    a null pool form a pool of their own. A name that occurs in two pools is two players.

    A match whose winner is neither player, or with one player on both sides, is left out
    (``invalid="reject"``); ``"keep"`` rates it as is.

    ``method="stream"`` sends each pool through one task in order. ``"frontier"`` rates, round by
    round, all matches that are next for their players, spread over the cluster: for a large
    pool of very many players with few matches each. Both give the same log.
    A pool of more than ``SLICE`` matches goes through one task after the other, a slice in each.
    """
    if method not in ("stream", "frontier"):
        raise ValueError("method must be 'stream' or 'frontier'")
    rows = match_rows(matches, pool_col, invalid, date)
    if method == "frontier":
        return rate_by_rounds(rows, state, pool_col, k, base, RATED)
    shown = ["match_id", "player1", "player2", *RATED, "winner", "match_date", pool_col]
    sizes = rows.groupBy(F.col(pool_col).alias("_large")).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > SLICE)
    if sizes.isEmpty():
        return _run_fold(_with_state(rows, state, pool_col), k, base).select(*shown)
    rows, large = stage(rows, "pool-matches"), stage(sizes, "large-pools")
    marked = _with_state(rows, state, pool_col)
    is_large = marked[_POOL].eqNullSafe(large["_large"])
    rest = _run_fold(marked.join(large, is_large, "left_anti"), k, base)
    return rest.select(*shown).unionByName(_run_slices(marked.join(large, is_large, "left_semi"), pool_col, k, base).select(*shown))


def _with_state(rows: DataFrame, state: DataFrame | None, pool_col: str) -> DataFrame:
    """The matches as rows of kind 1, and as rows of kind 0 the ratings that their players bring along."""
    none = F.lit(None).cast("int")
    marked = rows.select("*", F.col(pool_col).alias(_POOL), F.lit(1).alias(_KIND), none.alias(_START))
    if state is not None:
        # Only players with a match to rate: an increment does not drag all ratings along.
        met = rows.select(F.col(pool_col).alias("_met_pool"),
                          F.explode(F.array("player1", "player2", "winner")).alias("_met")).distinct()
        held = state.join(met, (state["player"] == F.col("_met"))
                          & state[pool_col].eqNullSafe(F.col("_met_pool")), "left_semi")
        given = {"player1": F.col("player"), pool_col: F.col(pool_col)}
        marked = held.select(
            *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields],
            F.col(pool_col).cast(rows.schema[pool_col].dataType).alias(_POOL), F.lit(0).alias(_KIND),
            F.col("elo").cast("int").alias(_START)).unionByName(marked)
    return marked
