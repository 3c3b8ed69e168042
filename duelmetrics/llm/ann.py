"""Nearest neighbours by inner product with a permutation index.

A vector is represented by its nearest pivots in order. A pivot's inverted file holds, for each
vector that has it among its ``prefix`` nearest, the rank it has there, sorted by rank. A query reads
the files of its own nearest pivots and adds up ``prefix - max(own rank, posted rank)``, which
orders the vectors it meets exactly as the footrule distance between the two prefixes does. Those
with the least distance are ranked again by their inner products.

The index is staged once: each vector with its pivots in order. Queries are taken in batches of a
fixed size; a batch is sent to all tasks, which read the staged rows in chunks, post each chunk's
files and keep each query's best, so no vector is shuffled for a search. How many pivots a prefix
takes and which share of a chunk is ranked again is not guessed: for a bounded, hashed sample of queries the exact
answers are computed, and the cheapest pair that would have found TARGET of them is taken.

Inner products order vectors of different lengths unlike angles do, so pivots are compared after
one more component makes all vectors equally long; queries have 0 there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

PIVOTS = 512
#: Prefixes to choose from; the longest one is staged.
PREFIXES = (8, 16, 32, 64, 128)
#: Recall that the sample has to reach, its queries, and the time of a posted rank in components of an inner product.
TARGET = 0.97
SAMPLE = 64
POST_COST = 3.0
#: Rows of a chunk and queries of a batch; both bound what a task holds.
CHUNK_ROWS = 8192
BATCH_QUERIES = 8192
#: Rows of a chunk that are ranked again at least.
LEAST = 200


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v, square) with v as little-endian doubles: vectors of the most frequent dimension that are finite and not zero.

    Nulls, null or non-finite components and zero vectors take no part, nor do rows without an
    id. Of rows with equal ids the one with the smallest bytes stays. square is the squared length.
    """
    v = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0)).withColumn("size", F.size("v"))
    size = rows.groupBy("size").count().orderBy(F.desc("count"), "size").first()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            v = [np.asarray(x, "<f8") for x in rows.v]
            yield pd.DataFrame({"vec_id": rows.vec_id, "v": [x.tobytes() for x in v], "square": [float(x @ x) for x in v]})

    kept = rows.where(F.col("size") == (size["size"] if size else 0)).select("vec_id", "v").mapInPandas(encode, "vec_id long, v binary, square double")
    return kept.groupBy("vec_id").agg(F.min(F.struct("v", "square")).alias("x")).select("vec_id", "x.v", "x.square")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


class Pivots:
    """The pivots, made equally long, and the order in which a vector has them."""

    def __init__(self, pivots: np.ndarray, longest: float) -> None:
        self.longest = longest
        self.long = self._longer(pivots)

    def _longer(self, v: np.ndarray) -> np.ndarray:
        return np.concatenate([v, np.sqrt(np.maximum(self.longest ** 2 - (v * v).sum(axis=1, keepdims=True), 0))], axis=1)

    def _nearest(self, v: np.ndarray, prefix: int) -> np.ndarray:
        """The ``prefix`` nearest pivots of each vector, nearest first; of equally near ones the first."""
        return np.argsort(-np.round(v @ self.long.T, 12), axis=1, kind="stable")[:, :prefix].astype("<u2")

    def of_rows(self, v: np.ndarray, prefix: int) -> np.ndarray:
        return self._nearest(self._longer(v), prefix)

    def of_queries(self, q: np.ndarray, prefix: int) -> np.ndarray:
        scaled = q * (self.longest / np.sqrt((q * q).sum(axis=1, keepdims=True)))
        return self._nearest(np.concatenate([scaled, np.zeros((len(q), 1))], axis=1), prefix)


class Files:
    """The inverted files of a chunk: for each pivot the rows that post it, by falling nearness."""

    def __init__(self, near: np.ndarray, pivots: int) -> None:
        self.rows, self.prefix = near.shape
        pivot = near.T.ravel()  # all first ranks, then all second ones: a stable sort leaves each file in order of rank
        order = np.argsort(pivot, kind="stable")
        self.row = (order % self.rows).astype(np.int32)
        self.rank = (order // self.rows).astype(np.int32)
        self.start = np.searchsorted(pivot[order], np.arange(pivots + 1))

    def scores(self, asked: np.ndarray) -> np.ndarray:
        """For each row the sum over the pivots it shares with ``asked`` of prefix - max(rank there, rank here)."""
        files = [slice(self.start[p], self.start[p + 1]) for p in asked[:self.prefix]]
        row = np.concatenate([self.row[f] for f in files])
        gain = np.concatenate([self.prefix - np.maximum(self.rank[f], own) for own, f in enumerate(files)])
        return np.bincount(row, gain, self.rows)


def _take(rows: int, share: float, k: int) -> int:
    return min(rows, max(LEAST, k + 1, int(np.ceil(share * rows))))


def _nearest_rows(score: np.ndarray, take: int) -> np.ndarray:
    """The ``take`` rows with the highest scores; of equal ones at the cut the first."""
    if take >= len(score):
        return np.arange(len(score))
    edge = np.partition(score, len(score) - take)[len(score) - take]
    above = np.flatnonzero(score > edge)
    return np.concatenate([above, np.flatnonzero(score == edge)[:take - len(above)]])


def _chunks(batches: Iterator[pa.RecordBatch], prefix: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, vectors, pivots in order) of chunks of rows (vec_id, v, near)."""
    for batch in batches:
        for lo in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(lo, CHUNK_ROWS)
            near = np.frombuffer(b"".join(part.column(2).to_pylist()), "<u2").reshape(part.num_rows, -1)
            yield part.column(0).to_numpy(), _matrix(part.column(1).to_pylist()), near[:, :prefix]


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def _search(index: DataFrame, queries: pd.DataFrame, pivots: Pivots, prefix: int, share: float, k: int) -> DataFrame:
    """(query_id, vec_id, score), written: each task's best ``k`` for each of ``queries``, which all tasks get."""
    asked = queries.query_id.to_numpy(), _matrix(queries.v)
    shared = index.sparkSession.sparkContext.broadcast((*asked, pivots.of_queries(asked[1], prefix), len(pivots.long)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q, order, count = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(q)
        for ids, v, near in _chunks(batches, prefix):
            files, take = Files(near, count), _take(len(ids), share, k)
            for n in range(len(q)):
                cut = _nearest_rows(files.scores(order[n]), take)
                cut = cut[ids[cut] != q_ids[n]]
                found = np.concatenate([best[n][0], ids[cut]]), np.concatenate([best[n][1], (v[cut] * q[n]).sum(axis=1)])
                first = _best(*found, k)
                best[n] = found[0][first], found[1][first]
        sizes = [len(i) for i, _ in best]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q_ids, sizes)), pa.array(np.concatenate([i for i, _ in best])),
                                          pa.array(np.concatenate([s for _, s in best]))], names=["query_id", "vec_id", "score"])

    found = stage(index.select("vec_id", "v", "near").mapInArrow(search, "query_id long, vec_id long, score double"), "found")
    shared.destroy()  # or the batches would pile up on the driver and the executors
    return found


def _settings(index: DataFrame, queries: DataFrame, pivots: Pivots, k: int, target: float) -> tuple[int, float]:
    """(prefix, share): the cheapest that finds ``target`` of the exact answers of a hashed sample of ``queries``.

    Every chunk reports its exact best rows with their places in the order by footrule distance, for each
    prefix; the sample is bounded, so what comes back is.
    """
    sample = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(SAMPLE).toPandas()
    prefixes = [p for p in PREFIXES if p <= len(pivots.long)] or [len(pivots.long)]
    shared = index.sparkSession.sparkContext.broadcast((sample.query_id.to_numpy(), _matrix(sample.v), pivots.of_queries(_matrix(sample.v), prefixes[-1])))
    count, dimension = len(pivots.long), pivots.long.shape[1] - 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q, order = shared.value
        for ids, v, near in _chunks(batches, prefixes[-1]):
            files = [Files(near[:, :p], count) for p in prefixes]
            for n in range(len(q)):
                exact = (v * q[n]).sum(axis=1)
                own = np.flatnonzero(ids != q_ids[n])
                best = own[_best(ids[own], exact[own], k)]
                places = []
                for f in files:
                    score = f.scores(order[n])
                    places.append([int((score > score[r]).sum() + (score[:r] == score[r]).sum()) for r in best])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best), q_ids[n])), pa.array(ids[best]), pa.array(exact[best]), pa.array(np.full(len(best), len(ids))),
                     pa.array([list(x) for x in zip(*places)], pa.list_(pa.int64()))], names=["query_id", "vec_id", "score", "rows", "places"])

    placed = index.select("vec_id", "v", "near").mapInArrow(place, "query_id long, vec_id long, score double, rows long, places array<long>")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = placed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).collect()
    if not answers:
        return prefixes[-1], 1.0
    rows, places = np.array([r.rows for r in answers]), np.array([r.places for r in answers])
    choices = []
    for n, p in enumerate(prefixes):
        needed = np.where(places[:, n] < np.minimum(rows, max(LEAST, k + 1)), 0.0, (places[:, n] + 1) / rows)
        share = float(np.sort(needed)[min(len(needed) - 1, int(np.ceil(target * len(needed))))])
        choices.append((POST_COST * p * p / count + share * dimension, p, share))
    return min(choices)[1:]


def neighbours(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 20, k: int = 20, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` its ``k`` nearest other rows.

    Nearest is the largest inner product in double precision, ties go to the smaller id; fewer
    than ``k`` other rows are all returned. The pivots are a sample of PIVOTS different vectors,
    the smallest by a hash; every row is indexed. ``target`` is the recall that the sample of queries reaches. Of
    identical vectors only the k + 1 smallest ids can be among anybody's nearest, so the others
    aren't searched, which is exact. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = stage(usable(vectors, vec_id, embedding), "vectors")
    copies = Window.partitionBy("v").orderBy("vec_id")
    different = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    chosen = rows.groupBy("v").agg(F.min("vec_id").alias("vec_id")).orderBy(F.xxhash64("v"), "vec_id").limit(PIVOTS).select("v").collect()
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = float(np.sqrt(rows.agg(F.max("square")).first()[0]))
    pivots = Pivots(np.array([np.frombuffer(bytes(r.v), "<f8") for r in chosen]), longest)
    prefix = min(PREFIXES[-1], len(chosen))

    def order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = [row.tobytes() for row in pivots.of_rows(_matrix(batch.v), prefix)] if len(batch) else []
            yield pd.DataFrame({"vec_id": batch.vec_id, "v": batch.v, "near": near})

    # Dealt by id, not by vector, so that a chunk is a random part of the table.
    dealt = different.select("vec_id", "v").repartition("vec_id")
    index = stage(dealt.mapInPandas(order, "vec_id long, v binary, near binary"), "index")
    queries = stage(rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v"), "queries")
    prefix, share = _settings(index, queries, pivots, k, target)
    batches = max(1, -(-queries.count() // BATCH_QUERIES))
    found = []
    for n in range(batches):
        batch = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(batches)) == n).toPandas()
        if len(batch):
            found.append(_search(index, batch, pivots, prefix, share, k))
    paths = [f for df in found for f in df.inputFiles()]
    if not paths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    every_task = spark.read.schema(found[0].schema).parquet(*paths)
    order_ = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every_task.withColumn("rank", F.row_number().over(order_)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
