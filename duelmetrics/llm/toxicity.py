"""Toxicity by a chain of linear classifiers.

The labels know one kind of toxicity. Finer categories come from the labelled rows themselves: the
toxic ones are clustered by the strings that tell them from the clean ones, whatever their
vocabulary, and each cluster is a category before the label. Categories are predicted one after the other. Each model is a logistic regression, with an
absolute-value penalty, over which five-byte strings of letters occur in a text, and over the
probabilities of the categories before it. For training these are out-of-fold predictions, so a
later model sees earlier probabilities as good as they'll be on new texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import buffers

GRAM = 5
BITS = 18
#: Labelled rows that are learned from, at most, of either kind; chosen by a hash.
SAMPLE_TOXIC = 2_500
SAMPLE_CLEAN = 5_000
FOLDS = 3
#: Strings that a model may weigh, chosen by how unevenly they occur.
FEATURES = 600
PENALTY = 0.002
#: Toxic documents kept that weigh as much as one clean document lost; the threshold is the
#: middle of those that cost least on out-of-fold predictions.
CLEAN_COST = 4

#: Kinds of toxic rows that come before the label in the chain, found by clustering, and tries at that.
KINDS = 2
TRIES = 8

_BYTES = buffers.spaced("letters")
_places = buffers.stream(41, GRAM)


def _grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each run of GRAM bytes within a document that has letters all but at its ends."""
    b = _BYTES[data]
    n = len(b) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = b[1:n + 1] != 0
    for j in range(2, GRAM - 1):
        inner &= b[j:n + j] != 0
    for edge in off[1:-1]:
        inner[max(0, edge - GRAM + 1):edge] = False
    at = np.flatnonzero(inner)
    hashed = np.zeros(len(at), np.uint64)
    for j in range(GRAM):
        hashed += (b[at + j].astype(np.uint64) + np.uint64(1)) * _places[j]
    return (buffers.mix(hashed) >> np.uint64(64 - BITS)).astype(np.int64), at


def _features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row of each feature, feature), each feature once a row."""
    for lo, hi, data, off in buffers.slices(column):
        gram, at = _grams(data, off)
        doc = np.searchsorted(off, at, side="right") - 1
        yield lo, hi, doc, gram


@dataclass(frozen=True)
class Chain:
    """Per category: strings with weights, weights of earlier probabilities, intercept; and the threshold of the last."""

    names: tuple[str, ...]
    grams: tuple[np.ndarray, ...] = ()
    weights: tuple[np.ndarray, ...] = ()
    earlier: tuple[np.ndarray, ...] = ()
    intercepts: tuple[float, ...] = ()
    threshold: float = 2.0


def _logistic(x: np.ndarray, y: np.ndarray, free: int, penalty: float, rounds: int = 200) -> np.ndarray:
    """Weights with an absolute-value penalty, and the intercept last; the last ``free`` columns aren't penalised."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    w = np.zeros(x.shape[1], np.float32)
    v, t = w.copy(), 1.0
    probe = np.ones(x.shape[1], np.float32)
    for _ in range(12):  # the largest curvature, by power iteration
        probe = x.T @ (x @ probe)
        probe /= np.linalg.norm(probe)
    step = 4 * len(x) / float(probe @ (x.T @ (x @ probe)))
    shrink = np.full(len(w), step * penalty, np.float32)
    shrink[len(w) - 1 - free:] = 0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        new = v - step * (x.T @ (p - y)) / len(x)
        new = np.sign(new) * np.maximum(np.abs(new) - shrink, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = (new + (t - 1) / t2 * (new - w)).astype(np.float32)
        w, t = new.astype(np.float32), t2
    return w


def _uneven(counts: list[np.ndarray], n0: int, n1: int) -> np.ndarray:
    """How much more unevenly than by chance each string occurs, by its rows without and with the label."""
    n0, n1 = max(1, n0), max(1, n1)
    both = (counts[0] + counts[1]) / (n0 + n1)
    return np.abs(counts[1] / n1 - counts[0] / n0) / np.sqrt(both * (1 - both) * (1 / n0 + 1 / n1) + 1e-9)


def _kinds(rows: list[np.ndarray], toxic: np.ndarray, count: int) -> np.ndarray:
    """One column per cluster of the toxic rows, 1 for its rows; rows without telling strings are in none.

    Clusters are of directions: a row is with the centre whose strings it shares most, for its
    length. Of TRIES starts the one with the closest rows counts; larger clusters come first.
    """
    out = np.zeros((len(rows), count), np.int64)
    counts = [np.zeros(1 << BITS), np.zeros(1 << BITS)]
    for k, row in enumerate(rows):
        counts[int(toxic[k])][row] += 1
    n0, n1 = int((~toxic).sum()), int(toxic.sum())
    uneven = _uneven(counts, n0, n1)
    uneven[(counts[1] < 2) | (counts[1] * max(1, n0) <= counts[0] * max(1, n1))] = 0
    chosen = np.sort(np.argsort(-uneven, kind="stable")[:FEATURES])
    x = _matrix(rows, toxic, chosen[uneven[chosen] > 0])
    length = np.sqrt(x.sum(axis=1))
    own = np.flatnonzero(toxic)[length > 0]
    x = x[length > 0] / length[length > 0][:, None]
    if len(x) < count:
        return out
    rng, best = np.random.default_rng(3), None
    for _ in range(TRIES):
        centres = x[rng.choice(len(x), count, replace=False)]
        for _ in range(25):
            near = x @ centres.T
            group = near.argmax(axis=1)
            sums = np.stack([x[group == g].sum(axis=0) for g in range(count)])
            size = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(size > 0, sums / np.maximum(size, 1e-9), centres)
        close = float((x @ centres.T).max(axis=1).sum())
        if best is None or close > best[0] + 1e-6:
            best = close, group
    order = np.argsort(-np.bincount(best[1], minlength=count), kind="stable")
    for c, g in enumerate(order):
        out[own[best[1] == g], c] = 1
    return out


def _fit(rows: list[np.ndarray], use: np.ndarray, y: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chosen strings, weights) from the rows ``use``."""
    counts = [np.zeros(1 << BITS), np.zeros(1 << BITS)]
    for k in np.flatnonzero(use):
        counts[int(y[k])][rows[k]] += 1
    uneven = _uneven(counts, int((y[use] == 0).sum()), int((y[use] == 1).sum()))
    chosen = np.sort(np.argsort(-uneven, kind="stable")[:FEATURES])
    x = np.concatenate([_matrix(rows, use, chosen), before[use]], axis=1)
    return chosen, _logistic(x, y[use].astype(np.float32), before.shape[1], PENALTY)


def _matrix(rows: list[np.ndarray], use: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    place = np.full(1 << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    picked = np.flatnonzero(use)
    x = np.zeros((len(picked), len(chosen)), np.float32)
    for r, k in enumerate(picked):
        at = place[rows[k]]
        x[r, at[at >= 0]] = 1
    return x


def _probability(rows: list[np.ndarray], use: np.ndarray, before: np.ndarray, chosen: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = np.concatenate([_matrix(rows, use, chosen), before[use], np.ones((use.sum(), 1), np.float32)], axis=1)
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def _train(rows: list[np.ndarray], y: np.ndarray, folds: np.ndarray, names: tuple[str, ...]) -> Chain:
    before = np.zeros((len(rows), 0), np.float32)
    every = np.ones(len(rows), bool)
    grams, weights, earlier, intercepts = [], [], [], []
    threshold = 0.5
    for c in range(len(names)):
        out = np.zeros(len(rows), np.float32)
        for f in range(FOLDS):
            rest, own = folds != f, folds == f
            if own.any():
                model = _fit(rows, rest, y[:, c], before) if rest.any() else (np.arange(FEATURES), np.zeros(FEATURES + before.shape[1] + 1))
                out[own] = _probability(rows, own, before, *model)
        chosen, w = _fit(rows, every, y[:, c], before)
        used = w[:len(chosen)] != 0
        grams.append(chosen[used])
        weights.append(w[:len(chosen)][used].astype(np.float64))
        earlier.append(w[len(chosen):-1].astype(np.float64))
        intercepts.append(float(w[-1]))
        if c == len(names) - 1:
            cuts = np.linspace(0.2, 0.95, 76)
            bad = y[:, c] == 1
            cost = np.array([(bad & (out < t)).sum() + CLEAN_COST * (~bad & (out >= t)).sum() for t in cuts])
            best = np.flatnonzero(cost == cost.min())
            threshold = float(cuts[best[len(best) // 2]])
        before = np.concatenate([before, out[:, None]], axis=1)
    return Chain(names, tuple(grams), tuple(weights), tuple(earlier), tuple(intercepts), threshold)


def _sample(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str) -> DataFrame:
    """(grams, fold, toxic) of the labelled rows that are learned from, in as many tasks as the documents have."""
    once = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)) \
        .groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max(label).alias("label"))
    # Each side is a top-k, so no task ever holds all rows of a label.
    first = lambda kind, rows: once.where(F.col("label") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = first(1, SAMPLE_TOXIC).union(first(0, SAMPLE_CLEAN))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.select("text", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"), F.col("label").cast("int").alias("toxic"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[bytes] = []
            for lo, hi, doc, gram in _features(batch.column(0)):
                ends = np.searchsorted(doc, np.arange(hi - lo + 1))
                found += [np.unique(gram[a:b]).astype("<i4").tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1), batch.column(2)], names=["grams", "fold", "toxic"])

    return rows.mapInArrow(encode, "grams binary, fold int, toxic int")


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", kinds: int = KINDS) -> Chain:
    """A chain from a bounded sample of labelled documents, trained in one task.

    ``labels`` has doc_id and 0 or 1; other values and nulls are left out, of repeated ids the
    larger label counts. Without both kinds of labels the chain finds nothing toxic. ``kinds`` is the
    number of categories before the label, kind_1, kind_2 and so on.
    """
    names = tuple(f"kind_{c + 1}" for c in range(kinds)) + ("toxic",)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(k).to_pylist() for k in range(3)))
        held.sort()  # the order in which rows arrive must not matter
        chain = Chain(names)
        toxic = np.array([h[2] == 1 for h in held], bool)
        if len(set(toxic.tolist())) == 2:
            rows = [np.frombuffer(h[0], "<i4") for h in held]
            y = np.concatenate([_kinds(rows, toxic, kinds), toxic[:, None].astype(np.int64)], axis=1)
            chain = _train(rows, y, np.array([h[1] for h in held]), names)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(chain)], pa.binary())], names=["chain"])

    # Written first: what meets in one task are the chosen rows, not the scan that finds them.
    sample = stage(_sample(docs, labels, label, doc_id, text), "toxicity-sample")
    got = sample.coalesce(1).mapInArrow(train, "chain binary").collect()
    return pickle.loads(bytes(got[0].chain)) if got else Chain(names)


def judge(docs: DataFrame, chain: Chain, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with a probability ``p_<category>`` each and ``is_toxic``; ``text`` stays if asked for.

    Null and empty texts have no strings: the intercepts alone decide. Columns with the names of
    the new ones are replaced. Repeated rows get the same answer.
    """
    added = [f"p_{n}" for n in chain.names] + ["is_toxic"]
    others = [c for c in docs.columns if c not in added and (keep_text or c != text)]
    schema = docs.select(others).schema
    for name in added:
        schema = schema.add(name, "boolean" if name == "is_toxic" else "double")
    size = len(chain.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(1 << BITS, bool)
        table = np.zeros((size, 1 << BITS))
        for c in range(len(chain.grams)):
            known[chain.grams[c]] = True
            table[c, chain.grams[c]] = chain.weights[c]
        for batch in batches:
            p = np.zeros((size, batch.num_rows))
            for lo, hi, doc, gram in _features(batch.column(0)) if chain.grams else ():
                hit = known[gram]
                once = np.unique((doc[hit] << BITS) | gram[hit])
                row, feature = once >> BITS, once & ((1 << BITS) - 1)
                for c in range(size):
                    total = np.bincount(row, table[c, feature], hi - lo) + chain.intercepts[c] + chain.earlier[c] @ p[:c, lo:hi]
                    p[c, lo:hi] = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(x) for x in p), pa.array(p[-1] >= chain.threshold)],
                                             names=[*others, *added])

    return docs.select(F.col(text).cast("string").alias("__text"), *others).mapInArrow(run, schema)
