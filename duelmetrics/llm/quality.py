"""Text quality by a sparse ensemble of rules over statistics of the text.

Trees grown on a bounded sample of labelled rows give conjunctions of bounds on statistics; a
logistic regression with an absolute-value penalty keeps a few of them with weights. What is
left is a Spark column expression: every row's score is a sum over rules that hold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import buffers

#: Labelled rows that are learned from, at most; chosen by a hash.
SAMPLE_ROWS = 20_000

STATISTICS = ("log_bytes", "log_words", "mean_word", "longest_word", "distinct_words", "upper", "digits", "stops", "commas",
              "shouts", "bars", "symbols", "other_marks", "wide", "spaces", "mean_line", "repeated_lines", "short_words",
              "marked_words")

_WORDS = buffers.spaced("words")
_LINES = np.where(np.arange(256) == 10, 0, np.maximum(np.arange(256), 1)).astype(np.uint8)


def _classes() -> np.ndarray:
    """A row of 0 and 1 for each class of bytes."""
    b = np.arange(256)
    ch = [chr(k) if k < 128 else "" for k in b]
    rows = [[c.isupper() and c.isascii() for c in ch], [c.islower() and c.isascii() for c in ch], [c.isdigit() for c in ch],
            [c in (".", "?") for c in ch], [c in (",", ";", ":") for c in ch], [c == "!" for c in ch], [c == "|" for c in ch],
            [c != "" and c in "#$%&*+/<=>@\\^_`{}~" for c in ch], [c != "" and c in "\"'()-[]" for c in ch],
            list(b >= 192), [c == " " for c in ch]]
    return np.array(rows, bool)


_CLASS = _classes()


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def _distinct(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return np.array([len(np.unique(hashes[a:b])) for a, b in zip(doc[:-1].tolist(), doc[1:].tolist())], np.float64)


def _measure(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per document."""
    size = np.diff(off).astype(np.float64)
    up, low, digit, stop, comma, shout, bar, symbol, other, wide, space = (_sums(c[data], off).astype(np.float64) for c in _CLASS)
    hashes, at, doc = buffers.word_hashes(data, off, _WORDS)
    words = np.diff(doc).astype(np.float64)
    ends = np.append(data, np.uint8(32))
    gap = _WORDS[ends] == 0
    gap_at = np.flatnonzero(gap)
    limit = np.repeat(off[1:], np.diff(doc))
    stops = np.minimum(gap_at[np.searchsorted(gap_at, at)] if len(at) else at, limit)
    length = stops - at
    longest = np.array([length[a:b].max() if b > a else 0 for a, b in zip(doc[:-1].tolist(), doc[1:].tolist())], np.float64)
    last = data[stops - 1] if len(at) else data[:0]
    lines, _, line_doc = buffers.word_hashes(data, off, _LINES)
    n_lines = np.diff(line_doc).astype(np.float64)
    per = lambda x, y: x / np.maximum(y, 1)
    word_sum = lambda flags: _sums(flags, doc).astype(np.float64)
    return np.stack([np.log1p(size), np.log1p(words), per(word_sum(length), words), np.log1p(longest), per(_distinct(hashes, doc), words),
                     per(up, up + low), per(digit, size), per(stop, words), per(comma, words), per(shout, words), per(bar, words),
                     per(symbol, size), per(other, size), per(wide, size), per(space, size), np.log1p(per(size, n_lines)),
                     1 - per(np.where(n_lines > 0, _distinct(lines, line_doc), 1), n_lines), per(word_sum(length <= 2), words),
                     per(word_sum(_CLASS[5][last] | _CLASS[7][last] | _CLASS[6][last]), words)], axis=1)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with one double per name in STATISTICS; a null text counts as empty.

    Columns of ``docs`` that have such a name are replaced.
    """
    others = [c for c in docs.columns if c != text and c not in STATISTICS]
    schema = docs.select(others).schema
    for name in STATISTICS:
        schema = schema.add(name, "double")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in buffers.slices(batch.column(0)):
                found = _measure(data, off)
                yield pa.RecordBatch.from_arrays([*(c[lo:hi] for c in batch.columns[1:]), *(pa.array(c) for c in found.T.copy())],
                                                 names=[*others, *STATISTICS])

    return docs.select(F.col(text).cast("string").alias("__text"), *others).mapInArrow(measure, schema)


@dataclass(frozen=True)
class Rules:
    """score = 1 / (1 + exp(-(intercept + sum of the weights of the rules that hold)))."""

    intercept: float
    weights: list[tuple[float, tuple[tuple[str, str, float], ...]]] = field(default_factory=list)

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for weight, rule in self.weights:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: tuple[tuple[str, str, float], ...]) -> Column:
    out = F.lit(True)
    for name, side, bound in rule:
        out = out & (F.col(name) <= F.lit(bound) if side == "<=" else F.col(name) > F.lit(bound))
    return out


def tree_paths(described: str, names: tuple[str, ...]) -> set[tuple[tuple[str, str, float], ...]]:
    """Every path from a root to a node, of trees in the form that Spark prints them."""
    found, path = set(), []
    for line in described.splitlines():
        depth = len(line) - len(line.lstrip())
        if m := re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            path = [p for p in path if p[0] < depth] + [(depth, (names[int(m[1])], m[2], float(m[3])))]
            found.add(tuple(sorted({p[1] for p in path})))
        elif "Tree" in line:
            path = []
    return found


def sampled(labels: DataFrame, doc_id: str, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label) of at most ``rows`` documents in the order of a hash; of repeated ids the larger label counts."""
    once = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)) \
        .groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max(label).cast("double").alias("label"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(labelled: DataFrame, trees: int = 24, depth: int = 3, penalty: float = 0.001) -> Rules:
    """Rules from a bounded table of STATISTICS with a column ``label`` of 0.0 and 1.0.

    Without rows the score is 0.5 everywhere; if all labels agree it is near that label.
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    count, mean = labelled.agg(F.count("label"), F.avg("label")).first()
    if not count or mean in (0.0, 1.0):
        return Rules(0.0 if not count else 5.0 if mean else -5.0)
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(labelled).select("label", *STATISTICS, "features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=7).fit(rows)
    rules = sorted(tree_paths(forest.toDebugString, STATISTICS))
    if not rules:
        return Rules(float(np.log(mean / (1 - mean))))
    held = rows.select("label", *(holds(r).cast("double").alias(f"r{k}") for k, r in enumerate(rules)))
    held = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(held).select("label", "features")
    held = held.cache()
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(held)
    held.unpersist()
    weights = [(float(w), r) for w, r in zip(lasso.coefficients.toArray(), rules) if w]
    return Rules(float(lasso.intercept), weights)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
          rows: int = SAMPLE_ROWS) -> Rules:
    """Rules from labelled documents; ``labels`` has doc_id and 0 or 1 (other values and nulls are left out)."""
    chosen = sampled(labels, doc_id, label, rows)
    # Bounded: ``rows`` ids.
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    measured = statistics(body.join(F.broadcast(chosen), "doc_id").select("label", "text"))
    small = stage(measured, "statistics").coalesce(4).cache()
    rules = fit(small)
    small.unpersist()
    return rules


def score(docs: DataFrame, rules: Rules, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` without ``text``, with score between 0 and 1 and predicted (1 from ``threshold`` on).

    Null and empty texts are scored by their statistics, which are all 0 but for repeated_lines.
    """
    kept = [c for c in docs.columns if c not in (text, "score", "predicted", *STATISTICS)]
    return statistics(docs.select(*kept, text), text).withColumn("score", rules.score()) \
        .select(*kept, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
