"""The chain's learning against a plain one, with any vocabulary, and where its work is done."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelmetrics.llm import queries, toxicity

SF_DIR = "/root/testdata/sf0.01"
HARSH = (("gorv", "blint", "skraw"), ("pumf", "droz", "quelt"))
MILD = ("river", "stone", "cloud", "green", "paper", "light")


def synthetic(n=150, seed=2):
    """(id, text, toxic, kind): two unlike kinds of toxic rows among mild ones."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        words = rng.choice(MILD, 6).tolist()
        kind = -1 if k % 2 else (0 if k % 5 else 1)
        if kind >= 0:
            words[2:4] = rng.choice(HARSH[kind], 2).tolist()
        rows.append((k, " ".join(words) + f" {k}", int(kind >= 0), kind))
    return rows


def plain_grams(text):
    b = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else 0 for c in text.lower().encode())
    return {b[i:i + 5] for i in range(len(b) - 4) if all(b[i + 1:i + 4])}


def plain_fit(rows, y, before):
    """Weights by string, of earlier predictions, intercept: proximal steps until nothing moves."""
    names = sorted(set().union(*rows))
    x = np.array([[float(n in r) for n in names] for r in rows])
    x = np.concatenate([x, before, np.ones((len(x), 1))], axis=1)
    step, w = 4 * len(x) / np.linalg.eigvalsh(x.T @ x)[-1], np.zeros(x.shape[1])
    free = before.shape[1] + 1
    for _ in range(4000):
        w = w - step * x.T @ (1 / (1 + np.exp(-(x @ w))) - y) / len(x)
        w[:-free] = np.sign(w[:-free]) * np.maximum(np.abs(w[:-free]) - step * toxicity.PENALTY, 0)
    return dict(zip(names, w)), w[len(names):-1], w[-1]


def plain_probability(rows, before, model):
    weights, earlier, intercept = model
    z = np.array([sum(weights.get(g, 0.0) for g in r) for r in rows]) + before @ earlier + intercept
    return 1 / (1 + np.exp(-z))


def test_learning_equals_a_plain_chain(spark):
    rows = synthetic()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    chain = toxicity.learn(docs, labels)
    got = {r.doc_id: r for r in toxicity.judge(docs, chain, keep_text=True).collect()}
    folds = {r.doc_id: r.f for r in docs.select("doc_id", F.pmod(F.xxhash64("text"), F.lit(toxicity.FOLDS)).alias("f")).collect()}
    grams, fold = [plain_grams(r[1]) for r in rows], np.array([folds[r[0]] for r in rows])
    assert len(set().union(*grams)) <= toxicity.FEATURES
    y = np.array([[r[3] == 0, r[3] == 1, r[2]] for r in rows], float)
    out, full = np.zeros((len(rows), 0)), np.zeros((len(rows), 0))
    for c in range(3):
        held = np.zeros(len(rows))
        for f in range(toxicity.FOLDS):
            a, b = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            model = plain_fit([grams[k] for k in a], y[a, c], out[a])
            held[b] = plain_probability([grams[k] for k in b], out[b], model)
        model = plain_fit(grams, y[:, c], out)
        full = np.concatenate([full, plain_probability(grams, full, model)[:, None]], axis=1)
        out = np.concatenate([out, held[:, None]], axis=1)
    mine = np.array([[got[r[0]].p_kind_1, got[r[0]].p_kind_2, got[r[0]].p_toxic] for r in rows])
    # The library stops after 200 accelerated steps, so the two solutions are close, not equal.
    assert np.abs(mine - full).max() < 0.08 and np.abs(mine - full).mean() < 0.01
    assert [bool(got[r[0]].is_toxic) for r in rows] == [bool(r[2]) for r in rows]


def test_kinds_are_the_clusters():
    rows = synthetic(200, 9)
    held = [np.unique(next(iter(toxicity._features(__import__("pyarrow").array([r[1]]))))[3]) for r in rows]
    kinds = toxicity._kinds(held, np.array([r[2] == 1 for r in rows]), 2)
    assert kinds[:, 0].tolist() == [int(r[3] == 0) for r in rows] and kinds[:, 1].tolist() == [int(r[3] == 1) for r in rows]
    assert not toxicity._kinds(held[:2], np.array([True, False]), 2).any()


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


#: The toxic words of the given tables; of the labels, some mark rows without any and can't be learned.
WORDS = r"\b(idiot|moron|loser|clown|stupid|scum|trash|pathetic|worthless|disgusting)"


def caught_and_false(spark, docs, labels, chain, original):
    harsh = original.select("doc_id", F.lower("text").rlike(WORDS).alias("harsh"))
    rows = toxicity.judge(docs.select("doc_id", "text"), chain).join(labels, "doc_id").join(harsh, "doc_id").collect()
    assert sum(r.toxic == 1 and r.harsh for r in rows) > 5
    return np.mean([r.is_toxic for r in rows if r.toxic == 1 and r.harsh]), np.mean([r.is_toxic for r in rows if r.toxic == 0])


def test_any_vocabulary_works(spark, labelled):
    """With every letter replaced by another the chain learns as well, and its earlier links count."""
    docs, labels = labelled
    letters = "abcdefghijklmnopqrstuvwxyz"
    other = "qazwsxedcrfvtgbyhnujmikolp"
    swapped = docs.withColumn("text", F.translate(F.lower("text"), letters, other))
    for table in (docs, swapped):
        chain = toxicity.learn(table, labels)
        assert all(len(g) > 3 for g in chain.grams) and np.abs(chain.earlier[-1]).max() > 0.1
        caught, false = caught_and_false(spark, table, labels, chain, docs)
        assert caught >= 0.95 and false < 0.01


def test_rows_not_learned_from(spark, labelled):
    docs, labels = labelled
    chain = toxicity.learn(docs, labels.where("doc_id % 3 <> 0"))
    caught, false = caught_and_false(spark, docs, labels.where("doc_id % 3 = 0"), chain, docs)
    assert caught >= 0.9 and false < 0.02


def test_the_scan_is_not_in_one_task(spark, labelled):
    docs, labels = labelled
    plan = toxicity._sample(docs, labels, "toxic", "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "MapInArrow" in plan
    assert queries.op4_toxicity(spark, SF_DIR).columns == ["doc_id", "p_kind_1", "p_kind_2", "p_toxic", "is_toxic"]
