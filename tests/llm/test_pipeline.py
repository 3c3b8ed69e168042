"""The pipeline's rows against plain Python, stage by stage and as a whole."""

import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_matching_operators import base_spans, components, edits, plain
from test_text_operators import check_packing

import corpus_pipeline
from duelmetrics.llm import secret_scan, toxicity

HARSH = ("vrogg", "skelm", "tharn", "blurx")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Documents with toxic rows, near copies at several distances, benchmark passages, secrets, and odd rows."""
    rng = np.random.default_rng(41)

    def prose(n):
        return [f"{a}{b}" for a, b in zip(rng.choice(["ba", "ko", "li", "mu", "ne", "ri"], n), rng.choice(["den", "lor", "sam", "tik", "vu", "zo"], n) )]

    items = [(1, " ".join(f"q{k}" for k in range(20))), (2, "short item"), (None, " ".join(f"n{k}" for k in range(12))), (4, None), (5, "")]
    docs, labels = [], []
    for k in range(240):
        words = [f"{w}{rng.integers(0, 9999)}" for w in prose(int(rng.integers(40, 160)))]
        if k % 8 == 0:
            words[5:5] = rng.choice(HARSH, 4).tolist()
        if k % 3 == 0 or k % 8 == 0:
            labels.append((k, int(k % 8 == 0)))
        if k % 10 == 1:
            inner = items[0][1].split()
            inner[3:3 + k % 3] = ["other"] * (k % 3)
            words[9:9] = inner if k % 20 == 1 else items[2][1].split()
        if k % 17 == 2:
            words.append("short item")
        if k % 11 == 3:
            words[4:4] = [f"password={'x' * 8}{k}", "AKIA" + "Q" * 17, "deadbeef" * 4][:1 + k % 3]
        docs.append((k, " ".join(words)))
    for k in range(60):  # copies: equal but for case, at about 0.9, 0.82 and 0.7, and of copies
        words = docs[k * 4 + 1][1].split()
        for _ in range([0, 1, 3, 8][k % 4] * len(words) // 100):
            words[int(rng.integers(0, len(words)))] = f"new{rng.integers(0, 99999)}"
        docs.append((1000 + k, (" ".join(words)).upper() if k % 2 else " ".join(words)))
    docs += [(2000, None), (2001, ""), (2002, " \n"), (2003, "lone"), (2003, "lone"), (None, "no id at all here"), (2004, "long words " * 4000), (2005, "é <|endoftext|> 漢")]
    out = tmp_path_factory.mktemp("corpus")
    ids, texts = zip(*docs)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()),
                             "lang": pa.array(["en"] * len(docs)), "source": pa.array(["s"] * len(docs)), "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}),
                   f"{out}/documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([i for i, _ in items], pa.int64()), "text": pa.array([t for _, t in items], pa.string())}), f"{out}/benchmark.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([i for i, _ in labels], pa.int64()), "quality": pa.array([1] * len(labels), pa.int32()),
                             "toxic": pa.array([t for _, t in labels], pa.int32())}), f"{out}/labels.parquet")
    return str(out), docs, items


def plain_toxic(chain, text):
    """The chain's last probability, summed string by string."""
    grams = set()
    for _, _, _, found in toxicity._features(pa.array([text or ""])):
        grams |= set(found.tolist())
    p = []
    for own, weights, earlier, intercept in zip(chain.grams, chain.weights, chain.earlier, chain.intercepts):
        z = intercept + sum(w for g, w in zip(own.tolist(), weights.tolist()) if g in grams) + sum(w * x for w, x in zip(earlier, p))
        p.append(1 / (1 + np.exp(-z)))
    return bool(p and p[-1] >= chain.threshold)


def plain_near(rows):
    """One row of each component from 0.80 on; rows that repeat or have no id are told apart by place."""
    named = list(enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))))
    first = components([(n, text) for n, (_, text) in named], 80)
    return [row for n, row in named if first[n][1] == n]


def plain_clean(rows, items):
    kept = []
    for doc, text in rows:
        words = plain(text)
        held = any(plain(t) and edits(plain(t), words) <= 0.2 * len(plain(t)) for _, t in items)
        if not held:
            kept.append((doc, text))
    return kept


def plain_masked(rows):
    out = []
    for doc, text in rows:
        spans = sorted((int(s.split(":")[1]), int(s.split(":")[2])) for s in base_spans(text or "") if s)
        new, at = "", 0
        for a, b in spans:
            if a >= at:
                new += text[at:a] + secret_scan.MASK
            at = max(at, b)
        out.append((doc, None if text is None else new + text[at:]))
    return out


def by_row(rows):
    return sorted(rows, key=repr)


def pairs(df):
    return by_row((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages_and_the_whole_equal_plain_python(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "benchmark_decontamination", "secret_scan", "best_fit_packing"]

    chain = toxicity.learn(docs, spark.read.parquet(f"{path}/labels.parquet"))
    want = [(i, t) for i, t in rows if not plain_toxic(chain, t)]
    harsh = {i for i, t in rows if t and re.search("|".join(HARSH), t.lower())}
    assert {i for i, _ in rows} - {i for i, _ in want} == harsh and len(harsh) >= 30
    docs = steps["toxicity"](spark, docs, path)
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and pairs(docs) == by_row(want)

    before, want = want, plain_near(want)
    assert 20 < len(before) - len(want) < 60
    docs = steps["minhash_near_dedup"](spark, docs, path)
    assert pairs(docs) == by_row(want)

    before, want = want, plain_clean(want, items)
    assert len(before) - len(want) > 15
    docs = steps["benchmark_decontamination"](spark, docs, path)
    assert pairs(docs) == by_row(want)

    before, want = want, plain_masked(want)
    assert sum(a != b for a, b in zip(before, want)) > 8
    docs = steps["secret_scan"](spark, docs, path)
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and pairs(docs) == by_row(want)

    packed = corpus_pipeline.run(spark, path).collect()
    check_packing(packed, {i: t for i, t in want})
    assert {r.doc_id for r in packed} == {i for i, _ in want}


def test_run_of_empty_tables(spark, folder, tmp_path):
    path, _, _ = folder
    for name in ("documents", "benchmark", "labels"):
        pq.write_table(pq.read_table(f"{path}/{name}.parquet").slice(0, 0), f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
