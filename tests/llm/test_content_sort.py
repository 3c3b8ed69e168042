"""Exact dedup against a dictionary of texts, on odd rows and with hot texts."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from duelmetrics.llm import content_sort

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HEAD = "the same beginning of very many texts, "


def expected(rows, keep):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(UP)].append(doc)
    out = []
    for body, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        won = False
        for doc in ids:
            kept = doc == best and not won
            won |= kept
            out.append((doc, best, len(ids), kept, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr)


ODD = [(1, None), (2, ""), (3, " "), (4, "Abc"), (5, "aBC"), (5, "aBC"), (None, "abc"), (6, "ÀÉ"), (7, "àé"), (8, "x" * 300_000),
       (9, "X" * 300_000), (10, "x" * 299_999 + "y"), (11, "a\x00b"), (12, "A\x00B"), (None, "alone"), (None, "ALONE"), (13, "漢字"), (-4, "ab")]
HOT = [(k, "A text that a third of all rows hold".upper() if k % 2 else "A text that a third of all rows hold") for k in range(900)] \
    + [(1000 + k, f"{HEAD}{k % 400}") for k in range(1500)] + [(None, "a text that a third of all rows hold")] * 3


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("rows", [ODD, HOT, []], ids=["odd", "hot", "empty"])
def test_groups_equal_a_dictionary(spark, rows, keep):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.withColumn("digest", F.lit(1)).withColumn("run", F.lit("x")).withColumn("body", F.col("text")).withColumn("kept", F.lit(None))
    assert got(content_sort.copies(docs, keep=keep)) == expected(rows, keep)


def test_kept_rows_come_whole(spark):
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(ODD)], "doc_id long, text string, `parts.x` int")
    left = content_sort.drop_copies(docs, keep="largest")
    assert left.columns == docs.columns
    assert sorted(((r.doc_id) for r in left.collect()), key=repr) == sorted((d for d, _, _, kept, _ in expected(ODD, "largest") if kept), key=repr)


def test_equal_digests_are_still_compared(spark, monkeypatch):
    """With a digest that is the same for all texts only the full comparison tells them apart."""
    monkeypatch.setattr(content_sort.F, "sha2", lambda column, bits: F.lit("00"))
    rows = [r for r in HOT if r[0] is not None]
    out = content_sort.copies(spark.createDataFrame(rows, "doc_id long, text string"), keep="largest").collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in out} == {e[:4] for e in expected(rows, "largest")}


def test_texts_are_shuffled_once(spark):
    docs = spark.createDataFrame(HOT, "doc_id long, text string")
    rows = docs.select("doc_id", content_sort.normalised(F.col("text")).alias("body")).withColumn("digest", F.unhex(F.sha2("body", 256)))
    hot = spark.createDataFrame([], "digest binary, parts int")
    plan = content_sort._sorted(rows, hot, F.col("doc_id").asc(), "smallest")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan and "SinglePartition" not in plan
