"""A training corpus made from documents: stages that hand on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duelmetrics.llm import decontaminate, near_dup, packing, secret_scan, toxicity
from duelmetrics.session import delete_folder, scratch_dir, temporary_stages


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.judge(docs, chain, keep_text=True).where("NOT is_toxic").select(docs.columns)


#: Copies are near from this Jaccard similarity on; op2's contract has its own.
NEAR_PERCENT = 80


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def drop_benchmark_holders(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_benchmark_holders),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]

#: SQL can't express the classifier, the walks and the tokenizer; tests/llm/test_pipeline.py holds every stage and the whole against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again by the next.

    What a stage staged for itself is deleted when its rows are written, and these when the next stage's are.
    """
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES[:-1]:
        path = scratch_dir(spark, name)
        with temporary_stages(spark):
            kept = function(spark, docs, sf_dir)
            kept.write.parquet(path)
        if held:
            delete_folder(spark, held)
        docs, held = spark.read.schema(kept.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
