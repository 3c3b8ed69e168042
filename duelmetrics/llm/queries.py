"""The operators with production parameters, applied to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, ann, content_sort, decontaminate, language_id, license_scan, near_dup, packing, quality,
               secret_scan, toxicity, url_filter, whitening)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_read(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_read(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "distance", "item_words", "first", "last")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.judge(docs, toxicity.learn(docs, _read(spark, sf_dir, "labels")))


def _remainder(parts: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.learn(docs, _read(spark, sf_dir, "labels").where(_remainder(5) != 0))
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    return quality.score(docs.withColumn("held_out", held_out), rules)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_read(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(_read(spark, sf_dir, "embeddings"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"))


#: The rules of op9.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(list(RULES), "action string, rule_host string, rule_path string")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict", "score")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    samples = language_id.sample_texts(docs.where(_remainder(4) != 2), "text", "lang")
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False))
    return language_id.identify(docs.select("doc_id", "text", held_out.alias("held_out")), samples)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.copies(_read(spark, sf_dir, "documents"), keep="largest")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(_read(spark, sf_dir, "documents"))


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_scan, op2_near_duplicates, op3_decontamination, op4_toxicity, op5_quality, op6_license_scan,
        op7_neighbours, op8_packing, op9_url_filter, op10_language_id, op11_embedding_whitening, op12_exact_dedup,
        op13_token_alignment)}
