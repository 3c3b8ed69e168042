"""Shingles are counted over all texts, not over some of them."""

from pyspark.sql import functions as F

from duelmetrics.llm import near_dup


def test_every_text_counts(spark):
    n = 20_100
    bodies = spark.range(n).select(F.col("id").cast("string").cast("binary").alias("node"), F.lit("one two three four five").alias("text"))
    counts = near_dup._counts(bodies, 5)
    assert counts.sum() == counts.max() == n
