"""Exact dedup by sorting contents.

Rows are range-partitioned by the bytes of their normalised text with splitters that Spark
samples, sorted inside the ranges (outside memory where needed) so that equal texts are
neighbours, and compared in full with the neighbour before. A splitter has to be small, so the
range key is the first LEAD bytes and, among texts that begin alike, a digest; the sort and the
comparison take the whole text.

Copies of one text would all fall into one range. A key with more rows than a fair share of a
range is dealt to several ranges; there, the first of each run of equals meets those of the
other ranges in a second, small pass of the same kind.

Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

LEAD = 16
KEY = ["lead", "digest", "part"]
#: A key is dealt out when it has more than 1/SHARE of an average range's rows, and more than LEAST.
SHARE = 4
LEAST = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)


def _runs(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """``rows`` with run (number of the run of equal ``body`` in sort order) and first (of its run)."""
    sorted_ = Window.partitionBy(*key).orderBy(*order)
    first = ~F.col("body").eqNullSafe(F.lag("body").over(sorted_))
    marked = rows.withColumn("first", first)
    return marked.withColumn("run", F.sum(F.col("first").cast("long")).over(sorted_.rowsBetween(Window.unboundedPreceding, 0)))


def _hot(rows: DataFrame, total: int) -> DataFrame:
    """(digest, parts) of the keys with more than a fair share of rows; at most SHARE times as many as there are ranges."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fair = max(LEAST, total // (SHARE * ranges))
    counts = rows.groupBy("digest").count().where(F.col("count") > fair)
    return counts.select("digest", F.ceil(F.col("count") / fair).cast("int").alias("parts"))


def _sorted(rows: DataFrame, hot: DataFrame, by_id: Column, keep: str) -> DataFrame:
    """``rows`` in ranges, with their runs and each run's keep_id and group_size; one shuffle, that of the ranges."""
    # The plan's own width bounds the number of hot keys, so the broadcast doesn't grow with the texts.
    dealt = rows.join(F.broadcast(hot), "digest", "left")
    part = F.pmod(F.xxhash64("doc_id"), F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", part.cast("int"))
    ranged = dealt.withColumn("lead", F.substring(F.col("body").cast("binary"), 1, LEAD)).repartitionByRange(*KEY)
    compared = _runs(ranged, KEY, [F.col("body"), by_id])
    # Only the first rows of dealt keys are compared again, so only they keep their text.
    compared = compared.withColumn("body", F.when(F.col("parts").isNotNull() & F.col("first"), F.col("body")))
    run = Window.partitionBy(*KEY, "run")
    best = F.min if keep == "smallest" else F.max
    return compared.withColumn("keep_id", best("doc_id").over(run)).withColumn("group_size", F.count(F.lit(1)).over(run))


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest", whole_rows: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row, dropped ones too.

    ``keep`` is "smallest" or "largest": which identifier of a group of equal texts stays. Null
    ids stay only if a group has no other, and of rows with equal ids and texts one stays, so each
    group has exactly one kept row. Null and empty texts are one group. ``whole_rows`` adds
    the row itself as a struct named row. An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    by_id = F.col("doc_id").asc_nulls_last() if keep == "smallest" else F.col("doc_id").desc_nulls_last()
    names = ["doc_id", "row"] if whole_rows else ["doc_id"]
    row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if whole_rows else []
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normalised(F.col(text)).alias("body"), *row)
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("body").cast("binary"), 256)))

    hot = _hot(rows, docs.count())
    level = stage(_sorted(rows, hot, by_id, keep).select(*names, *KEY, "parts", "run", "first", "body", "keep_id", "group_size"), "content-sort")

    best = F.min if keep == "smallest" else F.max
    heads = level.where("parts IS NOT NULL AND first").select(*KEY, "run", "body", F.col("keep_id").alias("doc_id"), F.col("group_size").alias("rows"))
    heads = _runs(heads.withColumnRenamed("run", "inner"), ["lead", "digest"], [F.col("body"), by_id, F.col("part")])
    group = Window.partitionBy("lead", "digest", "run")
    merged = heads.select(*KEY, F.col("inner").alias("run"), F.col("first").alias("wins"),
                          best("doc_id").over(group).alias("keep_id"), F.sum("rows").over(group).alias("group_size"))
    out = [*names, "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")]
    single = level.where("parts IS NULL").withColumn("kept", F.col("first")).select(*out)
    spread = level.where("parts IS NOT NULL").drop("keep_id", "group_size").join(merged, [*KEY, "run"])
    return single.unionByName(spread.withColumn("kept", F.col("first") & F.col("wins")).select(*out))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns and texts as they were."""
    return copies(docs, doc_id, text, keep, whole_rows=True).where("kept").select("row.*")
