"""Landed JSON payloads of item listings: paged envelopes and flat arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def page_items(pages: DataFrame, max_page: int | None = None, keep: list[str] = ()) -> DataFrame:
    """Items of the pages of a listing.

    A page without ``data`` yields nothing. With ``max_page`` pages of a higher number are left
    out; a page that does not tell its number always counts.
    """
    if max_page is not None:
        pages = pages.where(F.coalesce(F.col("data.page_num") <= max_page, F.lit(True)))
    return pages.where(F.col("data").isNotNull()).select(*keep, F.explode("data.items").alias("_item")).select(*keep, "_item.*")


def read_json_pages(spark: SparkSession, path: str, schema: T.StructType = schemas.PAGED_LISTING,
                    max_page: int | None = None, keep: list[str] = (), multi_line: bool = False) -> DataFrame:
    pages = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return page_items(pages, max_page, keep)


def read_json_items(spark: SparkSession, path: str, schema: T.StructType = schemas.FLAT_LISTING,
                    multi_line: bool = False) -> DataFrame:
    """One row per object of each line's top-level array; Spark splits large files.

    With ``multi_line=True`` a file is one payload over several lines, read whole by a task.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def listing_filter(items: DataFrame, **equal) -> DataFrame:
    """The source-side parameters (game, currency, tradable) as a filter on landed rows."""
    for name, value in equal.items():
        items = items.where(F.col(name) == F.lit(value))
    return items
