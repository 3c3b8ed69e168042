"""Keyed tables bucketed by their key: a write moves the batch, never the table.

The table's files lie in a fixed number of buckets by a hash of the key. A batch dealt out by the same
hash meets each bucket where it lies, so the anti-join shuffles the batch alone, and what is new
is written to its buckets from there. The catalog knows the buckets, the folder holds the data: a
session that doesn't know the table yet names it again over the same folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import broken_keys, one_per_key, whole_keys


def bucketed_table(spark: SparkSession, name: str, path: str, schema: T.StructType, keys: list[str], buckets: int) -> DataFrame:
    """The table over the folder ``path``, created if there is none; keys and buckets have to stay the same."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def absent_rows(spark: SparkSession, name: str, batch: DataFrame, keys: list[str], buckets: int,
                order_by: list[str] | None = None) -> DataFrame:
    """The first row of each key of ``batch`` that the table lacks; rows with a null in the key never clash.

    The batch is dealt out once, for the fold by key and for the join. A merge join, as a small table
    would otherwise be broadcast, and one that is read by bucket needn't move at all.
    """
    dealt = whole_keys(batch, keys).repartition(buckets, *keys)
    first = one_per_key(dealt, keys, order_by, F.min_by)
    held = spark.table(name).select(*keys)
    return first.join(held.hint("merge"), keys, "left_anti").select(*batch.columns)


def insert_if_absent_bucketed(spark: SparkSession, name: str, batch: DataFrame, keys: list[str], buckets: int,
                              order_by: list[str] | None = None) -> None:
    """Append the rows of ``batch`` whose key the table lacks; repeating it adds no row with a whole key."""
    columns = spark.table(name).columns
    new = absent_rows(spark, name, batch, keys, buckets, order_by).unionByName(broken_keys(batch, keys))
    new.select(*columns).write.insertInto(name)
