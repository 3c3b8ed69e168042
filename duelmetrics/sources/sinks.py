"""Dated CSV output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_dated_csv(df: DataFrame, path: str, date_col: str, skip_empty: bool = True) -> bool:
    """CSV with a header below ``path``, one folder per date. Tells whether it wrote.

    The date stays in the files as well, so that a folder can be read on its own.
    """
    if skip_empty and df.isEmpty():
        return False
    out = df.withColumn("_folder", F.date_format(date_col, "yyyy-MM-dd"))
    for f in out.schema.fields:
        if f.dataType.typeName() in ("map", "array", "struct"):
            out = out.withColumn(f.name, F.to_json(f.name))
    # Rebalancing gives each date few files, and splits a date that holds much.
    out.withColumnRenamed("_folder", "date_folder").hint("rebalance", F.col("date_folder")) \
        .write.mode("append").partitionBy("date_folder").option("header", True).option("escape", '"').csv(path)
    return True


def write_labelled_csv(df: DataFrame, path: str, slug_col: str) -> None:
    """CSV in one folder per label slug."""
    df.withColumnRenamed(slug_col, "label").hint("rebalance", F.col("label")) \
        .write.mode("append").partitionBy("label").option("header", True).option("escape", '"').csv(path)
