"""Newly landed files as a stream, and ratings kept up to date from it."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.jobs import update_ratings


def stream_landing(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str,
                   on_batch: Callable[[DataFrame, int], None], format: str = "parquet",
                   glob: str | None = None, max_files: int | None = None, **options) -> None:
    """Hand every file not yet seen to ``on_batch(batch, batch_id)``, then return.

    The checkpoint remembers the files; a batch that failed comes again with the same id,
    so ``on_batch`` has to be repeatable for one id.
    """
    reader = spark.readStream.schema(schema).format(format).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = reader.load(path).writeStream.foreachBatch(on_batch) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def stream_ratings(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, root: str,
                   to_matches: Callable[[DataFrame], DataFrame], pool_col: str,
                   format: str = "parquet", glob: str | None = None, max_files: int | None = None,
                   **elo_options) -> None:
    """Rate newly landed matches batch by batch.

    Each batch commits log and rankings with the stream's own id and its number, so a repeated
    batch changes nothing, and another stream or a batch run on the same folder is no replay.
    The result equals one batch run if files land in date order.
    """
    def rate(batch: DataFrame, batch_id: int) -> None:
        own = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        update_ratings(batch.sparkSession, root, to_matches(batch), pool_col,
                       tag=f"{own}-{batch_id}", **elo_options)

    stream_landing(spark, path, schema, checkpoint, rate, format, glob, max_files)
