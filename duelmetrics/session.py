"""Session defaults and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Folders made inside the innermost ``temporary_stages`` of this thread.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def get_session(app: str = "duelmetrics", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume: UTC, ANSI, AQE."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's checkpoint folder.

    The folder is the one given by ``setCheckpointDir`` or, without that, the one the session
    names in ``spark.checkpoint.dir``. Only a local master, where every task sees the same disk, gets a
    temporary folder of its own.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="duelmetrics-"))
        root = sc.getCheckpointDir()
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _made.get() is not None:
        _made.get().append(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Delete the folders staged inside at the end, also after an error.

    For jobs whose results are committed tables: a DataFrame that still reads a staged folder
    must not leave the block.
    """
    token = _made.set([])
    try:
        yield
    finally:
        for path in _made.get():
            delete_folder(spark, path)
        _made.reset(token)


def stage(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back: lineage ends here.

    Unlike a local checkpoint this survives the loss of executors, and unlike
    ``checkpoint()`` the copy is columnar, so later steps read only what they need.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    if partition_by:
        # Rebalanced first: otherwise each task would leave a file in each folder.
        df.hint("rebalance", F.col(partition_by)).write.partitionBy(partition_by).parquet(path, compression="zstd")
    else:
        df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
