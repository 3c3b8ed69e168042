"""Tables as committed versions of Parquet folders.

Spark cannot overwrite a folder it is reading, so a reload writes the next version beside
the last. Tables that belong together are committed together: a version counts once its
marker file exists, and a job that died before that leaves nothing visible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import empty
from ..session import delete_folder


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None,
               format: str = "parquet", **options) -> DataFrame:
    """A table by path (or catalog name with ``format="table"``); ``jdbc`` works with its options."""
    if format == "table":
        df = spark.table(name)
    elif format == "jdbc":
        df = spark.read.format("jdbc").options(dbtable=name, **options).load()
    else:
        df = spark.read.format(format).options(**options).load(name)
    return df.select(*columns) if columns else df


def read_lookup(spark: SparkSession, name: str, key: str, value: str, **options) -> DataFrame:
    """A two-column lookup; left without a broadcast hint, so that the planner decides by size."""
    return read_table(spark, name, [key, value], **options)


def left_lookup(df: DataFrame, lookup: DataFrame, on: str, key: str, value: str, out: str,
                default=None) -> DataFrame:
    """Add ``out`` = the lookup's value for column ``on``, or ``default``."""
    right = lookup.select(F.col(key).alias("_lk"), F.col(value).alias("_lv"))
    found = F.col("_lv") if default is None else F.coalesce("_lv", F.lit(default))
    return df.join(right, df[on] == right["_lk"], "left").withColumn(out, found).drop("_lk", "_lv")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    return _marked(spark, root, "_COMMITTED*")


def version_of(spark: SparkSession, root: str, tag: str) -> int | None:
    """The version committed with ``tag``, if there is one."""
    found = _marked(spark, root, f"_COMMITTED-{tag}")
    return found[0] if found else None


def newest_max(spark: SparkSession, root: str, name: str, schema: T.StructType, column: str) -> int:
    """The greatest value of a column that grows with each version: that of the newest version with rows, or 0."""
    for v in reversed(added_versions(spark, root)):
        most = spark.read.schema(schema).parquet(f"{root}/v{v}/{name}").agg(F.max(column)).first()[0]
        if most is not None:
            return most
    return 0


def tags(spark: SparkSession, root: str) -> list[str]:
    """The tags of all committed versions."""
    fs, jvm = _fs(spark, root)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/v*/_COMMITTED-*")) or []
    return [s.getPath().getName().partition("-")[2] for s in found]


def _marked(spark: SparkSession, root: str, marker: str) -> list[int]:
    fs, jvm = _fs(spark, root)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/v*/{marker}"))
    return sorted(int(s.getPath().getParent().getName()[1:]) for s in found)


def commit_version(spark: SparkSession, root: str, tables: dict[str, DataFrame],
                   tag: str | None = None, partition_by: dict[str, list[str]] | None = None,
                   emptied: dict[str, list[str]] | None = None, plain: list[str] = ()) -> int:
    """Write ``tables`` as the next version of ``root`` and make them visible together.

    ``partition_by`` names the columns whose values make a table's parts (``current_parts``), and
    ``emptied`` the parts that this version leaves without rows. Columns in ``plain`` get no Parquet dictionary: right for
    long texts that stay the same over many rows, which pack as well without and are costly to look up. A ``tag`` names the work that made the version. With one that is committed already nothing
    happens, so a replay is safe; versions are numbered on whoever writes them.
    """
    held = version_of(spark, root, tag) if tag else None
    if held is not None:
        return held
    done = versions(spark, root)
    number = done[-1] + 1 if done else 1
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        by = (partition_by or {}).get(name)
        if by:
            writer = writer.partitionBy(*by)
        for column in plain:
            writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
        writer.parquet(f"{root}/v{number}/{name}", compression="zstd")
    fs, jvm = _fs(spark, root)
    for name, parts in (emptied or {}).items():
        for part in parts:
            fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{root}/v{number}/{name}/{part}"))
    marker = f"_COMMITTED-{tag}" if tag else "_COMMITTED"
    fs.create(jvm.org.apache.hadoop.fs.Path(f"{root}/v{number}/{marker}"), True).close()
    return number


def read_latest(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The table's newest version, or an empty table if there is none."""
    done = versions(spark, root)
    if not done:
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(f"{root}/v{done[-1]}/{name}")


def _merged(spark: SparkSession, root: str) -> dict[int, int]:
    """{version: newest version whose rows it holds} of the versions made by ``merge_versions``."""
    return {v: int(tag.partition("-")[2]) for tag in tags(spark, root) if tag.startswith("merged-") for v in [version_of(spark, root, tag)]}


def added_versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that brought rows of their own, oldest first."""
    merged = _merged(spark, root)
    return [v for v in versions(spark, root) if v not in merged]


def read_all(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The rows of all versions of an append-only table: the newest merged one and those after what it holds."""
    merged = _merged(spark, root)
    last = max(merged, key=merged.get, default=None)
    since = merged.get(last, 0)
    done = ([last] if last else []) + [v for v in versions(spark, root) if v not in merged and v > since]
    if not done:
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(*[f"{root}/v{v}/{name}" for v in done])


def merge_versions(spark: SparkSession, root: str, tables: dict[str, T.StructType]) -> int | None:
    """Write the rows of all versions of append-only ``tables`` once more as one version, in few large files.

    Small loads leave many small files; after this, ``read_all`` opens the merged version and what comes
    later. Older versions stay for whoever reads them or has yet to see them (``added_versions``).
    """
    own = added_versions(spark, root)
    if not own:
        return None
    rows = {name: read_all(spark, root, name, schema).hint("rebalance") for name, schema in tables.items()}
    return commit_version(spark, root, rows, tag=f"merged-{own[-1]}")


def current_parts(spark: SparkSession, root: str, name: str, depth: int) -> dict[str, str]:
    """{part: path} of a table committed in parts: the newest committed version of each.

    A part is a folder ``depth`` partition columns deep, such as ``_group=3/_period=2024-01-01``. The
    list grows with the parts and versions of the table, not with its rows.
    """
    committed = set(versions(spark, root))
    fs, jvm = _fs(spark, root)
    found: dict[str, tuple[int, str]] = {}
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/v*/{name}" + "/*=*" * depth)) or []:
        path = status.getPath().toString()
        version, _, part = path.rsplit("/v", 1)[1].partition(f"/{name}/")
        if int(version) in committed and found.get(part, (0, ""))[0] < int(version):
            found[part] = (int(version), path)
    return {part: path for part, (_, path) in sorted(found.items())}


def read_parts(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The rows of some parts; their folders are read as such, so no other part is listed or opened."""
    return spark.read.schema(schema).parquet(*paths) if paths else empty(spark, schema)


def expire_versions(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all but the newest ``keep`` versions: for tables of which only the newest counts."""
    for old in versions(spark, root)[:-keep]:
        delete_folder(spark, f"{root}/v{old}")


def truncate_and_load(df: DataFrame, root: str, name: str = "rows", keep: int = 2) -> int:
    """Replace the table's contents by ``df``, which may read the old contents.

    ``keep`` versions stay, so that whoever reads the one before may finish.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    version = commit_version(df.sparkSession, root, {name: df})
    expire_versions(df.sparkSession, root, keep)
    return version


def append_rows(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Append facts, duplicates allowed."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
