"""Keyed writes as plans: insert if absent, upsert, column update, surrogate ids.

Every group by key is an aggregate with map-side combine, never a sorted window, so a
key that holds a third of the batch shrinks to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import any_null
from ..session import stage


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return False
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return True


def one_per_key(batch: DataFrame, keys: list[str], order_by: list[str] | None, pick) -> DataFrame:
    """One row per key, picked by ``order_by`` and then by the other columns."""
    rest = [c for c in batch.columns if c not in keys]
    order = list(order_by or [])
    order += [c for c in rest if c not in order and _orderable(batch.schema[c].dataType)]
    if not rest:
        return batch.distinct()
    if set(rest) <= set(order):
        # The order holds the whole row: one struct is shuffled instead of two.
        best = (F.min if pick is F.min_by else F.max)(F.struct(*order))
    else:
        best = pick(F.struct(*rest), F.struct(*order) if order else F.lit(0))
    picked = batch.groupBy(*keys).agg(best.alias("_row"))
    return picked.select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest]).select(*batch.columns)


def whole_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    return batch.dropna(subset=keys)


def broken_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a null in the key: it equals no other key, so such rows never clash."""
    return batch.where(any_null(keys))


def first_per_key(batch: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    return one_per_key(whole_keys(batch, keys), keys, order_by, F.min_by).union(broken_keys(batch, keys))


def last_per_key(batch: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    return one_per_key(whole_keys(batch, keys), keys, order_by, F.max_by).union(broken_keys(batch, keys))


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: list[str],
                     order_by: list[str] | None = None, prune_by: str | None = None) -> DataFrame:
    """The rows of ``batch`` to append to ``target``: the first of each key not yet there.

    The fold by key and the anti-join need the same partitioning, so the batch is shuffled
    once; rows with a broken key pass by. ``prune_by`` names a key column whose range in the
    batch, read first, limits the scan of the target: right for dates and large targets.
    """
    if prune_by:
        low, high = batch.agg(F.min(prune_by), F.max(prune_by)).first()
        target = target.where(F.col(prune_by).between(F.lit(low), F.lit(high)))
    first = one_per_key(whole_keys(batch, keys), keys, order_by, F.min_by)
    new = first.join(target.select(*keys), keys, "left_anti").select(*batch.columns)
    return new.union(broken_keys(batch, keys))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str],
           order_by: list[str] | None = None) -> DataFrame:
    """``target`` with the rows of ``batch`` in place of those of the same key; the last wins."""
    latest = last_per_key(batch, keys, order_by)
    return target.join(latest.select(*keys), keys, "left_anti").select(*target.columns) \
        .unionByName(latest.select(*target.columns))


def update_columns(target: DataFrame, patch: DataFrame, key: str, columns: list[str],
                   when: dict[str, str] | None = None, keep_existing: list[str] = ()) -> DataFrame:
    """``target`` with ``columns`` taken from ``patch`` where the (unique) key matches.

    ``when`` names, per column, a boolean column of the patch that has to hold; columns in
    ``keep_existing`` are filled only where the target holds null.
    """
    when = when or {}
    flags = sorted(set(when.values()))
    right = patch.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in columns],
                         *[F.col(f).alias(f"_if_{f}") for f in flags])
    joined = target.join(right, target[key] == right["_key"], "left")

    def updated(c: str) -> Column:
        if c not in columns:
            return F.col(c)
        hit = F.col("_key").isNotNull()
        if c in when:
            hit = hit & F.col(f"_if_{when[c]}")
        if c in keep_existing:
            hit = hit & F.col(c).isNull()
        return F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[updated(c) for c in target.columns])


def max_id(table: DataFrame, id_col: str) -> int:
    return table.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]


def with_surrogate_ids(df: DataFrame, current_max: int, order_by: list[str],
                       id_col: str = "id") -> DataFrame:
    """Dense ids after ``current_max`` in the order of ``order_by`` (which has to be unique).

    A range shuffle sorts the rows; the sorted copy is written once, and each row's id is
    the number of rows in the partitions before its own plus its place inside it. Only the
    table of partition sizes passes a single task; it has a row per partition and is
    broadcast, so the copy isn't shuffled for it.
    """
    rank = F.monotonically_increasing_id()
    sorted_copy = stage(df.orderBy(*order_by).withColumn("_at", rank), "ids")
    part = F.shiftright("_at", 33)
    sizes = sorted_copy.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = sorted_copy.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select((F.lit(current_max) + F.col("_offset") + place + 1).alias(id_col), *df.columns)
