"""Connected components of links that are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _size(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link; the root is the smallest node of its component.

    Each round gives every node the smallest node among its neighbours, and hands the links on
    to that one, so a chain of length n is done after about log n rounds. A node's neighbours
    are only reduced to their minimum, which combines before the shuffle; they are never
    gathered. Each round is written to the shared folder, and the rounds end when a round
    changes no link.
    """
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links = stage(links, "links")
    seen = _size(links)
    while seen[0]:
        # Every node's larger neighbours, and itself, move to the smallest of its neighbourhood.
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        links = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Every node's smaller neighbours move to the smallest of them.
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stage(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _size(links)
        if now == seen:
            break
        seen = now
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
