"""Bookmaker odds as VARIANT: what a value is decides how it is read.

A map of strings can't tell a quoted number from a nested object's text. Here numbers and quoted numbers
count as they are, the members of an object and the places of a list become odds of their own,
and truth values, nulls and deeper nesting count as nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .convert import col, number


def parse_odds_variant(c: Column | str) -> Column:
    """JSON object text as a variant; anything but an object gives null, as do texts with a name twice."""
    parsed = F.try_parse_json(col(c))
    return F.when(kind_of(parsed) == "object", parsed)


def kind_of(v: Column | str) -> Column:
    """object, array, text, number, boolean or null (no value); other types by their own name."""
    name = F.lower(F.regexp_extract(F.schema_of_variant(col(v)), "^[A-Z]+", 0))
    return F.when(name == "string", "text").when(name.isin("bigint", "decimal", "double", "float"), "number") \
        .when(name == "void", "null").otherwise(name)


def price_of(v: Column | str) -> Column:
    """A number, or a text that is one, as double; null for all else."""
    v = col(v)
    return F.when(kind_of(v) == "number", F.try_variant_get(v, "$", "double")) \
        .when(kind_of(v) == "text", number(F.try_variant_get(v, "$", "string")))


def named_prices(v: Column | str) -> Column:
    """``array<struct<name, price>>`` of all readable prices, unsorted.

    ``{"a_P1": 2, "b": {"P1": 3}, "c": [4, 5]}`` gives a_P1, b_P1, c_P1 and c_P2.
    """
    members = F.map_entries(F.try_variant_get(col(v), "$", "map<string,variant>"))

    def read(m: Column) -> Column:
        one = F.array(F.struct(m["key"].alias("name"), price_of(m["value"]).alias("price")))
        inner = F.transform(F.map_entries(F.try_variant_get(m["value"], "$", "map<string,variant>")), lambda x: F.struct(
            F.concat_ws("_", m["key"], x["key"]).alias("name"), price_of(x["value"]).alias("price")))
        placed = F.transform(F.try_variant_get(m["value"], "$", "array<variant>"), lambda x, i: F.struct(
            F.concat(m["key"], F.lit("_P"), (i + 1).cast("string")).alias("name"), price_of(x).alias("price")))
        return F.when(kind_of(m["value"]) == "object", inner).when(kind_of(m["value"]) == "array", placed).otherwise(one)

    return F.filter(F.flatten(F.transform(members, read)), lambda p: p["price"].isNotNull())


def best_price(prices: Column | str, suffix: str) -> Column:
    """Largest price whose name contains ``suffix``; null if there is none."""
    side = F.filter(col(prices), lambda p: F.contains(p["name"], F.lit(suffix)))
    return F.array_max(F.transform(side, lambda p: p["price"]))
