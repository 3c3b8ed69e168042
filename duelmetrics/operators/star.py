"""Star-schema load of price snapshots: markets, items, prices."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.convert import first_non_empty, number_or_zero
from ..schemas import MARKETS
from ..session import stage
from .keyed import insert_if_absent, max_id, with_surrogate_ids

# Per kind of listing, the fields of price and volume and the sales fee.
PAGED_FIELDS = {"price": "sell_min_price", "volume": "sell_num"}
PAGED_FEE = 0.02
FLAT_FIELDS = {"price": "min_price", "volume": "quantity"}
FLAT_FEE = 0.12


class Star(NamedTuple):
    markets: DataFrame
    items: DataFrame
    prices: DataFrame


def named_prices(items: DataFrame, fields: dict[str, str], keep: list[str] = ()) -> DataFrame:
    """(name, price, volume) of each listed item; without a usable name the item is skipped."""
    return items.select(
        *keep,
        first_non_empty("market_hash_name", "name").alias("name"),
        number_or_zero(fields["price"]).alias("price"),
        number_or_zero(fields["volume"], "int").alias("volume"),
    ).where(F.col("name").isNotNull())


def add_market(markets: DataFrame, market: str, fee: float) -> tuple[DataFrame, int]:
    """``markets`` with ``market`` in it, and the id of that; a known one keeps its fee."""
    known = markets.where(F.col("name") == market).select("id").first()
    if known:
        return markets, known["id"]
    new_id = max_id(markets, "id") + 1
    row = markets.sparkSession.createDataFrame([(new_id, market, float(fee))], MARKETS)
    return markets.unionByName(row), new_id


def new_names(dimension: DataFrame, batch: DataFrame, id_col: str = "id") -> DataFrame:
    """The names of ``batch`` that ``dimension`` lacks, numbered after its highest id in name order."""
    new = insert_if_absent(dimension, batch, ["name"])
    numbered = with_surrogate_ids(new, max_id(dimension, id_col), ["name"], id_col)
    return numbered.select(*dimension.columns)


def resolve_prices(rows: DataFrame, items: DataFrame, market_id: int) -> DataFrame:
    """Fact rows of one market, with the item looked up by its (unique) name."""
    i = items.select(F.col("id").alias("item_id"), F.col("name").alias("item_name"))
    return rows.join(i, rows["name"] == i["item_name"], "left") \
        .select("item_id", F.lit(market_id).cast("bigint").alias("market_id"), "price", "volume")


def load_star(markets: DataFrame, items: DataFrame, listing: DataFrame, fields: dict[str, str],
              market: str, fee: float) -> Star:
    """One snapshot of one market: all markets, and the items and price rows to append.

    Dimensions keep the first row of a name; an item listed twice gives two price rows. The
    listing is parsed once.
    """
    rows = stage(named_prices(listing, fields), "listed")
    all_markets, market_id = add_market(markets, market, fee)
    added = stage(new_names(items, rows.select("name")), "new-items")
    return Star(all_markets, added, resolve_prices(rows, items.unionByName(added), market_id))
