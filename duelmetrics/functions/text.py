"""Symbols in text, slugs and id cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .convert import col

# What counts as a symbol, and words that look like one but are none.
SYMBOL_PATTERN = r"\$?[A-Z]{2,5}"
SYMBOL_BLACKLIST = ("WSB", "DD", "YOLO", "ETF", "LOL")


def extract_symbols(text: Column | str, pattern: str = SYMBOL_PATTERN,
                    blacklist=SYMBOL_BLACKLIST, strip_first: bool = False) -> Column:
    """All hits in order, duplicates kept.

    The blacklist is compared before the ``$`` is dropped, so ``$YOLO`` stays;
    ``strip_first=True`` drops it first.
    """
    hits = F.regexp_extract_all(col(text), F.lit(pattern), F.lit(0))

    def strip(hit: Column) -> Column:
        return F.replace(hit, F.lit("$"), F.lit(""))

    if strip_first:
        hits = F.transform(hits, strip)
    if blacklist:
        hits = F.filter(hits, lambda hit: ~hit.isin(*blacklist))
    return hits if strip_first else F.transform(hits, strip)


def slug(c: Column | str) -> Column:
    """File-name form of a label: blanks to ``_``, colons and brackets dropped."""
    return F.translate(col(c), " :()", "_")


def clean_element_id(c: Column | str) -> Column:
    """Drop the four-character prefix and any underscores that follow it."""
    return F.ltrim(F.substring(col(c), 5, 2147483647), F.lit("_"))


def dash_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(col(c)), F.lit("-"))
