"""Null-safe conversions; nothing here raises, whatever the text holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that count as missing in a landed CSV file.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: Column | str, tokens=MISSING_TOKENS) -> Column:
    c = col(c)
    return F.when(~c.isin(*tokens), c)


# What a landed number looks like; keeps out NaN, hex and type suffixes such as ``1.5d``.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(c: Column | str) -> Column:
    """Text to double, null when it is no finite number."""
    text = col(c).cast("string")
    return F.when(F.regexp_like(text, F.lit(NUMBER_PATTERN)), text.try_cast("double"))


def safe_int(c: Column | str) -> Column:
    """Whole number; ``3.0`` and ``3.7`` give 3, text that is no number gives null."""
    return number(c).try_cast("int")


def safe_str(c: Column | str) -> Column:
    return F.trim(col(c))


def blank_str(c: Column | str) -> Column:
    """Missing becomes the empty string, then trimmed."""
    return F.trim(F.coalesce(col(c), F.lit("")))


def safe_date(c: Column | str) -> Column:
    return col(c).try_cast("date")


def number_or_zero(c: Column | str, kind: str = "double") -> Column:
    value = number(c) if kind == "double" else safe_int(c)
    return F.coalesce(value, F.lit(0).cast(kind))


def first_non_empty(*cols: Column | str) -> Column:
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols])


def parse_start_time(c: Column | str) -> Column:
    """Day-first start time, one or two digits: ``1.2.2025 9:05``."""
    return F.try_to_timestamp(F.trim(col(c)), F.lit("d.M.yyyy H:mm"))


def clock_of(ts: Column | str) -> Column:
    return F.date_format(col(ts), "HH:mm:ss")


def relative_day(as_of, days: int) -> Column:
    """The day ``days`` after (or, negative, before) ``as_of``."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.date_add(day.cast("date"), days)


def iso_day(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def from_epoch(c: Column | str) -> Column:
    return F.timestamp_seconds(col(c))


def any_null(names: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
