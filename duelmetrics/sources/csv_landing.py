"""CSV landing folders whose files do not share one header.

All files are read in one scan as numbered text columns; each file's own header, its first line
in a scan as plain text, then names the values of its rows. One plan serves any number of
different headers; up to ``LAYOUTS`` of them are written into it, more are looked up row by row. A record is one line: line breaks inside quotes would keep
Spark from splitting a large file. Only the first line of a file is its header: one that
comes again is a row like any other, for the quality gate to judge. A row with more values
than its header has names is kept, marked, with its text.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.convert import MISSING_TOKENS, col, missing_to_null
from ..session import stage


# Columns that tell where a row came from; in this order they sort rows as they landed. Then
# the row's text, and whether its values fit the names of the header.
SOURCE = ["source_file", "source_start", "source_row", "raw", "cells_fit"]
# The same with the parts of the text, for loads that need the text of few rows (``landed_text``).
SOURCE_PARTS = ["source_file", "source_start", "source_row", "landed", "cells_fit"]


#: Up to so many different headers, with so many names in all, have the values of their rows picked by plain expressions.
LAYOUTS, LAYOUT_CELLS = 16, 500

#: A value with the comma before it: quoted text, with quotes doubled, or text up to the next comma.
_CELL = r',(?:"(?:[^"]++|"")*+")?[^,]*+'


def header_names(line: Column) -> Column:
    """The names in a header line; one that comes again gets a number, so that a row can become a map."""
    cells = F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(0)), lambda c: F.regexp_replace(c, "^,", ""))
    quoted = r'(?s)^"((?:[^"]++|"")*+)"(.*)$'
    plain = F.transform(cells, lambda c: F.when(c.rlike(quoted), F.concat(
        F.replace(F.regexp_extract(c, quoted, 1), F.lit('""'), F.lit('"')), F.regexp_extract(c, quoted, 2))).otherwise(c))

    def numbered(name: Column, at: Column) -> Column:
        again = F.size(F.filter(F.slice(plain, F.lit(1), at), lambda n: n == name))
        return F.when(again > 0, F.concat(name, F.lit("."), again.cast("string"))).otherwise(name)

    return F.transform(plain, numbered)


def landed_headers(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(path, header) of every non-empty file: its first line that is not blank, read as text.

    Only Spark's own reader opens files, so any store it reads will do. Each task keeps one line per file.
    """
    lines = spark.read.option("pathGlobFilter", glob).text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    lines = lines.where((F.col("start") == 0) & (F.trim("value") != ""))
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("line"))
    return first.select("path", header_names(F.regexp_replace("line", "^\ufeff", "")).alias("header"))


def landed_text(landed: Column | str = "landed") -> Column:
    """A row's text as it landed: kept by the reader if the row has another width, else put together from its cells."""
    landed = col(landed)
    return F.coalesce(landed["text"], F.to_csv(landed["cells"], {"escape": '"'}))


def read_named_cells(spark: SparkSession, path: str, columns: dict[str, str], glob: str = "*.csv",
                     missing_tokens=MISSING_TOKENS) -> DataFrame:
    """The chosen columns of each data row, and the values of all others that have one as the map ``others``.

    Also adds where a row came from: ``source_file``, ``source_start`` and the increasing
    ``source_row``; the parts of its text as ``landed``; and ``cells_fit``, false for a row that holds a value
    beyond the last name of its header. Missing values are null.
    """
    headers = stage(landed_headers(spark, path, glob), "headers")
    width = headers.agg(F.max(F.size("header"))).first()[0] or 1
    names = [f"c{i}" for i in range(width)]
    # Spark skips the first line of each file; rows of another width come with their text.
    lines = spark.read.schema(", ".join(f"{n} string" for n in [*names, "_text"])) \
        .option("columnNameOfCorruptRecord", "_text").option("mode", "PERMISSIVE") \
        .option("pathGlobFilter", glob).option("header", True) \
        .option("quote", '"').option("escape", '"').csv(path) \
        .select(*names, "_text", F.col("_metadata.file_path").alias("source_file"),
                F.col("_metadata.file_block_start").alias("source_start"),
                F.monotonically_increasing_id().alias("source_row"))
    layouts = [r["header"] for r in headers.select("header").distinct().limit(LAYOUTS + 1).collect()]
    cells = [missing_to_null(n, missing_tokens) for n in names]
    if len(layouts) <= LAYOUTS and sum(map(len, layouts)) <= LAYOUT_CELLS:
        named, size, values, others = _by_layout(lines, headers, layouts, columns, cells)
    else:
        named, size, values, others = _by_place(lines, headers, columns, cells)
    # The place of the last value; plain expressions, for a lambda per row and cell is far slower.
    last = F.coalesce(*[F.when(F.col(n).isNotNull(), i) for i, n in reversed([*enumerate(names, 1)])], F.lit(0))
    # Commas outside quotes, but for those that only end the line.
    bare = F.regexp_replace(F.regexp_replace("_text", '"[^"]*"', ""), r"[,\s]+$", "")
    beyond = (last > size) | F.coalesce(F.size(F.split(bare, ",")) > width, F.lit(False))
    return named.select(*[v.alias(n) for v, n in zip(values, columns)], others.alias("others"),
                        "source_file", "source_start", "source_row",
                        F.struct(F.col("_text").alias("text"), F.struct(*names).alias("cells")).alias("landed"),
                        (~beyond).alias("cells_fit"))


def _valued(names: Column, values: Column, full: Column) -> Column:
    """A map of the names that have a value; ``full`` tells that all have, so that most rows need no lambda."""
    whole = F.map_from_arrays(names, values)
    return F.when(full, whole).otherwise(F.map_filter(whole, lambda k, v: v.isNotNull()))


def _by_layout(lines: DataFrame, headers: DataFrame, layouts: list[list[str]], columns: dict[str, str],
               cells: list[Column]) -> tuple[DataFrame, Column, list[Column], Column]:
    """Rows with the number of their file's header, and by it: its size, the chosen columns and the map of the others."""
    number = F.coalesce(*[F.when(F.col("header") == F.array(*map(F.lit, h)), i) for i, h in enumerate(layouts)]) if layouts else F.lit(0)
    heads = headers.select(F.col("path").alias("head_path"), number.alias("layout"))

    def by_layout(of: list[Column], same: bool = False) -> Column:
        if same or len(of) == 1:
            return of[0]
        return F.coalesce(*[F.when(F.col("layout") == i, c) for i, c in enumerate(of)])

    def chosen(name: str) -> Column:
        at = [h.index(name) if name in h else None for h in layouts] or [None]
        return by_layout([F.lit(None).cast("string") if i is None else cells[i] for i in at], len(set(at)) == 1)

    def others(header: list[str]) -> Column:
        left = [(n, cells[i]) for i, n in enumerate(header) if n not in columns.values()]
        return _valued(F.array(*[F.lit(n) for n, _ in left]).cast("array<string>"), F.array(*[c for _, c in left]).cast("array<string>"),
                       reduce(and_, [c.isNotNull() for _, c in left], F.lit(True)))

    return (lines.join(heads, lines["source_file"] == heads["head_path"]), by_layout([F.lit(len(h)) for h in layouts] or [F.lit(0)]),
            [chosen(h) for h in columns.values()], by_layout([others(h) for h in layouts or [[]]]))


def _by_place(lines: DataFrame, headers: DataFrame, columns: dict[str, str],
              cells: list[Column]) -> tuple[DataFrame, Column, list[Column], Column]:
    """The same for any number of headers: places are looked up once per file, and each row's values by them."""
    # A column the file lacks has no place.
    places = [F.nullif(F.array_position("header", F.lit(h)), F.lit(0).cast("bigint")).cast("int")
              for h in columns.values()]
    left = F.filter("header", lambda n: ~n.isin(*columns.values()))
    heads = headers.withColumn("left_names", left).select(
        F.col("path").alias("head_path"), F.size("header").alias("head_size"), F.array(*places).alias("places"), "left_names",
        F.transform("left_names", lambda n: F.array_position("header", n).cast("int")).alias("left_places"))
    named = lines.join(heads, lines["source_file"] == heads["head_path"]).withColumn("cells", F.array(*cells))
    named = named.withColumn("left_values", F.transform("left_places", lambda at: F.get("cells", at - 1)))
    # Looking for any value tells whether there is a null among them.
    full = ~F.coalesce(F.array_contains("left_values", F.lit("")), F.lit(True))
    return (named, F.col("head_size"), [F.get("cells", F.get("places", F.lit(i)) - 1) for i in range(len(places))],
            _valued(F.col("left_names"), F.col("left_values"), full))


def _source(with_source: bool | str) -> list[Column]:
    if with_source == "parts":
        return [F.col(c) for c in SOURCE_PARTS]
    return [landed_text().alias(c) if c == "raw" else F.col(c) for c in SOURCE] if with_source else []


def read_csv_landing(spark: SparkSession, path: str, columns: dict[str, str],
                     missing_tokens=MISSING_TOKENS, with_source: bool | str = False) -> DataFrame:
    """Chosen columns as text; ``columns`` maps the output name to the header.

    A column a file lacks is null; columns not named are not carried on. ``with_source`` adds the columns ``SOURCE``,
    or with "parts" ``SOURCE_PARTS``.
    """
    rows = read_named_cells(spark, path, columns, missing_tokens=missing_tokens)
    return rows.select(*columns, *_source(with_source))


def read_csv_wide(spark: SparkSession, path: str, key_columns: dict[str, str],
                  map_name: str = "odds", missing_tokens=MISSING_TOKENS,
                  with_source: bool | str = False) -> DataFrame:
    """Key columns as text, and all other non-empty columns of the file as one map."""
    rows = read_named_cells(spark, path, key_columns, missing_tokens=missing_tokens)
    return rows.select(*key_columns, F.col("others").alias(map_name), *_source(with_source))
