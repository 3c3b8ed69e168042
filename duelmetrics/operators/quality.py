"""Quality gate: clean rows, rejected rows with the reasons, and an audit row."""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Gate(NamedTuple):
    clean: DataFrame
    rejects: DataFrame
    audit: DataFrame


def _missing(name: str, blank_is_null: bool) -> Column:
    c = F.col(name)
    return c.isNull() | (F.trim(c.cast("string")) == "") if blank_is_null else c.isNull()


def failures(mandatory: list[str], blank_is_null: bool = False,
             rules: dict[str, Column] | None = None) -> Column:
    """Names of the failed checks of a row, an empty array when it is clean.

    ``rules`` are further conditions by name; one that is false or null fails.
    """
    checks = [(n, _missing(n, blank_is_null)) for n in mandatory]
    checks += [(n, ~F.coalesce(cond, F.lit(False))) for n, cond in (rules or {}).items()]
    names = F.array(*[F.when(failed, F.lit(n)) for n, failed in checks])
    # Most rows are clean, and a lambda per row is far slower than the checks themselves.
    return F.when(reduce(or_, [failed for _, failed in checks], F.lit(False)), F.filter(names, lambda n: n.isNotNull())) \
        .otherwise(F.array().cast("array<string>"))


def gate_counts(names: list[str]) -> list[Column]:
    """Rows read, rejected and clean, and those that failed each check, of rows with their ``failed`` checks."""
    bad = F.size("failed") > 0
    return [F.count(F.lit(1)).alias("rows_read"), F.count_if(bad).alias("rows_rejected"), F.count_if(~bad).alias("rows_clean"),
            *[F.count_if(F.array_contains("failed", n)).alias(f"failed_{n}") for n in names]]


def quality_gate(df: DataFrame, mandatory: list[str], blank_is_null: bool = False,
                 rules: dict[str, Column] | None = None) -> Gate:
    checked = df.withColumn("failed", failures(mandatory, blank_is_null, rules))
    bad = F.size("failed") > 0
    audit = checked.agg(*gate_counts([*mandatory, *(rules or {})]))
    return Gate(checked.where(~bad).drop("failed"), checked.where(bad), audit)


def two_player_rules(p1: str = "player1", p2: str = "player2", winner: str = "winner") -> dict[str, Column]:
    """A match needs two players, one of whom won."""
    return {
        "winner_is_a_player": F.col(winner).isin(F.col(p1), F.col(p2)),
        "two_players": F.col(p1) != F.col(p2),
    }


def length_rules(names: list[str], limit: int = 100) -> dict[str, Column]:
    """Texts have to fit the declared column width."""
    return {f"{n}_fits": F.coalesce(F.length(n) <= limit, F.lit(True)) for n in names}


def load_audit(read: DataFrame, attempted: DataFrame, inserted: DataFrame) -> DataFrame:
    """Rows read, rows attempted, rows inserted and rows skipped as one row."""
    def total(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")

    counts = total(read, "rows_read").unionByName(total(attempted, "rows_attempted")) \
        .unionByName(total(inserted, "rows_inserted"))
    wide = counts.groupBy().pivot("what", ["rows_read", "rows_attempted", "rows_inserted"]).agg(F.first("n"))
    return wide.withColumn("rows_skipped", F.col("rows_attempted") - F.col("rows_inserted"))
