"""Win probability and forecast scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .convert import col


def expected_score(a: Column | str, b: Column | str) -> Column:
    """Probability that the player rated ``a`` beats the one rated ``b``."""
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), (col(b) - col(a)) / F.lit(400.0)))


def probability_pair(df: DataFrame, a: str, b: str,
                     p1: str = "predicted_p1_prob", p2: str = "predicted_p2_prob") -> DataFrame:
    return df.withColumn(p1, expected_score(a, b)).withColumn(p2, F.lit(1.0) - F.col(p1))


def outcome(winner: Column | str, p1: Column | str, p2: Column | str) -> Column:
    """1 if side 1 won, 0 if side 2 won, null if the winner is neither."""
    w = col(winner)
    return F.when(w == col(p1), F.lit(1)).when(w == col(p2), F.lit(0))


def log_loss_winner(winner: Column | str, p1: Column | str, p2: Column | str,
                    prob1: Column | str, prob2: Column | str) -> Column:
    """-ln of the winner's probability, unclipped; null when that is zero or unknown."""
    w = col(winner)
    p = F.when(w == col(p1), F.when(col(prob1).isNotNull(), col(prob1))) \
         .when(w == col(p2), col(prob2))
    return F.when(p > 0, -F.ln(p))


def log_loss_clipped(p: Column | str, y: Column | str, eps: float = 1e-15) -> Column:
    def clip(x: Column) -> Column:
        return F.greatest(F.least(x, F.lit(1.0 - eps)), F.lit(eps))

    p, y = col(p), col(y)
    # greatest/least skip nulls, so a missing probability has to be kept out by hand.
    loss = -(y * F.ln(clip(p)) + (F.lit(1) - y) * F.ln(clip(F.lit(1.0) - p)))
    return F.when(p.isNotNull() & y.isNotNull(), loss)


def brier(p: Column | str, y: Column | str) -> Column:
    return F.pow(col(p) - col(y), F.lit(2))
