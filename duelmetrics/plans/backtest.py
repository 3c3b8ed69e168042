"""Scores of past predictions against results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.odds import implied
from ..functions.scoring import log_loss_winner


def past_only(df: DataFrame, as_of, date: str = "matchdate") -> DataFrame:
    """Rows dated before the moment ``as_of``; a row dated the same day counts."""
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.where(F.col(date).cast("timestamp") < moment.cast("timestamp"))


def backtest(predictions: DataFrame, results: DataFrame, as_of, id_col: str = "id") -> DataFrame:
    """One row per prediction with a result of the same (player1, player2, matchdate).

    The pair is ordered: a result with the sides swapped is another match.
    """
    keys = ["player1", "player2", "matchdate"]
    played = results.select(*keys, F.col("winner").alias("actual_winner"))
    joined = past_only(predictions, as_of).join(played, keys, "inner")
    return joined.select(
        F.col(id_col).alias("prediction_id"), "matchdate", "player1", "player2", "actual_winner",
        "player1_elo", "player2_elo", "player1_match_count", "player2_match_count",
        "predicted_p1_prob", "predicted_p2_prob", "best_p1_odds", "best_p2_odds",
        implied("best_p1_odds").alias("best_p1_implied_prob"),
        implied("best_p2_odds").alias("best_p2_implied_prob"),
        log_loss_winner("actual_winner", "player1", "player2",
                        "predicted_p1_prob", "predicted_p2_prob").alias("log_loss"))
