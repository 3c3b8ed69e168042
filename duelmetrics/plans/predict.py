"""Predictions for upcoming matches from point-in-time ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.odds import best_odds, edge, implied, parse_odds
from ..functions.scoring import probability_pair
from ..operators.asof import asof_both_sides
from ..operators.elo import BASE_RATING


def predict(upcoming: DataFrame, log: DataFrame, side: str = "own", base: int = BASE_RATING) -> DataFrame:
    """Ratings and match counts strictly before the match day, win probabilities and edges.

    ``upcoming`` holds id, matchdate, player1, player2, odds (JSON text). ``side="first"``
    takes the logged rating of side 1 whichever side the player was on.
    """
    rated = asof_both_sides(upcoming, log, "matchdate", side)
    start = F.lit(float(base))
    rated = rated.withColumns({
        "player1_elo": F.coalesce(F.col("player1_elo").cast("double"), start),
        "player2_elo": F.coalesce(F.col("player2_elo").cast("double"), start),
        "_odds": parse_odds("odds"),
    })
    rated = probability_pair(rated, "player1_elo", "player2_elo")
    rated = rated.withColumns({"best_p1_odds": best_odds("_odds", "_P1"),
                               "best_p2_odds": best_odds("_odds", "_P2")})
    rated = rated.withColumns({"best_p1_implied_prob": implied("best_p1_odds"),
                               "best_p2_implied_prob": implied("best_p2_odds")})
    return rated.select(
        F.col("id").alias("match_id"), "matchdate", "player1", "player2",
        "player1_elo", "player2_elo",
        F.col("player1_match_count").cast("int").alias("player1_match_count"),
        F.col("player2_match_count").cast("int").alias("player2_match_count"),
        "predicted_p1_prob", "predicted_p2_prob",
        F.when(F.col("_odds").isNotNull(), F.col("odds")).otherwise(F.lit("{}")).alias("odds"),
        "best_p1_odds", "best_p1_implied_prob",
        edge("predicted_p1_prob", "best_p1_implied_prob").alias("value_p1"),
        "best_p2_odds", "best_p2_implied_prob",
        edge("predicted_p2_prob", "best_p2_implied_prob").alias("value_p2"))
