"""Refresh of odds, model probabilities and scores in the odds table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.odds import best_odds, devig, implied, parse_odds
from ..functions.scoring import brier, expected_score, log_loss_clipped, outcome
from ..operators.elo import BASE_RATING
from ..operators.keyed import update_columns
from ..sources.tables import left_lookup

ODDS_COLUMNS = ["best_odd_player1", "win_prob_player1", "best_odd_player2", "win_prob_player2",
                "implied_margin", "norm_prob_player1", "norm_prob_player2"]
MODEL_COLUMNS = ["elo_prob_player1", "elo_prob_player2"]
SCORE_COLUMNS = ["brier_elo", "brier_bookmaker", "logloss_elo", "logloss_bookmaker"]


def odds_patch(upcoming: DataFrame, rankings: DataFrame, base: int = BASE_RATING) -> DataFrame:
    """New values per id, for the rows whose odds are a non-empty JSON object.

    Model probabilities come from the current ratings; ``fresh`` tells that none is stored
    yet and ``scored`` that the winner is one of the players and both sides have odds.
    """
    df = upcoming.select("id", "player1", "player2", "winner", "odds",
                         F.col("elo_prob_player1").isNull().alias("fresh"))
    df = df.withColumn("_odds", parse_odds("odds")).where(F.size("_odds") > 0)
    df = df.withColumns({"best_odd_player1": best_odds("_odds", "_P1"),
                         "best_odd_player2": best_odds("_odds", "_P2")})
    df = df.withColumns({"win_prob_player1": implied("best_odd_player1"),
                         "win_prob_player2": implied("best_odd_player2")})
    df = devig(df, "win_prob_player1", "win_prob_player2")
    df = left_lookup(df, rankings, "player1", "player", "elo", "_e1", default=base)
    df = left_lookup(df, rankings, "player2", "player", "elo", "_e2", default=base)
    df = df.withColumn("elo_prob_player1", expected_score("_e1", "_e2"))
    df = df.withColumn("elo_prob_player2", F.lit(1.0) - F.col("elo_prob_player1"))
    df = df.withColumn("_y", outcome("winner", "player1", "player2"))
    known = F.col("_y").isNotNull() & F.col("norm_prob_player1").isNotNull()
    return df.select(
        "id", "fresh", F.coalesce(known, F.lit(False)).alias("scored"), *ODDS_COLUMNS, *MODEL_COLUMNS,
        brier("elo_prob_player1", "_y").alias("brier_elo"),
        brier("norm_prob_player1", "_y").alias("brier_bookmaker"),
        log_loss_clipped("elo_prob_player1", "_y").alias("logloss_elo"),
        log_loss_clipped("norm_prob_player1", "_y").alias("logloss_bookmaker"))


def refresh_odds_scores(upcoming: DataFrame, rankings: DataFrame, base: int = BASE_RATING) -> DataFrame:
    """``upcoming`` updated by :func:`odds_patch`.

    A stored model probability is kept, scores change only for scored rows, and rows with
    unreadable odds stay as they are.
    """
    when = {**{c: "fresh" for c in MODEL_COLUMNS}, **{c: "scored" for c in SCORE_COLUMNS}}
    return update_columns(upcoming, odds_patch(upcoming, rankings, base), "id",
                          ODDS_COLUMNS + MODEL_COLUMNS + SCORE_COLUMNS, when=when)
