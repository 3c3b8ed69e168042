"""Table schemas (created on first use) and the column maps of the landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
_DATE, _TS = T.DateType(), T.TimestampType()

RESULTS_STAGED = _schema(
    ("id", _L), ("matchdate", _DATE), ("player1", _S), ("player2", _S),
    ("player1score", _I), ("player2score", _I), ("winner", _S), ("pool", _S),
)
# Where a staged row came from: the order in which rows landed decides who was first.
SOURCE_FIELDS = _schema(("source_file", _S), ("source_start", _L)).fields
# What a row held when it landed: kept with the rejects.
LANDED_FIELDS = _schema(("raw", _S), ("cells_fit", T.BooleanType())).fields
RESULTS_GOLD = _schema(
    ("match_id", _L), ("matchdate", _DATE), ("player1", _S), ("player2", _S),
    ("player1score", _I), ("player2score", _I), ("winner", _S), ("pool", _S),
)
UPCOMING = _schema(
    ("id", _L), ("matchdate", _DATE), ("player1", _S), ("player2", _S), ("odds", _S),
)
RANKINGS = _schema(("player", _S), ("elo", _I))
RATING_LOG = _schema(
    ("match_id", _L), ("player1", _S), ("player2", _S),
    ("player1_elo_before", _I), ("player2_elo_before", _I),
    ("player1_elo_after", _I), ("player2_elo_after", _I),
    ("elo_change_p1", _I), ("elo_change_p2", _I),
    ("winner", _S), ("match_date", _TS),
)
PREDICTIONS = _schema(
    ("id", _L), ("match_id", _L), ("matchdate", _DATE), ("player1", _S), ("player2", _S),
    ("player1_elo", _D), ("player2_elo", _D),
    ("player1_match_count", _I), ("player2_match_count", _I),
    ("predicted_p1_prob", _D), ("predicted_p2_prob", _D), ("odds", _S),
    ("best_p1_odds", _D), ("best_p1_implied_prob", _D), ("value_p1", _D),
    ("best_p2_odds", _D), ("best_p2_implied_prob", _D), ("value_p2", _D),
    ("created_at", _TS),
)
BACKTEST_LOG = _schema(
    ("id", _L), ("prediction_id", _L), ("matchdate", _DATE), ("player1", _S), ("player2", _S),
    ("actual_winner", _S), ("player1_elo", _D), ("player2_elo", _D),
    ("player1_match_count", _I), ("player2_match_count", _I),
    ("predicted_p1_prob", _D), ("predicted_p2_prob", _D),
    ("best_p1_odds", _D), ("best_p2_odds", _D),
    ("best_p1_implied_prob", _D), ("best_p2_implied_prob", _D),
    ("log_loss", _D), ("run_timestamp", _TS),
)
ODDS_SCORES = _schema(
    ("id", _L), ("player1", _S), ("player2", _S), ("odds", _S), ("winner", _S),
    ("best_odd_player1", _D), ("win_prob_player1", _D),
    ("best_odd_player2", _D), ("win_prob_player2", _D),
    ("implied_margin", _D), ("norm_prob_player1", _D), ("norm_prob_player2", _D),
    ("elo_prob_player1", _D), ("elo_prob_player2", _D),
    ("brier_elo", _D), ("brier_bookmaker", _D), ("logloss_elo", _D), ("logloss_bookmaker", _D),
)
MARKETS = _schema(("id", _L), ("name", _S), ("fee_percent", _D))
ITEMS = _schema(("id", _L), ("name", _S))
PRICES = _schema(("item_id", _L), ("market_id", _L), ("price", _D), ("volume", _I))

PAGED_LISTING = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("page_num", T.IntegerType()),
        T.StructField("total_page", T.IntegerType()),
        T.StructField("items", T.ArrayType(_schema(
            ("market_hash_name", _S), ("name", _S), ("sell_min_price", _S), ("sell_num", _S),
        ))),
    ])),
    T.StructField("msg", _S),
])
FLAT_LISTING = _schema(
    ("market_hash_name", _S), ("name", _S), ("min_price", _S), ("quantity", _S),
)

# The headers of landed files.
# Landed results files: target column -> header of the file.
RESULTS_CSV = {
    "matchdate": "Date",
    "player1": "Player 1",
    "player2": "Player 2",
    "player1score": "Player 1 Score",
    "player2score": "Player 2 Score",
    "winner": "Winner",
}
# Landed odds files: target column -> header; every other header is an odds column.
UPCOMING_CSV = {"matchdate": "Date", "player1": "Player 1", "player2": "Player 2"}

RESULTS_MANDATORY = ["matchdate", "player1", "player2", "player1score", "player2score", "winner"]
UPCOMING_MANDATORY = ["matchdate", "player1", "player2"]


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, and the optimizer knows it: a join with an empty table moves nothing."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).limit(0)
