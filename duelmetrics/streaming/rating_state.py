"""Ratings as the state of a stream: a map of players per pool, kept by the stream itself.

A batch reads neither the log nor the rankings. It sorts its matches of a pool, fetches the
ratings of the players who meet, and puts back the new ones, so its cost follows the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.elo import BASE_RATING, K_FACTOR, RATED, match_rows

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class PoolRatings(StatefulProcessor):
    """Rates the matches of one pool that a batch brings, in order of date and id."""

    def __init__(self, pool_col: str, columns: list[str], k: float, base: int) -> None:
        self.pool_col, self.columns, self.k, self.base = pool_col, columns, k, base

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ratings = handle.getMapState("ratings", "player string", "elo int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Plain rows: most groups are small, and a frame for each would cost more than its matches.
        batch = sorted(rows, key=lambda r: [(False,) if v is None else (True, v) for v in (r.match_date, r.match_id)])
        held: dict[str, int] = {}
        changed: set[str] = set()

        def rating(player: str) -> int:
            if player not in held:
                known = self.ratings.getValue((player,))
                held[player] = self.base if known is None else known[0]
            return held[player]

        for row in batch:
            one, two = row.player1, row.player2
            before = rating(one), rating(two)
            side = 1 if row.winner == one else -1
            gap = side * (before[1] - before[0])
            change = side * round(self.k * (1 - 1 / (1 + 10 ** (gap / 400))))
            held[one], held[two] = before[0] + change, before[1] - change
            changed.update((one, two))
            shown = {**row.asDict(), **dict(zip(RATED, (*before, held[one], held[two], change, -change))), self.pool_col: key[0]}
            yield Row(**{name: shown[name] for name in self.columns})
        for player in changed:
            self.ratings.updateValue((player,), (held[player],))

    def close(self) -> None:
        pass


def stream_state_ratings(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, out: str,
                         to_matches: Callable[[DataFrame], DataFrame], pool_col: str, format: str = "parquet",
                         glob: str | None = None, max_files: int | None = None, k: float = K_FACTOR,
                         base: int = BASE_RATING, date: str = "matchdate", **options) -> DataFrame:
    """Rate the files of ``path`` not yet seen, append to the log at ``out`` and return that log.

    The checkpoint holds the files seen and every pool's ratings; a run that starts with it again
    goes on where the last one ended, and the file sink commits each batch once. Matches with a winner
    who is neither player, or one player on both sides, are left out. The log equals one batch run if files
    land in date order; a match that lands late is rated after those already rated.
    """
    reader = spark.readStream.schema(schema).format(format).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = match_rows(to_matches(reader.load(path)), pool_col, "reject", date)
    fields = {f.name: f for f in rows.schema.fields}
    shown = ["match_id", "player1", "player2", *RATED, "winner", "match_date", pool_col]
    result = T.StructType([T.StructField(n, fields[n].dataType if n in fields else T.IntegerType()) for n in shown])
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # the only store with several variables per key
    try:
        rated = rows.groupBy(F.col(pool_col)).transformWithState(
            PoolRatings(pool_col, shown, k, base), result, "append", "none")
        rated.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint) \
            .outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    return spark.read.schema(result).parquet(out)
