"""Whole jobs over a warehouse folder: landed files to gold, ratings, predictions, scores.

Each job reads committed versions, commits one new version and returns what it did as a
DataFrame. ``run_ts`` is a parameter, so a run can be repeated exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.convert import any_null, blank_str, iso_day, relative_day, safe_date, safe_int, safe_str
from ..functions.odds import odds_to_json
from ..functions.text import slug
from ..operators.elo import elo_log
from ..operators.keyed import insert_if_absent, one_per_key, with_surrogate_ids
from ..operators.quality import failures, gate_counts, two_player_rules
from ..operators.ranking import latest_ratings, register_entities, unprocessed, without
from ..operators.reshape import blocks_to_odds_map, map_to_wide
from ..operators.star import Star, load_star
from ..session import stage, temporary_stages
from ..sources import tables
from ..sources.csv_landing import SOURCE_PARTS, landed_text, read_csv_landing, read_csv_wide
from ..sources.pages import extract_match_pages, extract_odds_blocks
from ..sources.sinks import write_dated_csv, write_labelled_csv
from . import rating_store
from .backtest import backtest
from .predict import predict
from .refresh import refresh_odds_scores


_FAILED = T.StructField("failed", T.ArrayType(T.StringType()))


def typed_results(landed: DataFrame, keep: list[str] = (), pool: Column | None = None) -> DataFrame:
    """Landed texts to the column types of the results tables; ``pool`` is null if not given."""
    return landed.select(
        *keep, safe_date("matchdate").alias("matchdate"),
        safe_str("player1").alias("player1"), safe_str("player2").alias("player2"),
        safe_int("player1score").alias("player1score"), safe_int("player2score").alias("player2score"),
        safe_str("winner").alias("winner"), (F.lit(None) if pool is None else pool).cast("string").alias("pool"))


def typed_upcoming(landed: DataFrame, keep: list[str] = ()) -> DataFrame:
    return landed.select(
        *keep, safe_date("matchdate").alias("matchdate"),
        blank_str("player1").alias("player1"), blank_str("player2").alias("player2"),
        odds_to_json("odds").alias("odds"))


def _publish(spark: SparkSession, root: str, batch: DataFrame, keys: list[str], order: list[str],
             id_col: str, schema: T.StructType, ids_by: list[str], between: tuple[str, object, object] | None = None,
             wide: bool = False, rows_of: DataFrame | None = None) -> DataFrame:
    """Append the rows of ``batch`` whose key the table lacks, numbered from its highest id.

    ``between`` (a key column and its least and greatest value in the batch) limits the scan of the table.
    ``wide`` rows stay where the fold by key put them: only their keys are sorted and numbered (``ids_by`` are
    key columns then), and where no key comes twice there is no fold. ``rows_of`` holds the keys of the batch's rows,
    each as often as there, where they are cheaper to have than the batch.
    """
    target = tables.read_all(spark, root, "rows", schema)
    rest = [c for c in schema.names if c != id_col]
    if between:
        name, low, high = between
        target = target.where(F.col(name).between(F.lit(low), F.lit(high)))
    with temporary_stages(spark):
        newest = tables.newest_max(spark, root, "rows", schema, id_col)
        if wide:
            held = batch if rows_of is None else rows_of
            held = stage(held.groupBy(*keys).agg((F.count(F.lit(1)) > 1).alias("_again")), "keys")
            broken, again = held.agg(F.coalesce(F.bool_or(any_null(keys)), F.lit(False)), F.coalesce(F.bool_or("_again"), F.lit(False))).first()
        if wide and not broken:
            ids = with_surrogate_ids(held.select(*keys).join(target.select(*keys), keys, "left_anti"), newest, ids_by, id_col)
            first = (one_per_key(batch, keys, order, F.min_by) if again else batch).select(*rest)
            numbered = schemas.empty(spark, schema) if ids.isEmpty() else first.join(ids, keys)
        else:
            # A row with a null in its key has no key to carry its id.
            new = insert_if_absent(target, batch, keys, order).select(*rest)
            numbered = with_surrogate_ids(new, newest, ids_by, id_col)
        version = tables.commit_version(spark, root, {"rows": numbered.select(*schema.names)})
    return spark.read.schema(schema).parquet(f"{root}/v{version}/rows")


def _job_row(audit: DataFrame, inserted: DataFrame, attempted: str = "rows_clean") -> DataFrame:
    """The gate's audit row with the number of rows published and skipped."""
    return audit.withColumn("rows_inserted", F.lit(inserted.count()).cast("bigint")) \
        .withColumn("rows_skipped", F.col(attempted) - F.col("rows_inserted"))


def _staged(spark: SparkSession, warehouse: str, name: str, schema: T.StructType, accepted: bool) -> DataFrame:
    root = f"{warehouse}/{name}_staged"
    done = tables.versions(spark, root)
    paths = [f"{root}/v{done[-1]}/rows/accepted={str(accepted).lower()}"] if done else []
    return tables.read_parts(spark, paths, schema)


def _load(spark: SparkSession, warehouse: str, name: str, typed: DataFrame, schema: T.StructType,
          mandatory: list[str], rules: dict, blank_is_null: bool, gold_id: str,
          gold_schema: T.StructType) -> DataFrame:
    """One pass reads the landed rows, checks and writes them, clean and rejected ones apart; clean new ones are published."""
    # Staged ids only have to be unique and to grow inside a file, so nothing is sorted.
    rules = {**rules, "cells_fit": F.col("cells_fit")}
    checked = typed.withColumn("id", F.col("source_row") + 1).withColumn("failed", failures(mandatory, blank_is_null, rules))
    accepted = F.size("failed") == 0
    # Only rejects keep their text, so it is put together for them alone.
    landed = checked.select(*schema.names, *[f.name for f in schemas.SOURCE_FIELDS], F.when(~accepted, landed_text()).alias("raw"),
                            "cells_fit", "failed", accepted.alias("accepted"))
    root = f"{warehouse}/{name}_staged"
    version = tables.commit_version(spark, root, {"rows": landed}, partition_by={"rows": ["accepted"]},
                                    emptied={"rows": ["accepted=true", "accepted=false"]}, plain=["source_file"])
    tables.expire_versions(spark, root, 2)
    # Counted in what was written, a column or two of it: metrics observed in passing cost every row far more.
    written = f"{root}/v{version}/rows/accepted="
    clean = spark.read.schema(T.StructType(schema.fields + schemas.SOURCE_FIELDS)).parquet(f"{written}true")
    rejects = spark.read.schema(T.StructType([_FAILED])).parquet(f"{written}false")
    counts = rejects.agg(*gate_counts([*mandatory, *rules])).first().asDict()
    clean_rows, first, last = clean.agg(F.count(F.lit(1)), F.min("matchdate"), F.max("matchdate")).first()
    counts |= {"rows_read": counts["rows_rejected"] + clean_rows, "rows_clean": clean_rows}
    inserted = _publish(spark, f"{warehouse}/{name}_gold", clean, ["player1", "player2", "matchdate"],
                        ["source_file", "source_start", "id"], gold_id, gold_schema,
                        ["matchdate", "player1", "player2"], between=("matchdate", first, last), wide=True)
    audit = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{n} long" for n in counts))
    return _job_row(audit, inserted)


def job_results_load(spark: SparkSession, landing: str, warehouse: str,
                     reject_odd_winners: bool = True, pool: Column | None = None) -> DataFrame:
    """Landed results to staged rows and gold. First writer of a match wins.

    ``pool`` tells which closed group of players a row belongs to, from the landed columns or
    ``source_file``. Ratings run pool by pool; without it all matches are one pool.
    """
    with temporary_stages(spark):
        landed = read_csv_landing(spark, landing, schemas.RESULTS_CSV, with_source="parts")
        return _load(spark, warehouse, "results", typed_results(landed, SOURCE_PARTS, pool),
                     schemas.RESULTS_STAGED, schemas.RESULTS_MANDATORY,
                     two_player_rules() if reject_odd_winners else {}, False,
                     "match_id", schemas.RESULTS_GOLD)


def read_rejects(spark: SparkSession, warehouse: str, name: str, schema: T.StructType) -> DataFrame:
    """The rows that the last load of ``name`` kept back: typed, as text, and the checks failed."""
    fields = [*schema.fields, *schemas.SOURCE_FIELDS, *schemas.LANDED_FIELDS, _FAILED]
    return _staged(spark, warehouse, name, T.StructType(fields), accepted=False)


def read_clean(spark: SparkSession, warehouse: str, name: str, schema: T.StructType) -> DataFrame:
    """The rows that the last load of ``name`` let through, published or known before."""
    return _staged(spark, warehouse, name, T.StructType(schema.fields + schemas.SOURCE_FIELDS), accepted=True)


def job_upcoming_load(spark: SparkSession, landing: str, warehouse: str,
                      blank_is_null: bool = False) -> DataFrame:
    """Landed odds files to staged rows and gold. The first odds of a match stay."""
    with temporary_stages(spark):
        landed = read_csv_wide(spark, landing, schemas.UPCOMING_CSV, with_source="parts")
        return _load(spark, warehouse, "upcoming", typed_upcoming(landed, SOURCE_PARTS),
                     schemas.UPCOMING, schemas.UPCOMING_MANDATORY, {}, blank_is_null,
                     "id", schemas.UPCOMING)


def read_ratings(spark: SparkSession, root: str, pool_col: str = "pool",
                 pool_type: T.DataType | None = None) -> tuple[DataFrame, DataFrame]:
    """(rating log, rankings) of a ratings folder."""
    extra = [T.StructField(pool_col, pool_type or T.StringType())]
    return (tables.read_all(spark, root, "log", T.StructType(schemas.RATING_LOG.fields + extra)),
            tables.read_latest(spark, root, "rankings", T.StructType(schemas.RANKINGS.fields + extra)))


def update_ratings(spark: SparkSession, root: str, gold: DataFrame, pool_col: str,
                   tag: str | None = None, **elo_options) -> DataFrame:
    """Rate the matches of ``gold`` that the log lacks and commit log and rankings together.

    Order holds inside a run: a match that arrives late is rated after those already rated.
    Returns the new log rows, those of the first run where ``tag`` names one committed before.
    """
    log, rankings = read_ratings(spark, root, pool_col, gold.schema[pool_col].dataType)
    held = tables.version_of(spark, root, tag) if tag else None
    if held is not None:
        return spark.read.schema(log.schema).parquet(f"{root}/v{held}/log")
    with temporary_stages(spark):
        rated = stage(elo_log(unprocessed(gold, log), rankings, pool_col, **elo_options), "rated")
        changed = latest_ratings(rated, pool_col).select(*rankings.columns)
        newcomers = register_entities(rankings, gold, pool_col=pool_col).select(*rankings.columns)
        after = without(rankings.unionByName(newcomers), changed, [pool_col, "player"]).unionByName(changed)
        version = tables.commit_version(spark, root, {"log": rated, "rankings": after}, tag)
    return spark.read.schema(log.schema).parquet(f"{root}/v{version}/log")


def replay_pools(spark: SparkSession, root: str, gold: DataFrame, pools: DataFrame, pool_col: str,
                 **elo_options) -> DataFrame:
    """The log as if all matches of ``pools`` (one column, ``pool_col``) had come in order.

    A late match is rated last by ``update_ratings``. Here its pool is rated again from the
    start; the log of every other pool is taken as it is. Nothing is committed.
    """
    log, _ = read_ratings(spark, root, pool_col, gold.schema[pool_col].dataType)
    named = pools.select(F.col(pool_col).alias("_replayed")).distinct()
    again = gold.join(named, gold[pool_col].eqNullSafe(F.col("_replayed")), "left_semi")
    return without(log, pools, [pool_col]).unionByName(elo_log(again, None, pool_col, **elo_options))


def job_rating_update(spark: SparkSession, warehouse: str, **elo_options) -> DataFrame:
    """Rate the published results, each pool of them in a task of its own."""
    gold = tables.read_all(spark, f"{warehouse}/results_gold", "rows", schemas.RESULTS_GOLD)
    return update_ratings(spark, f"{warehouse}/ratings", gold, "pool", **elo_options)


def job_rating_store(spark: SparkSession, warehouse: str, **options) -> DataFrame:
    """Rate the versions of results_gold that no run before has seen, into a store of parts; returns their rows.

    Late and corrected matches come in at their place, and a run reads and writes only the parts its matches
    touch. Once there is a store, predictions and the odds table take their ratings from it.
    """
    return rating_store.rate_gold(spark, f"{warehouse}/rating_store", f"{warehouse}/results_gold", schemas.RESULTS_GOLD, "pool", **options)


def current_ratings(spark: SparkSession, warehouse: str) -> tuple[DataFrame, DataFrame]:
    """(rating log, rankings): those of the store of parts if there is one, else of ``job_rating_update``."""
    if tables.versions(spark, f"{warehouse}/rating_store"):
        return rating_store.read_store(spark, f"{warehouse}/rating_store")
    return read_ratings(spark, f"{warehouse}/ratings")


def job_predict(spark: SparkSession, warehouse: str, run_ts, side: str = "own") -> DataFrame:
    """Predict the upcoming matches; a match predicted before keeps its first prediction."""
    upcoming = tables.read_all(spark, f"{warehouse}/upcoming_gold", "rows", schemas.UPCOMING)
    log, _ = current_ratings(spark, warehouse)
    known = tables.read_all(spark, f"{warehouse}/predictions", "rows", schemas.PREDICTIONS)
    # Left out before the work, not only before the write.
    upcoming = upcoming.join(known.select(F.col("match_id").alias("id")), "id", "left_anti").select(*upcoming.columns)
    made = predict(upcoming, log, side).withColumn("created_at", F.lit(run_ts).cast("timestamp"))
    # A prediction for each upcoming row, so its keys are had without looking ratings up.
    return _publish(spark, f"{warehouse}/predictions", made, ["match_id"], [], "id",
                    schemas.PREDICTIONS, ["match_id"], wide=True, rows_of=upcoming.select(F.col("id").alias("match_id")))


def job_backtest(spark: SparkSession, warehouse: str, as_of) -> DataFrame:
    """Score the predictions whose match is over; a scored prediction stays as it is."""
    predictions = tables.read_all(spark, f"{warehouse}/predictions", "rows", schemas.PREDICTIONS)
    results = tables.read_all(spark, f"{warehouse}/results_gold", "rows", schemas.RESULTS_GOLD)
    known = tables.read_all(spark, f"{warehouse}/backtest_log", "rows", schemas.BACKTEST_LOG)
    predictions = predictions.join(known.select(F.col("prediction_id").alias("id")), "id", "left_anti") \
        .select(*predictions.columns)
    scored = backtest(predictions, results, as_of).withColumn("run_timestamp", F.lit(as_of).cast("timestamp"))
    return _publish(spark, f"{warehouse}/backtest_log", scored, ["prediction_id"], [], "id",
                    schemas.BACKTEST_LOG, ["prediction_id"], wide=True)


def job_odds_refresh(spark: SparkSession, warehouse: str) -> DataFrame:
    """Reload the odds table with fresh odds, model probabilities and scores."""
    root = f"{warehouse}/odds_scores"
    _, rankings = current_ratings(spark, warehouse)
    old = tables.read_latest(spark, root, "rows", schemas.ODDS_SCORES)
    tables.truncate_and_load(refresh_odds_scores(old, rankings), root)
    return tables.read_latest(spark, root, "rows", schemas.ODDS_SCORES)


def job_market_snapshot(spark: SparkSession, warehouse: str, listing: DataFrame, fields: dict[str, str],
                        market: str, fee: float) -> Star:
    """Load one listing: dimensions and price rows become visible together."""
    root = f"{warehouse}/market"
    with temporary_stages(spark):
        star = load_star(tables.read_latest(spark, root, "markets", schemas.MARKETS),
                         tables.read_all(spark, root, "items", schemas.ITEMS), listing, fields, market, fee)
        tables.commit_version(spark, root, star._asdict())
    return Star(tables.read_latest(spark, root, "markets", schemas.MARKETS),
                tables.read_all(spark, root, "items", schemas.ITEMS),
                tables.read_all(spark, root, "prices", schemas.PRICES))


def results_of_pages(pages: DataFrame, html_col: str) -> DataFrame:
    return extract_match_pages(pages, html_col)


def upcoming_of_pages(pages: DataFrame, html_col: str, as_of) -> DataFrame:
    """Date of the next day, both names, and the odds of all bookmakers as a map."""
    rows = extract_match_pages(extract_odds_blocks(pages, html_col, "blocks"), html_col, keep=["blocks"])
    rows = rows.where(F.col("`Player 1`").isNotNull())
    return blocks_to_odds_map(rows, "blocks").select(
        iso_day(relative_day(as_of, 1)).alias("Date"), "Player 1", "Player 2", "odds")


def job_upcoming_pages_to_csv(pages: DataFrame, html_col: str, path: str, as_of) -> DataFrame:
    """Odds pages to CSV with a column per bookmaker and side, as the upcoming load reads them.

    The columns are those seen in this run: two for each bookmaker, however many rows there are.
    Nothing is written for no rows. Returns the rows with the odds as a map.
    """
    rows = stage(upcoming_of_pages(pages, html_col, as_of), "page-odds")
    seen = rows.select(F.explode(F.map_keys("odds")).alias("name")).distinct().collect()
    write_dated_csv(map_to_wide(rows, "odds", sorted(r["name"] for r in seen)), path, "Date")
    return rows


def job_pages_to_csv(pages: DataFrame, html_col: str, path: str, label_col: str | None = None) -> DataFrame:
    """Match pages to CSV files the results load can pick up; returns the rows.

    Without ``label_col`` there is one folder per match day and nothing is written for no
    rows; with it, one folder per label.
    """
    rows = extract_match_pages(pages, html_col, keep=[label_col] if label_col else [])
    rows = stage(rows, "page-rows")
    if label_col:
        write_labelled_csv(rows.withColumn("_slug", slug(label_col)).drop(label_col), path, "_slug")
    else:
        write_dated_csv(rows, path, "Date")
    return rows
