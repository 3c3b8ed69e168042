"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from duelmetrics.session import get_session
from workload import queries

HEADLINE = ["results_job", "upcoming_job", "elo_log", "elo_single_pool", "elo_hot_pool",
            "asof_own", "asof_count", "predict", "match_chain", "odds_refresh", "best_odds",
            "insert_if_absent", "upsert_last_wins", "star_load_prices", "symbol_extract", "match_pages"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    # One small run starts the Python workers and loads the classes.
    queries.predict(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for name in chosen:
        start = time.perf_counter()
        queries.ALL[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total time of the headline queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))[2:]}))
    spark.stop()


if __name__ == "__main__":
    main()
