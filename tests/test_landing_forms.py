"""Headers read as text, one pass over landed rows, bucketed tables, odds as variants."""

import csv
import io
import json

import pytest
from pyspark.sql import functions as F
from test_sources import land, results_files

from duelmetrics import schemas
from duelmetrics.functions import odds
from duelmetrics.functions import odds_variant as variant
from duelmetrics.operators import keyed, quality
from duelmetrics.plans import jobs
from duelmetrics.session import scratch_dir
from duelmetrics.sources import bucketed, csv_landing, tables


# headers

HEADERS = ["a,b,c", "a", '"a,b","c ""d""",e', '"q" tail,x', "a,,b,", ",", "a,a,a,b,a.1", " a , b ", '"",x', "é,漢字,ß", 'x"y,z', '"' + "long " * 3000 + '",b']


@pytest.mark.parametrize("line", HEADERS, ids=range(len(HEADERS)))
def test_header_names_equal_a_csv_reader(spark, line):
    names, seen = [], {}
    for name in next(csv.reader(io.StringIO(line))):
        names.append(f"{name}.{seen[name]}" if name in seen else name)
        seen[name] = seen.get(name, 0) + 1
    assert spark.createDataFrame([(line,)], "line string").select(csv_landing.header_names(F.col("line"))).first()[0] == names


def test_each_file_has_its_first_line_as_header(spark, tmp_path):
    path = land(tmp_path / "in", {"a.csv": "﻿x,y\n1,2\n3,4", "b.csv": "\r\n  \r\nz,x\r\n5,6\r\n", "empty.csv": "", "blank.csv": "\n\n", "c d%.csv": "w"})
    got = {r.path.rsplit("/", 1)[1]: r.header for r in csv_landing.landed_headers(spark, path).collect()}
    assert got == {"a.csv": ["x", "y"], "b.csv": ["z", "x"], "c%20d%25.csv": ["w"]}


def test_headers_of_files_cut_into_splits(spark, tmp_path):
    """Only the first line of the file names columns, whatever the other splits begin with."""
    path = land(tmp_path / "in", {"a.csv": "x,y\n" + "".join(f"{k},{k + 1}\n" for k in range(4000)), "b.csv": "y,x\n1,2\n"})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = csv_landing.read_csv_landing(spark, path, {"x": "x", "y": "y"})
        assert rows.rdd.getNumPartitions() > 5
        assert rows.agg(F.count(F.lit(1)), F.sum(F.col("y").cast("int") - F.col("x").cast("int"))).first() == (4001, 4000 - 1)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_no_python_opens_files(spark, tmp_path):
    rows = csv_landing.read_csv_wide(spark, results_files(tmp_path / "in"), schemas.RESULTS_CSV)
    heads = csv_landing.landed_headers(spark, str(tmp_path / "in"))
    for df in (rows, heads):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "MapInPandas" not in plan and "ArrowEval" not in plan


# one pass

def test_the_audit_of_the_pass_equals_a_count(spark, tmp_path):
    landing, warehouse = results_files(tmp_path / "in"), str(tmp_path / "wh")
    audit = jobs.job_results_load(spark, landing, warehouse).first().asDict()
    clean = jobs.read_clean(spark, warehouse, "results", schemas.RESULTS_STAGED)
    rejects = jobs.read_rejects(spark, warehouse, "results", schemas.RESULTS_STAGED)
    typed = jobs.typed_results(csv_landing.read_csv_landing(spark, landing, schemas.RESULTS_CSV, with_source=True), ["cells_fit"])
    rules = {**quality.two_player_rules(), "cells_fit": F.col("cells_fit")}
    want = quality.quality_gate(typed, schemas.RESULTS_MANDATORY, rules=rules).audit.first().asDict()
    assert {k: audit[k] for k in want} == want
    assert (clean.count(), rejects.count()) == (audit["rows_clean"], audit["rows_rejected"])
    assert rejects.where("raw IS NULL OR size(failed) = 0").isEmpty()
    assert set(tables.versions(spark, f"{warehouse}/results_staged")) == {1}


def test_a_load_of_nothing_and_of_rejects_only(spark, tmp_path):
    for n, text in enumerate(("Date,Player 1,Player 2\n", "Date,Player 1,Player 2\n,x,y\n")):
        warehouse = str(tmp_path / f"wh{n}")
        audit = jobs.job_results_load(spark, land(tmp_path / f"in{n}", {"a.csv": text}), warehouse).first()
        assert (audit["rows_read"], audit["rows_clean"], audit["rows_inserted"]) == (n, 0, 0)
        assert jobs.read_rejects(spark, warehouse, "results", schemas.RESULTS_STAGED).count() == n


def test_ids_go_on_after_an_empty_load(spark, tmp_path):
    landing, warehouse = results_files(tmp_path / "in"), str(tmp_path / "wh")
    assert jobs.job_results_load(spark, landing, warehouse).first()["rows_inserted"] == 3
    assert jobs.job_results_load(spark, landing, warehouse).first()["rows_inserted"] == 0
    (tmp_path / "in" / "f.csv").write_text("Date,Player 1,Player 2,Player 1 Score,Player 2 Score,Winner\n2024-03-01,Ann,Bob,1,2,Bob\n")
    jobs.job_results_load(spark, landing, warehouse)
    gold = tables.read_all(spark, f"{warehouse}/results_gold", "rows", schemas.RESULTS_GOLD)
    assert sorted(r.match_id for r in gold.collect()) == [1, 2, 3, 4]


# bucketed tables

KV = "k string, d int, v string, at int"


def bucketed_name(spark):
    path = scratch_dir(spark, "keyed")
    return path.rsplit("/", 1)[1].replace("-", "_"), path


def test_bucketed_insert_equals_the_plain_one(spark):
    name, path = bucketed_name(spark)
    target = [("a", 1, "old", 0), (None, 1, "old", 0)] + [(f"k{n}", n, "old", 0) for n in range(200)]
    batch = [("a", 1, "x", 1), ("b", 1, "late", 5), ("b", 1, "early", 2), (None, 1, "n", 1), ("c", None, "n", 1)] + [(f"k{n}", n, "new", 1) for n in range(150, 300)]
    batch = spark.createDataFrame(batch, KV)
    bucketed.bucketed_table(spark, name, path, batch.schema, ["k", "d"], 4)
    bucketed.insert_if_absent_bucketed(spark, name, spark.createDataFrame(target, KV), ["k", "d"], 4, ["at"])
    want = keyed.insert_if_absent(spark.createDataFrame(target, KV), batch, ["k", "d"], ["at"])
    bucketed.insert_if_absent_bucketed(spark, name, batch, ["k", "d"], 4, ["at"])
    assert sorted(map(str, spark.table(name).collect())) == sorted([str(r) for r in want.collect()] + [str(r) for r in spark.createDataFrame(target, KV).collect()])
    # A session that has forgotten the table finds it by its folder.
    spark.sql(f"DROP TABLE {name}")
    bucketed.bucketed_table(spark, name, path, batch.schema, ["k", "d"], 4)
    assert bucketed.absent_rows(spark, name, batch, ["k", "d"], 4, ["at"]).isEmpty()


def test_the_bucketed_table_is_not_shuffled(spark):
    name, path = bucketed_name(spark)
    batch = spark.createDataFrame([(f"k{n}", n, "v", 0) for n in range(50)], KV)
    bucketed.bucketed_table(spark, name, path, batch.schema, ["k", "d"], 6)
    bucketed.insert_if_absent_bucketed(spark, name, batch, ["k", "d"], 6)
    plan = bucketed.absent_rows(spark, name, batch, ["k", "d"], 6)._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(k for k, line in enumerate(plan) if "FileScan parquet" in line)
    depth = next(k for k, c in enumerate(plan[scan]) if c in "+:" and plan[scan][k + 1] == "-")
    above = []
    for line in reversed(plan[:scan]):
        at = next((k for k, c in enumerate(line) if c in "+:" and line[k + 1:k + 2] == "-"), 0)
        if at < depth:
            above.append(line)
            depth = at
    assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above)
    assert sum("Exchange hashpartitioning" in line for line in plan) == 1 and "Bucketed: true" in plan[scan]


# variants

DOCS = [
    ('{"a_P1": 1.5, "a_P2": "2.5", "b_P1": " 3 "}', {"a_P1": 1.5, "a_P2": 2.5, "b_P1": 3.0}),
    ('{"a": {"P1": 1, "P2": "2", "deep": {"P1": 99}}, "b": [4, "5", [6], null]}', {"a_P1": 1.0, "a_P2": 2.0, "b_P1": 4.0, "b_P2": 5.0}),
    ('{"a_P1": true, "b_P1": null, "c_P1": "NaN", "d_P1": "1.5d", "e_P1": {}, "f_P1": [], "g_P1": ""}', {}),
    ('{"a_P1": 1e2, "b_P1": 12345678901234567890123, "c_P1": -0.5}', {"a_P1": 100.0, "b_P1": 12345678901234567890123.0, "c_P1": -0.5}),
    ("{}", {}), ("[1, 2]", None), ("7", None), ('"text"', None), ("null", None), ("not json", None), ("", None), (None, None),
    ('{"a_P1": 1', None), ('{"a_P1": 1, "a_P1": 2}', None),
]


def test_prices_of_every_shape(spark):
    df = spark.createDataFrame([(n, text) for n, (text, _) in enumerate(DOCS)], "n int, text string")
    prices = df.withColumn("p", variant.named_prices(variant.parse_odds_variant("text")))
    got = {r.n: None if r.p is None else {x["name"]: x["price"] for x in r.p} for r in prices.collect()}
    assert got == {n: want for n, (_, want) in enumerate(DOCS)}
    best = prices.select(variant.best_price("p", "_P1")).collect()
    assert [r[0] for r in best] == [max((v for k, v in (want or {}).items() if "_P1" in k), default=None) for _, want in DOCS]


def test_flat_odds_are_read_as_by_the_map_of_texts(spark):
    flat = [json.dumps({f"b{n}_P{n % 2 + 1}": v for n, v in enumerate(values)}) for values in
            ([1.5, "2.5", 3], ["x", 2, None], [True, " 4.25 ", "1e1"], [])]
    df = spark.createDataFrame([(t,) for t in flat], "t string")
    for side in ("_P1", "_P2"):
        a, b = (df.select(c).collect() for c in (odds.best_odds(odds.parse_odds("t"), side),
                                                 variant.best_price(variant.named_prices(variant.parse_odds_variant("t")), side)))
        assert a == b
