"""Few headers are written into the plan, many are looked up row by row; and what a load leaves out for most rows."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_sources import land

from duelmetrics import schemas
from duelmetrics.operators import quality
from duelmetrics.plans import jobs
from duelmetrics.sources import csv_landing

FILES = {
    "a.csv": 'Date,Player 1,Player 2,x_P1,x_P2\n2024-01-01,a,b,1.5,2.5\n2024-01-02,"c, d",e,,NA\n'
             'Date,Player 1,Player 2,x_P1,x_P2\n2024-01-03,f,g\n2024-01-04,h,i,1,2,3,4\n2024-01-05,j,k,1,2,,\n',
    "b.csv": 'y_P1,Player 2,Player 1,Date,"z ""q"", r"\n3.5,b,a,2024-01-06,"say ""so"""\n,n/a,b,2024-01-07,\n\n',
    "c.csv": "Player 1\nlonely\nlonely,but,wide,and,wider,still\n",
    "d.csv": "Date,Player 1,Player 2,y_P1,y_P1\n2024-01-08,l,m,1.1,1.2\n",
}


def rows(df):
    return sorted(map(str, df.withColumn("source_file", F.substring_index("source_file", "/", -1)).drop("source_row").collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_headers_in_the_plan_give_what_places_give(spark, tmp_path, monkeypatch):
    path = land(tmp_path / "in", FILES)
    readers = [lambda: csv_landing.read_csv_landing(spark, path, schemas.RESULTS_CSV, with_source=True),
               lambda: csv_landing.read_csv_wide(spark, path, schemas.UPCOMING_CSV, with_source=True),
               lambda: csv_landing.read_csv_wide(spark, path, {"one": "Player 1", "none": "no such name"}, with_source=True)]
    few = [rows(read()) for read in readers]
    assert [len(r) for r in few] == [11] * 3
    for name, value in (("LAYOUTS", 3), ("LAYOUT_CELLS", 7)):
        with monkeypatch.context() as m:
            m.setattr(csv_landing, name, value)
            assert [rows(read()) for read in readers] == few
    wide = {r["matchdate"]: r for r in readers[1]().where("cells_fit and matchdate is not null").collect()}
    assert wide["2024-01-01"]["odds"] == {"x_P1": "1.5", "x_P2": "2.5"} and wide["2024-01-02"]["odds"] == {}
    assert wide["2024-01-06"]["odds"] == {"y_P1": "3.5", 'z "q", r': 'say "so"'} and wide["2024-01-08"]["odds"] == {"y_P1": "1.1", "y_P1.1": "1.2"}
    assert "2024-01-04" not in wide and wide["2024-01-05"]["player1"] == "j" and wide["2024-01-07"]["player2"] is None


def test_few_headers_need_no_lambda_for_each_cell(spark, tmp_path):
    path = land(tmp_path / "in", FILES)
    assert "transform(" not in plan(csv_landing.read_csv_wide(spark, path, schemas.UPCOMING_CSV))
    assert "lambda" not in plan(csv_landing.read_csv_landing(spark, path, schemas.RESULTS_CSV, with_source=True))


def test_a_load_puts_texts_together_for_rejects_alone(spark, tmp_path, monkeypatch):
    written = []
    real = jobs.tables.commit_version
    monkeypatch.setattr(jobs.tables, "commit_version", lambda s, root, t, *a, **k: (written.append(plan(t["rows"])), real(s, root, t, *a, **k))[1])
    jobs.job_upcoming_load(spark, land(tmp_path / "in", FILES), str(tmp_path / "wh"))
    texts = [line for line in written[0].splitlines() if "to_csv(" in line]
    assert len(texts) == 1 and "CASE WHEN NOT (size(failed" in texts[0]
    assert "CollectMetrics" not in written[0]
    rejects = jobs.read_rejects(spark, str(tmp_path / "wh"), "upcoming", schemas.UPCOMING).select("raw", "failed").collect()
    assert {(r["raw"], tuple(r["failed"])) for r in rejects} == {
        ("Date,Player 1,Player 2,x_P1,x_P2", ("matchdate",)), ("2024-01-04,h,i,1,2,3,4", ("cells_fit",)),
        ("lonely", ("matchdate",)), ("lonely,but,wide,and,wider,still", ("matchdate", "cells_fit"))}


def test_the_file_a_row_came_from_is_not_looked_up_row_by_row(spark, tmp_path):
    text = "Date,Player 1,Player 2\n" + "".join(f"2024-01-01,the same long name,p{k}\n" for k in range(2000))
    jobs.job_upcoming_load(spark, land(tmp_path / "in", {"a.csv": text}), str(tmp_path / "wh"))
    part, = glob.glob(f"{tmp_path}/wh/upcoming_staged/v1/rows/accepted=true/*.parquet")
    group = pq.ParquetFile(part).metadata.row_group(0)
    coded = {c.path_in_schema: any("DICT" in e for e in c.encodings) for c in map(group.column, range(group.num_columns))}
    assert coded["player1"] and not coded["source_file"]
    assert jobs.read_clean(spark, str(tmp_path / "wh"), "upcoming", schemas.UPCOMING).select("source_file").distinct().count() == 1


def test_failures_list_every_check_in_order(spark):
    df = spark.createDataFrame([(1, "x"), (None, " "), (None, "x"), (3, None)], "a int, b string")
    rules = {"small": F.col("a") < 2, "a": F.col("b") == "x"}
    got = df.select(quality.failures(["a", "b"], True, rules)).collect()
    assert [r[0] for r in got] == [[], ["a", "b", "small", "a"], ["a", "small"], ["b", "small", "a"]]
    assert df.select(quality.failures([])).collect() == [([],)] * 4


@pytest.mark.parametrize("by_rows", [False, True])
def test_no_fold_where_no_key_comes_twice(spark, tmp_path, monkeypatch, by_rows):
    folds = []
    real = jobs.one_per_key
    monkeypatch.setattr(jobs, "one_per_key", lambda *a: (folds.append(1), real(*a))[1])

    def load(ids):
        batch = spark.createDataFrame([(i, f"a{n}") for n, i in enumerate(ids)], "match_id long, player1 string")
        batch = batch.select(*[F.col(f.name) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name)
                               for f in schemas.PREDICTIONS.fields if f.name != "id"])
        out = jobs._publish(spark, f"{tmp_path}/wh", batch, ["match_id"], [], "id", schemas.PREDICTIONS, ["match_id"], wide=True,
                            rows_of=batch.select("match_id") if by_rows else None)
        return sorted((r["id"], r["match_id"], r["player1"]) for r in out.collect())

    assert load([7, 5]) == [(1, 5, "a1"), (2, 7, "a0")] and not folds
    assert load([7, 8, 9, 8]) == [(3, 8, "a1"), (4, 9, "a2")] and len(folds) == 1
    assert load([]) == [] and load([9, 5]) == [] and len(folds) == 1
    assert load([6, None, 6]) == [(5, None, "a1"), (6, 6, "a0")]
