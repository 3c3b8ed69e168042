"""What publishing a version moves, and that it publishes the same rows."""

from pyspark.sql import functions as F

from duelmetrics import schemas
from duelmetrics.operators import keyed
from duelmetrics.plans import jobs
from duelmetrics.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_empty_table_is_joined_without_a_shuffle(spark):
    nothing = schemas.empty(spark, schemas.UPCOMING)
    assert nothing.schema == schemas.UPCOMING and nothing.isEmpty()
    ids = spark.range(10, numPartitions=3)
    new = ids.join(nothing.select("id"), "id", "left_anti")
    assert new.count() == 10 and "Exchange" not in plan(new)


def test_the_fold_by_key_carries_a_row_once(spark):
    batch = spark.createDataFrame([(1, "b", 2.0), (1, "a", 3.0), (1, "a", None), (2, None, 1.0)], "k int, v string, x double")
    first = keyed.first_per_key(batch, ["k"], ["v"])
    assert "min_by" not in plan(first)
    assert {tuple(r) for r in first.collect()} == {(1, "a", None), (2, None, 1.0)}
    assert {tuple(r) for r in keyed.last_per_key(batch, ["k"], ["v"]).collect()} == {(1, "b", 2.0), (2, None, 1.0)}


def test_numbering_does_not_shuffle_the_sorted_copy_again(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = keyed.with_surrogate_ids(spark.range(100, 0, -1, 5).withColumnRenamed("id", "x"), 7, ["x"])
        assert "SortMergeJoin" not in plan(numbered)
        assert sorted(map(tuple, numbered.collect())) == [(x + 7, x) for x in range(1, 101)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def published(spark, root, batch, wide):
    out = jobs._publish(spark, root, batch, ["match_id"], [], "id", schemas.PREDICTIONS, ["match_id"], wide=wide)
    return sorted(map(str, out.collect()))


def test_wide_rows_are_published_as_sorted_ones_are(spark, tmp_path):
    def batch(ids):
        rows = spark.createDataFrame([(i, f"a{n}") for n, i in enumerate(ids)], "match_id long, player1 string")
        return rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                             for f in schemas.PREDICTIONS.fields if f.name != "id"])

    for name, loads in {"whole": [[5, 3, 3, 9], [9, 4, 3], [4]], "broken": [[2, None, 1, None], [None, 2, 7]]}.items():
        sides = [[published(spark, f"{tmp_path}/{name}-{wide}", batch(ids), wide) for ids in loads] for wide in (False, True)]
        assert sides[0] == sides[1] and sides[0][0]
    own = batch([8, 6]).withColumn("id", F.lit(70).cast("long"))
    assert [published(spark, f"{tmp_path}/own-{wide}", own, wide) for wide in (False, True)][0] == published(spark, f"{tmp_path}/own", own, True)
    kept = tables.read_all(spark, f"{tmp_path}/whole-True", "rows", schemas.PREDICTIONS)
    assert sorted((r["id"], r["match_id"]) for r in kept.collect()) == [(1, 3), (2, 5), (3, 9), (4, 4)]
