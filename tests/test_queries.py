"""Every registered query against its SQL on the smallest test tables."""

import collections
import math
from pathlib import Path

import duckdb
import pytest

from workload import oracle, queries

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def comparable(names, data):
    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 8) + 0.0
        return v

    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), collections.Counter(tuple(value(r[i]) for i in order) for r in data)


def test_every_query_has_its_sql():
    assert set(queries.ALL) == set(oracle.ALL)


@pytest.mark.parametrize("name", list(queries.ALL))
def test_query(spark, sql, name):
    df = queries.ALL[name](spark, str(SF_DIR))
    got = comparable(df.columns, df.collect())
    rel = sql.execute(oracle.ALL[name])
    want = comparable([d[0] for d in rel.description], rel.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1], (list((got[1] - want[1]).items())[:3], list((want[1] - got[1]).items())[:3])
