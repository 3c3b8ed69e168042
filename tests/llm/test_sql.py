"""Queries against their SQL on a small table of odd rows."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from duelmetrics.llm import oracle, queries

KEY = "Zx9" + "kQ7+" * 9
TEXTS = [
    None, "", " \n ", "nothing to see here at all",
    "password = hunter22 and PassWD:\"short\" token=é", "secret: abc12 API_KEY='abcdef'",
    "AKIA" + "Q" * 16 + " AKIA" + "Q" * 15 + " akia", "f" * 23 + " " + "0f" * 12 + "g" + "a" * 30,
    f"user = anna {KEY} https://db.example/x", KEY, f"\U0001f600 login:bob " + "x " * 200 + KEY,
    f"token={'ab12' * 8} user: al client_id: alice", "ssh://host.example " * 3 + "secret=abcdefg account = me.you",
    "Released under the MIT License.", "Intro.\n\nThis project is licensed under the MIT License!\nReleased under the MIT license",
    "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0.", "released under the bsd 3-clause license", "the License " * 50,
    *["one two three four five six seven eight nine ten eleven twelve"] * 3,
    "one two three four five six seven eight nine ten eleven twelve", "A b C", "a B c", "one  two\tthree four five six seven eight nine ten eleven twelve",
]


@pytest.mark.parametrize("name", sorted(oracle.ALL))
@pytest.mark.parametrize("rows", [len(TEXTS), 0])
def test_query_equals_sql(spark, tmp_path, name, rows):
    path = f"{tmp_path}/documents.parquet"
    pq.write_table(pa.table({"doc_id": pa.array(range(rows), pa.int64()), "text": pa.array(TEXTS[:rows], pa.string())}), path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    got = queries.ALL[name](spark, str(tmp_path))
    names = sorted(got.columns)
    wanted = con.execute(f"SELECT {', '.join(names)} FROM ({oracle.ALL[name]})").fetchall()
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)) for r in got.select(names).collect())
