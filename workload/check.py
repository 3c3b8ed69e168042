"""Run queries and their SQL side by side: ``python -m workload.check [sf] [name ...]``."""

from __future__ import annotations

import collections
import math
import sys
import time

import duckdb

from duelmetrics.session import get_session

from . import oracle, queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], collections.Counter(tuple(value(r[i]) for i in order) for r in data)


def kinds(names, data):
    return {n: {type(r[i]).__name__ for r in data if r[i] is not None} for i, n in enumerate(names)}


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    chosen = sys.argv[2:] or list(queries.ALL)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name in chosen:
        try:
            start = time.time()
            df = queries.ALL[name](spark, sf_dir)
            data = df.collect()
            got = rows(df.columns, data)
            took = time.time() - start
            if name not in oracle.ALL:
                print(f"----  {name}: {sum(got[1].values())} rows, no SQL, {took:.1f}s")
                continue
            start = time.time()
            rel = con.execute(oracle.ALL[name])
            names = [d[0] for d in rel.description]
            sql_data = rel.fetchall()
            want = rows(names, sql_data)
            ours, theirs = kinds(df.columns, data), kinds(names, sql_data)
            for n in ours.keys() & theirs.keys():
                if ours[n] != theirs[n]:
                    print(f"type  {name}.{n}: {ours[n]} / {theirs[n]}")
            sql_took = time.time() - start
        except Exception as e:
            bad += 1
            print(f"FAIL  {name}: {type(e).__name__} {str(e)[:1500]}")
            continue
        if got == want:
            print(f"ok    {name}: {sum(got[1].values())} rows, {took:.1f}s, SQL {sql_took:.1f}s")
            continue
        bad += 1
        print(f"DIFF  {name}: {got[0]} {sum(got[1].values())} / {want[0]} {sum(want[1].values())}")
        print("   spark only", list((got[1] - want[1]).items())[:4])
        print("   sql only  ", list((want[1] - got[1]).items())[:4])
    print(f"{len(chosen) - bad} of {len(chosen)} fine")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
