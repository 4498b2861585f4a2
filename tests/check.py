"""Compare registered queries with their SQL: ``python tests/check.py [sf] [name ...]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

import __spark_entry__ as entry
from postlens.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connection(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(x):
        if x is None or (isinstance(x, float) and pd.isna(x)):
            return "NULL"
        if isinstance(x, float):
            return repr(x + 0.0)
        return str(x)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name):
    df = entry.queries()[name](spark, folder)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return got, None, sorted(df.columns), None
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = canonical(cur.fetchall(), names)
    return got, want, sorted(df.columns), sorted(names)


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(folder)
    bad = []
    for name in names:
        start = time.time()
        try:
            got, want, have, expect = compare(spark, con, folder, name)
        except Exception as error:
            bad.append(name)
            print("ERROR", name, str(error)[:1500], flush=True)
            continue
        state = "rows" if want is None else "ok" if got == want and have == expect else "DIFF"
        print(f"{state:5} {name:28} {len(got):8} rows {time.time() - start:6.1f}s", flush=True)
        if state == "DIFF":
            bad.append(name)
            print("   ", have, expect, len(got), len(want))
            for a in list(set(got) - set(want))[:3]:
                print("    spark", str(a)[:600])
            for a in list(set(want) - set(got))[:3]:
                print("    sql  ", str(a)[:600])
    print("bad:", bad)
