"""Run queries and their SQL side by side: ``python tests/oracle.py [folder] [name ...]``."""

import decimal
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as e  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def cell(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v + 0.0)
    return "NULL" if v is None else str(v)


def lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder, name):
    """None if equal (or without SQL), else a short description of the difference."""
    df = e.queries()[name](spark, folder)
    got = lines(df.columns, [tuple(r) for r in df.collect()])
    sql = e.oracle_sql().get(name)
    if sql is None:
        return None if got[1] else "no rows"
    rel = con.sql(sql)
    want = lines(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}; only here {sorted(set(got[1]) - set(want[1]))[:2]}, only there {sorted(set(want[1]) - set(got[1]))[:2]}"
    if got[1] != want[1]:
        bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
        return f"{len(bad)} rows differ, e.g. {bad[0]}"
    return None


if __name__ == "__main__":
    from plotwise.session import get_session
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                           "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="plotwise-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in sys.argv[2:] or e.queries():
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as x:  # noqa: BLE001
            problem = f"{type(x).__name__}: {str(x)[:600]}"
        n = "" if name in e.oracle_sql() else " (rows only)"
        print(f"{'ok  ' if problem is None else 'BAD '} {name}{n} {time.time() - start:.1f}s {problem or ''}", flush=True)
