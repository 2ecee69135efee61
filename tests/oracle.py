"""Run registered queries next to their SQL twins and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as from '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def compare(spark, con, folder, query, sql):
    """(ok, message) for one query."""
    t0 = time.time()
    df = query(spark, folder)
    cols = sorted(df.columns)
    got = sorted(tuple(_cell(v) for v in row) for row in df.select(*cols).collect())
    t1 = time.time()
    if sql is None:
        return True, f"rows={len(got)} no sql ({t1 - t0:.1f}s)"
    rel = con.sql(sql)
    names = sorted(rel.columns)
    if names != cols:
        return False, f"columns {cols} != {names}"
    types = dict(zip(rel.columns, rel.types))
    kinds = {c: (df.schema[c].dataType.simpleString(), str(types[c])) for c in cols}
    want = sorted(tuple(_cell(v) for v in row) for row in rel.select(*[f'"{n}"' for n in names]).fetchall())
    t2 = time.time()
    info = f"rows={len(got)} spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s"
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "float": "FLOAT"}
    odd = {c: k for c, k in kinds.items() if pairs.get(k[0]) != k[1]}
    if odd:
        info += f" types {odd}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        miss = [r for r in want if r not in set(got)][:3]
        return False, info + f" want={len(want)}\n  cols {cols}\n  spark {extra}\n  sql   {miss}"
    return not odd, info


def main(argv):
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as entry
    from netsleuth.session import build_session

    folder = "/root/testdata/sf0.01"
    if argv and argv[0].startswith("/"):
        folder = argv.pop(0)
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not argv or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in argv)]
    bad = 0
    for name in names:
        try:
            ok, msg = compare(spark, con, folder, queries[name], oracles.get(name))
        except Exception as exc:  # report and go on
            ok, msg = False, f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += not ok
        print(("ok   " if ok else "FAIL ") + name, msg, flush=True)
    print(f"{len(names)} queries, {bad} bad")
    spark.stop()
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main(sys.argv[1:]) else 0)
