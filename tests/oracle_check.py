"""Run registered queries and their reference SQL side by side and report differences.

    python tests/oracle_check.py [--sf 0.01] [key-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(d: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return float(f"{v:.12g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in data]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, key, query, sql, d):
    started = time.time()
    df = query(spark, d)
    cols, data = rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    if sql is None:
        return None, f"rows {len(data)} (no reference SQL)", took
    cur = con.execute(sql)
    ocols = [c[0] for c in cur.description]
    ocols, odata = rows(ocols, cur.fetchall())
    if cols != ocols:
        return False, f"columns {cols} vs {ocols}", took
    if len(data) != len(odata):
        extra = [r for r in data if r not in set(odata)][:2] if len(data) < 20000 else []
        return False, f"rows {len(data)} vs {len(odata)}; first only here {extra}", took
    for a, b in zip(data, odata):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return False, f"{cols}\n   here {a}\n   sql  {b}", took
    return True, f"rows {len(data)}", took


def main(argv):
    sf = "0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        del argv[i:i + 2]
    import __spark_entry__ as E
    import logging

    from massloom.session import build_session
    logging.disable(logging.CRITICAL)
    d = f"/root/testdata/sf{sf}"
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(d)
    oracle, bad = E.oracle_sql(), []
    for key, q in E.queries().items():
        if argv and not any(key.startswith(p) for p in argv):
            continue
        try:
            ok, note, took = compare(spark, con, key, q, oracle.get(key), d)
        except Exception as e:  # noqa: BLE001
            ok, note, took = False, f"{type(e).__name__}: {str(e)[:400]}", 0.0
        if ok is False:
            bad.append(key)
        print(f"{'ok  ' if ok else '--  ' if ok is None else 'FAIL'} {key} {took:.1f}s {note}", flush=True)
    print(f"{len(bad)} failing: {bad}")
    spark.stop()
    return len(bad)


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
