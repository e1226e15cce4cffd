"""Run registered queries against their DuckDB oracle and compare results.

Usage: ``python tests/oracle_compare.py [sf_dir] [name-substring ...]``.
The comparison mirrors the driver's: same column names, same row count and the
same multiset of rows (columns sorted by name, floats rounded).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def _key(v):
    if isinstance(v, float):
        return repr(round(v, 1))
    if isinstance(v, tuple):
        return repr(tuple(_key(x) for x in v))
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(_key(x) for x in t))


def same(a, b):
    if isinstance(a, float) and isinstance(b, (float, int)) and not isinstance(b, bool):
        return abs(a - b) <= 1e-6 * max(1.0, abs(a))
    if isinstance(b, float) and isinstance(a, int) and not isinstance(a, bool):
        return same(b, a)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(same(x, y) for x, y in zip(a, b))
    return a == b


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), sec=round(t1 - t0, 2), note="rows-only")
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    out = dict(name=name, rows=len(srows), orows=len(orows), sec=round(t1 - t0, 2))
    if sorted(scols) != sorted(ocols):
        return dict(out, ok=False, note=f"columns {sorted(scols)} vs {sorted(ocols)}")
    if len(srows) != len(orows):
        return dict(out, ok=False, note="row count")
    a, b = rows_of(scols, srows), rows_of(ocols, orows)
    if not all(same(x, y) for x, y in zip(a, b)):
        diff = [(x, y) for x, y in zip(a, b) if not same(x, y)][:2]
        return dict(out, ok=False, note=f"values differ e.g. {diff}")
    return dict(out, ok=True)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from tidewater.session import get_spark
    spark = get_spark(master="local[8]", shuffle_partitions=int(os.environ.get("ORACLE_SHUFFLE_PARTITIONS", "8")))
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            r = compare(spark, con, name, fn, orc.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(name=name, ok=False, note=f"{type(e).__name__}: {str(e).splitlines()[0][:300]}")
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
