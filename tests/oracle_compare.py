"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: rows, column match and value match.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from postwise.sources.tables import TABLES  # noqa: E402


def canon(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return ("d", str(v.normalize()) if v == v else "nan")
    if isinstance(v, float):
        return ("f", None if math.isnan(v) else round(v, 6))
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, dt.datetime):
        return ("t", v.isoformat())
    if isinstance(v, dt.date):
        return ("D", v.isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    return ("s", str(v))


def rows_key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(canon(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from postwise.session import get_spark

    spark = get_spark(8)
    qs, ora = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
            stypes = [f.dataType.simpleString() for f in df.schema.fields]
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ora:
            print(f"{name:32s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(ora[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
            dtypes = [str(d[1]) for d in res.description]
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCKDB ERROR {str(e)[:300]}")
            bad += 1
            continue
        cm = sorted(cols) == sorted(dcols)
        vm = cm and rows_key(srows, cols) == rows_key(drows, dcols)
        tmap = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
                "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}
        dt_by = dict(zip(dcols, dtypes))
        tm = cm and all(dt_by.get(c) == (t.upper() if t.startswith("decimal") else tmap.get(t, t))
                        for c, t in zip(cols, stypes))
        ok = cm and vm and tm and len(srows) == len(drows)
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows={len(srows)}/{len(drows)} cols={cm} types={tm} vals={vm} {ts:.1f}s")
        if not ok:
            print("   spark:", list(zip(cols, stypes)))
            print("   duck :", list(zip(dcols, dtypes)))
            if cm:
                a, b = rows_key(srows, cols), rows_key(drows, dcols)
                sa, sb = set(a), set(b)
                print("   only spark:", [x for x in a if x not in sb][:3])
                print("   only duck :", [x for x in b if x not in sa][:3])
    print("BAD", bad)


if __name__ == "__main__":
    main(sys.argv)
