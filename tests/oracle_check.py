"""Run registered queries next to their DuckDB oracles and compare (row count, columns, values).

Usage: python tests/oracle_check.py [--sf /root/testdata/sf0.01] [key ...]
Values are compared as multisets of rows with columns sorted by name; floats must be equal
(``exact``) and, separately, equal to 1e-9 relative (``approx``). Types are compared per column.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, approx: bool):
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("f", "nan")
        if approx and v != 0 and not math.isinf(v):
            return ("f", float(f"{v:.9g}"))
        return ("f", repr(v))
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, Decimal):
        return ("d", str(v))
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x, approx) for x in v))
    return ("s", str(v))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(spark_dtypes, duck_types) -> list:
    """Columns whose Spark type and DuckDB type differ (simple types; arrays compared by name)."""
    duck = dict(duck_types)
    out = []
    for name, t in spark_dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        got = str(duck.get(name, "?")).upper()
        if want != got and not (t.startswith("array") and got.endswith("[]")):
            out.append((name, t, got))
    return out


def compare(spark_rows, spark_cols, sql_rows, sql_cols):
    res = {"rows_spark": len(spark_rows), "rows_sql": len(sql_rows)}
    res["cols_match"] = sorted(spark_cols) == sorted(sql_cols)
    if not res["cols_match"]:
        res["cols"] = (sorted(spark_cols), sorted(sql_cols))
        return res
    so = sorted(range(len(spark_cols)), key=lambda i: spark_cols[i])
    qo = sorted(range(len(sql_cols)), key=lambda i: sql_cols[i])
    for approx in (False, True):
        a = Counter(tuple(_norm(r[i], approx) for i in so) for r in spark_rows)
        b = Counter(tuple(_norm(r[i], approx) for i in qo) for r in sql_rows)
        res["approx" if approx else "exact"] = a == b
        if not approx and a != b:
            res["only_spark"] = list((a - b).items())[:3]
            res["only_sql"] = list((b - a).items())[:3]
    return res


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--conf", action="append", default=[], help="session setting key=value (repeatable)")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args(argv)

    import __spark_entry__ as E
    from flowguard.session import local_session

    spark = local_session("oracle-check", "8", 8)
    for kv in args.conf:
        k, v = kv.split("=", 1)
        spark.conf.set(k, v)
    con = duck(args.sf)
    qs, oracles = E.queries(), E.oracle_sql()
    keys = args.keys or list(qs)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            df = qs[k](spark, args.sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in oracles:
            print(f"{k:28s} rows-only rows={len(rows)} cols={len(cols)} {ts:.1f}s")
            continue
        try:
            con.execute(f"CREATE OR REPLACE TEMP VIEW oracle AS {oracles[k]}")  # as the driver loads it
            cur = con.execute("SELECT * FROM oracle")
            qcols = [d[0] for d in cur.description]
            qtypes = [(d[0], d[1]) for d in cur.description]
            qrows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SQL ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        r = compare(rows, cols, qrows, qcols)
        tm = type_mismatches(df.dtypes, qtypes)
        if tm:
            r["types"] = tm
        ok = r.get("exact") and r["rows_spark"] == r["rows_sql"]
        bad += 0 if ok else 1
        print(f"{k:28s} {'OK  ' if ok else 'FAIL'} {r} {ts:.1f}s")
    print(f"failures: {bad} of {len(keys)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
