"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

``python tests/oracle_check.py SF_DIR [key ...]`` prints one line per key:
row counts, column sets and an order-insensitive value comparison.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir: str, keys=None, con=None):
    from tidemark.plans import registry
    qs, sql = registry.queries(), registry.oracle_sql()
    con = con or duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[k] = ("SPARK-ERROR", str(e).splitlines()[0][:300])
            print(k, results[k], flush=True)
            continue
        t1 = time.time()
        if k not in sql:
            results[k] = ("NO-SQL", len(s_rows))
            print(f"{k:32s} NO-SQL rows={len(s_rows)} spark={t1 - t0:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(sql[k])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[k] = ("SQL-ERROR", str(e).splitlines()[0][:300])
            print(k, results[k], flush=True)
            continue
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_n = len(s_rows) == len(d_rows)
        ok_v = ok_cols and ok_n and _rows(s_rows, s_cols) == _rows(d_rows, d_cols)
        status = "OK" if ok_v else "DIFF"
        results[k] = (status, len(s_rows), len(d_rows))
        extra = ""
        if not ok_cols:
            extra = f" cols spark-only={sorted(set(s_cols) - set(d_cols))} sql-only={sorted(set(d_cols) - set(s_cols))}"
        elif not ok_v and ok_n:
            a, b = _rows(s_rows, s_cols), _rows(d_rows, d_cols)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:1]
            extra = f" first diff cols={sorted(s_cols)} {diff}"
        print(f"{k:32s} {status} rows={len(s_rows)}/{len(d_rows)} spark={t1 - t0:.1f}s{extra}"[:1500], flush=True)
    return results


if __name__ == "__main__":
    from tidemark.session import build_session
    sf = sys.argv[1]
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO-SQL")}
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {sorted(bad)}")
