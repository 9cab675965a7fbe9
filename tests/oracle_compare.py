"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Prints one line per key: rows, column match and an order-insensitive value match.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, keys=None, verbose=True) -> dict[str, dict]:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for key in keys or list(qs):
        t0 = time.time()
        rec = {"key": key}
        try:
            df = qs[key](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
            rec["spark_rows"] = len(s_rows)
            rec["spark_types"] = [f.dataType.simpleString() for f in df.schema.fields]
            if key in sqls:
                rel = con.sql(sqls[key])
                d_cols = rel.columns
                d_rows = rel.fetchall()
                rec["duck_rows"] = len(d_rows)
                rec["cols_match"] = sorted(s_cols) == sorted(d_cols)
                rec["values_match"] = rec["cols_match"] and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
                rec["duck_types"] = [str(t) for t in rel.types]
                if not rec["values_match"]:
                    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
                    rec["cols"] = (sorted(s_cols), sorted(d_cols))
                    rec["diff_spark"] = [r for r in a if r not in set(b)][:3]
                    rec["diff_duck"] = [r for r in b if r not in set(a)][:3]
            else:
                rec["values_match"] = None
        except Exception as e:  # report and go on
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        rec["sec"] = round(time.time() - t0, 2)
        results[key] = rec
        if verbose:
            print(rec, flush=True)
    return results


if __name__ == "__main__":
    from ledgerloom.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = get_spark("local[8]", shuffle_partitions=8,
                      extra_conf={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, keys)
    bad = [k for k, r in res.items() if r.get("values_match") is False or "error" in r]
    checked = sum(1 for r in res.values() if r.get("values_match") is not None)
    print("MISMATCH/ERROR:", bad)
    print(f"{len(res)} keys run, {checked} checked against SQL, {len(bad)} bad", flush=True)
    spark.stop()
    sys.exit(1 if bad else 0)
