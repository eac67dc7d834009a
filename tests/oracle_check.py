"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: OK / MISMATCH with row counts and the first diff.
The comparison is strict on doubles (repr), so any float noise shows up.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(float(v))
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return canon(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(canon(r[i]) for i in order) for r in records)


SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "DateType()": "DATE", "TimestampNTZType()": "TIMESTAMP",
                 "TimestampType()": "TIMESTAMP WITH TIME ZONE", "BooleanType()": "BOOLEAN"}


def type_diff(df, rel):
    st = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
    dt_ = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    return {c: (st[c], dt_.get(c)) for c in st if st[c] != dt_.get(c)}


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, keys=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, os_ = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[k] = ("SPARK_ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{k:32s} SPARK_ERROR {results[k][1]}", flush=True)
            continue
        ts = time.time() - t0
        if k not in os_:
            results[k] = ("NO_ORACLE", len(srows))
            if verbose:
                print(f"{k:32s} NO_ORACLE rows={len(srows)} {ts:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(os_[k])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[k] = ("SQL_ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{k:32s} SQL_ERROR {results[k][1]}", flush=True)
            continue
        tdiff = type_diff(df, con.sql(os_[k]))
        if sorted(scols) != sorted(dcols):
            results[k] = ("COLS", (sorted(scols), sorted(dcols)))
        elif tdiff:
            results[k] = ("TYPES", tdiff)
        else:
            a, b = rows_of(scols, srows), rows_of(dcols, drows)
            if a == b:
                h = hashlib.md5("\n".join(a).encode()).hexdigest()[:8]
                results[k] = ("OK", len(a), h)
            else:
                diff = next(((x, y) for x, y in zip(a, b) if x != y), (len(a), len(b)))
                results[k] = ("MISMATCH", len(a), len(b), diff)
        if verbose:
            print(f"{k:32s} {results[k][0]} rows={len(srows)} {ts:.1f}s "
                  f"{'' if results[k][0] == 'OK' else str(results[k][1:])[:600]}", flush=True)
    return results


if __name__ == "__main__":
    from carelake.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(shuffle_partitions=8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "NO_ORACLE")]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
