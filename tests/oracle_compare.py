"""Compare registered queries with their DuckDB SQL: columns, row counts and values."""

import math
import sys
import time
from pathlib import Path

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return 0.0 if v == 0 else v
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return str(v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is not None, str(type(x)), str(x)) for x in t))


def compare(spark, con, sf_dir, fn, sql):
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    cols = [c[0] for c in rel.description]
    want = rel.fetchall()
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} <> {sorted(cols)}", len(got)
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if len(a) != len(b):
        return f"rows {len(a)} <> {len(b)}", len(got)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}", len(got)
    return None, len(got)


def main(names=None, sf_dir="/root/testdata/sf0.01"):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from fareline.session import build_session

    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    qs, os_ = entry.queries(), entry.oracle_sql()
    failed = []
    for name, fn in qs.items():
        if names and not any(n in name for n in names):
            continue
        t = time.time()
        try:
            if name in os_:
                err, n = compare(spark, con, sf_dir, fn, os_[name])
            else:
                err, n = None, fn(spark, sf_dir).count()
        except Exception as e:  # noqa: BLE001
            err, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        if err or n == 0 or time.time() - t > 8:
            print(f"{'FAIL' if err else 'EMPTY' if n == 0 else 'slow'} {name} {n} rows {time.time() - t:.1f}s {err or ''}", flush=True)
        if err:
            failed.append(name)
    print("done", len(qs), "queries", len(os_), "with SQL; failed:", failed, flush=True)
    return failed


if __name__ == "__main__":
    main(sys.argv[1:])
