"""Compare registered queries with their SQL twins in DuckDB.

    python -m tests.oracle [--sf DIR] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

SF = "/root/testdata/sf0.01"
EXACT = False  # compare doubles bit for bit instead of to six decimals


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads=4")
    for f in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, _cell(x)) for k, x in sorted(v.items()))
    if isinstance(v, float):
        return v + 0.0 if EXACT else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf):
    t0 = time.time()
    df = fn(spark, sf)
    got = df.collect()
    t1 = time.time()
    if sql is None:
        return f"rows-only {len(got):>7}  {t1 - t0:6.2f}s", len(got) > 0
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_types = {d[0]: str(d[1]) for d in cur.description}
    cols, have = rows(df.columns, [tuple(r) for r in got])
    wcols, want = rows(want_cols, cur.fetchall())
    if cols != wcols:
        return f"COLUMNS differ: only spark {sorted(set(cols)-set(wcols))} only sql {sorted(set(wcols)-set(cols))}", False
    if have != want:
        diff = [(a, b) for a, b in zip(have, want) if a != b][:2]
        return f"VALUES differ: {len(have)} vs {len(want)} rows; {cols}\n   " + "\n   ".join(map(str, diff)), False
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP", "date": "DATE", "int": "INTEGER"}
    odd = [f"{c}:{t}/{want_types[c]}" for c, t in df.dtypes if kinds.get(t, t) != want_types[c]
           and not (t.startswith("array") or t.startswith("struct"))]
    return f"ok {len(have):>7} rows {t1 - t0:6.2f}s {'TYPES ' + ' '.join(odd) if odd else ''}", True


def main(argv):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from tidegate.session import local_session
    global EXACT
    sf = SF
    if argv[:1] == ["--exact"]:
        EXACT, argv = True, argv[1:]
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not argv or any(n.startswith(a) for a in argv)]
    spark, con = local_session(8), duck(sf)
    bad = []
    for n in names:
        try:
            msg, ok = compare(spark, con, n, queries[n], sqls.get(n), sf)
        except Exception as e:  # noqa: BLE001 - report and go on
            msg, ok = f"ERROR {type(e).__name__}: {str(e)[:600]}", False
        print(f"{'  ' if ok else '!!'} {n:45s} {msg}", flush=True)
        if not ok:
            bad.append(n)
    print(f"{len(names) - len(bad)}/{len(names)} ok; failing: {bad}")


if __name__ == "__main__":
    main(sys.argv[1:])
