"""Run registered queries against their DuckDB twins (same check as the driver's).

    python tests/twin_check.py [sf_dir] [name ...]

Compares row count, sorted column names and an order-insensitive value
hash; prints one line per query.
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.sources.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    try:
        if pd.isna(v):
            return "∅"
    except (TypeError, ValueError):
        pass
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):  # numbers, Decimal
        f = round(float(v), 9) + 0.0
        return str(int(f)) if f.is_integer() else repr(f)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return str(v)


def frame_digest(pdf: pd.DataFrame) -> tuple[int, list[str], str, list[str]]:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for _, r in pdf[cols].iterrows())
    return len(pdf), cols, hashlib.sha1("\n".join(rows).encode()).hexdigest(), rows


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT"}


def type_diffs(sdf, con, sql) -> list[str]:
    """Column types that differ between the Spark result and the DuckDB twin."""
    dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for f in sdf.schema.fields:
        t = f.dataType.simpleString()
        exp = SPARK_TO_DUCK.get(t, t.upper())
        if dt.get(f.name) != exp:
            out.append(f"{f.name}: spark={t} duck={dt.get(f.name)}")
    return out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    ts = time.time() - t0
    if sql is None:
        return f"{name:40s} rows={len(spdf):6d} spark={ts:5.2f}s (no twin: nothing compared)", False
    dpdf = con.execute(sql).df()
    a, b = frame_digest(spdf), frame_digest(dpdf)
    types = type_diffs(sdf, con, sql)
    ok = a[0] == b[0] and a[1] == b[1] and a[2] == b[2] and not types
    msg = (f"{name:40s} rows={a[0]:6d}/{b[0]:6d} cols={'ok' if a[1] == b[1] else 'DIFF'} "
           f"types={'ok' if not types else 'DIFF'} hash={'ok' if a[2] == b[2] else 'DIFF'} spark={ts:5.2f}s")
    if types:
        msg += "\n   " + "; ".join(types)
    if not ok:
        if a[1] != b[1]:
            msg += f"\n   spark-only={sorted(set(a[1]) - set(b[1]))} duck-only={sorted(set(b[1]) - set(a[1]))}"
        else:
            sa, sb = set(a[3]), set(b[3])
            for r in sorted(sa - sb)[:3]:
                msg += f"\n   spark: {r[:400]}"
            for r in sorted(sb - sa)[:3]:
                msg += f"\n   duck : {r[:400]}"
    return msg, ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from tidemark.session import get_session
    spark = get_session()
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    bad = 0
    for n in (names or [q for q in qs if q in sq]):
        try:
            msg, ok = compare(spark, con, n, qs[n], sq.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001
            msg, ok = f"{n:40s} ERROR {type(e).__name__}: {str(e)[:600]}", False
        bad += not ok
        print(msg, flush=True)
    print(f"== {len(names or sq) - bad} ok, {bad} failing; twins for {len(sq)}/{len(qs)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
