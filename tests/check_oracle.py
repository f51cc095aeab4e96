"""Compare queries with their DuckDB SQL: ``python tests/check_oracle.py [sf] [names...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def canonical(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if v != v else f"{v + 0.0:.9g}"
    if hasattr(v, "as_tuple"):
        return f"{float(v):.9g}"
    if isinstance(v, int):
        return f"{float(v):.9g}" if abs(v) < 1e15 else str(v)
    return str(v)


def compare(spark, con, name, fn, sql, sf_dir) -> str | None:
    """None if equal, else what differs."""
    start = time.time()
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    left = sorted(tuple(canonical(r[c]) for c in names) for r in df.collect())
    print(f"  {time.time() - start:5.2f}s in Spark ", end="")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    if sorted(cols) != names:
        return f"columns {names} vs {sorted(cols)}"
    at = [cols.index(c) for c in names]
    right = sorted(tuple(canonical(r[i]) for i in at) for r in cur.fetchall())
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)} rows differ, e.g. {str(bad[0][0])[:300]} vs {str(bad[0][1])[:300]}"
    return None if left else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry

    from tunewright.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    only = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracle:
                out = compare(spark, con, name, fn, oracle[name], sf_dir) or "ok"
            else:
                out = f"rows only: {fn(spark, sf_dir).count()}"
        except Exception as e:  # noqa: BLE001
            out = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        print(f"{name:32s} {time.time() - start:6.2f}s  {out}", flush=True)
