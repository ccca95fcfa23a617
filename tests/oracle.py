"""Runs a query and its SQL side by side: python -m tests.oracle SF_DIR [NAME...]."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path


def connection(sf_dir: str):
    import duckdb

    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        source = f"{path}/*.parquet" if path.is_dir() else str(path)
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{source}')")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else format(value, ".9g")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if hasattr(value, "asDict"):
        return tuple((k, plain(v)) for k, v in value.asDict().items())
    if hasattr(value, "as_integer_ratio") and not isinstance(value, (int, bool)):
        return plain(float(value))
    return value


def differences(spark, db, query, sql: str, sf_dir: str) -> str:
    ours = query(spark, sf_dir)
    theirs = db.execute(sql)
    names = [c[0] for c in theirs.description]
    if sorted(names) != sorted(ours.columns):
        return f"columns {sorted(ours.columns)} and {sorted(names)}"
    order = sorted(names)
    a = Counter(tuple(plain(r[c]) for c in order) for r in ours.collect())
    at = [names.index(c) for c in order]
    b = Counter(tuple(plain(r[k]) for k in at) for r in theirs.fetchall())
    if a == b:
        return ""
    return f"{sum(a.values())} and {sum(b.values())} rows; only here {list((a - b).items())[:3]}; only there {list((b - a).items())[:3]}"


if __name__ == "__main__":
    import time

    import __spark_entry__ as entry
    from tandemtext.session import get_spark

    spark = get_spark()
    spark.sparkContext.setLogLevel("ERROR")
    db = connection(sys.argv[1])
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and not any(name.startswith(x) for x in sys.argv[2:]):
            continue
        t = time.time()
        try:
            out = differences(spark, db, query, sqls[name], sys.argv[1]) if name in sqls else f"rows {query(spark, sys.argv[1]).count()}"
        except Exception as e:  # noqa: BLE001
            out = f"ERROR {str(e)[:600]}"
        print(f"{name}: {out or 'equal'} ({time.time() - t:.1f} s)", flush=True)
