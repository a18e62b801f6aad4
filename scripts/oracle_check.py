"""Run every registered query on Spark and its oracle SQL on DuckDB; compare.

    python scripts/oracle_check.py [sf_dir] [name ...]

Comparison is order-insensitive on columns sorted by name: row count, column
names/types family, and the multiset of rows (doubles exact unless noted).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from thermoflux.plans import ORACLE_SQL, QUERIES  # noqa: E402
from thermoflux.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    return v


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(ORACLE_SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    scols = sdf.columns
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={scols} duck={dcols}"
    a, b = rows_of(srows, scols), rows_of(drows, dcols)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. {bad[:3]}"
    return True, f"{len(a)} rows, spark {t1 - t0:.2f}s"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    if os.environ.get("ORACLE_PLAIN_SESSION"):
        # As the driver runs it: a bare session, none of get_session's settings;
        # ORACLE_PLAIN_SESSION names the session time zone to use (e.g. Asia/Kolkata).
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", os.environ["ORACLE_PLAIN_SESSION"]).getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_session()
    con = duck(sf_dir)
    ok_all = True
    for n in names:
        if n not in ORACLE_SQL:
            print(f"{n:22s} (no oracle)")
            continue
        try:
            ok, msg = compare(spark, con, sf_dir, n)
        except Exception as exc:  # report and continue
            ok, msg = False, f"error: {type(exc).__name__}: {str(exc)[:400]}"
        ok_all &= ok
        print(f"{n:22s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    return 0 if ok_all else 1


if __name__ == "__main__":
    raise SystemExit(main())
