"""Runs a query and its SQL over the same tables and compares rows; also a command: python -m tests.oracle [DIR] NAME..."""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(name: str = "tests", cpus: str = "8"):
    from pyspark.sql import SparkSession

    here = os.environ.get("SPARK_TEST_DIR") or f"/tmp/spark-{os.getpid()}"
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g").config("spark.local.dir", here)
        .config("spark.sql.warehouse.dir", f"{here}/warehouse").config("spark.checkpoint.dir", f"{here}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str = SF):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return con


def plain(x):
    if isinstance(x, Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9) + 0.0
    if isinstance(x, dict):
        return tuple((k, plain(v)) for k, v in x.items())
    if hasattr(x, "asDict"):
        return tuple((k, plain(v)) for k, v in x.asDict().items())
    if isinstance(x, (list, tuple)):
        return tuple(plain(v) for v in x)
    return bytes(x) if isinstance(x, bytearray) else x


def compare(spark, query, sql: str, sf_dir: str = SF) -> str:
    """Empty if both give the same columns and rows, else what differs."""
    con = duck(sf_dir)
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    df = query(spark, sf_dir)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    order = sorted(names)
    got = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    exp = Counter(tuple(plain(r[names.index(c)]) for c in order) for r in want.fetchall())
    if got == exp:
        return "" if got else "no rows"
    a, b = got - exp, exp - got
    return f"{sum(got.values())} and {sum(exp.values())} rows; only Spark {sum(a.values())}: {list(a)[:2]}; only SQL {sum(b.values())}: {list(b)[:2]}; columns {order}"


if __name__ == "__main__":
    import __spark_entry__ as e

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else SF
    spark, qs, sqls = session(), e.queries(), e.oracle_sql()
    bad = 0
    for k in [k for k in qs if not args or any(k.startswith(a) for a in args)]:
        t = time.time()
        try:
            said = compare(spark, qs[k], sqls[k], sf) if k in sqls else f"({qs[k](spark, sf).count()} rows, no SQL)"
        except Exception as x:  # a report of every query is wanted
            said = f"{type(x).__name__}: {str(x)[:1500]}"
        bad += bool(said) and not said.startswith("(")
        print(f"{'ok' if not said or said.startswith('(') else 'BAD'} {k} {time.time() - t:.1f}s {said}", flush=True)
    sys.exit(bad > 0)
