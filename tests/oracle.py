"""Runs queries in Spark and their SQL in DuckDB, and compares the rows.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "date": "DATE", "boolean": "BOOLEAN"}


def compare(spark, con, run, sql, sf_dir):
    """None when equal, else a description of the difference."""
    df = run(spark, sf_dir)
    kinds = {c: KINDS.get(t, t) for c, t in df.dtypes}
    given = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if kinds != given:
        return f"types differ: {sorted(set(kinds.items()) ^ set(given.items()))}"
    sc, srows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    dc, drows = rows_of([c[0] for c in cur.description], cur.fetchall())
    if sc != dc:
        return f"columns differ: {sc} / {dc}"
    if srows != drows:
        only_s, only_d = srows - drows, drows - srows
        return (f"rows differ: {sum(srows.values())} / {sum(drows.values())}; "
                f"only Spark {list(only_s)[:2]}; only SQL {list(only_d)[:2]}")
    return None


def main(argv):
    from pyspark.sql import SparkSession
    import __spark_entry__ as e
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con, sqls, bad = duck(sf_dir), e.oracle_sql(), 0
    for name, run in e.queries().items():
        if argv[1:] and not any(name.startswith(a) for a in argv[1:]):
            continue
        t = time.time()
        try:
            if name not in sqls:
                print(f"rows {run(spark, sf_dir).count():8d} {time.time() - t:6.2f}s {name}")
                continue
            diff = compare(spark, con, run, sqls[name], sf_dir)
        except Exception as ex:
            diff = f"{type(ex).__name__}: {str(ex)[:800]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'BAD '} {time.time() - t:6.2f}s {name} {diff or ''}",
              flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
