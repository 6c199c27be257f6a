"""Queries against their oracles: ``python tests/compare.py [sf] [query ...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    return f"{value:.9g}" if isinstance(value, float) and not math.isnan(value) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, con, sf_dir, query, sql):
    """None if both agree, else a description."""
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    columns, expected = rows_of(rel.columns, rel.fetchall())
    if got_columns != columns:
        return f"columns {got_columns} and {columns}"
    if got != expected:
        only_got = [r for r in set(got) - set(expected)][:3]
        only_expected = [r for r in set(expected) - set(got)][:3]
        return f"{len(got)} and {len(expected)} rows; only Spark {only_got}; only SQL {only_expected}"
    return None if got else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from webloom.session import local_session

    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, bad = connect(sf), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name not in oracles:  # tested against brute force
                rows = query(spark, sf).count()
                print(f"{name:24s} {time.time() - start:6.1f}s {rows} rows, no SQL", flush=True)
                continue
            problem = difference(spark, connection, sf, query, oracles[name])
        except Exception as error:  # keep going, report all
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:24s} {time.time() - start:6.1f}s {problem or 'equal'}", flush=True)
    print("differences:", bad)
