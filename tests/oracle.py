"""Run registered queries beside their SQL in DuckDB and compare.

As a program:  python tests/oracle.py SF_DIR [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        f = float(v)
        return repr(0.0 if f == 0 else f)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir):
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    got = df.collect()
    if sql is None:
        return None if got else "no rows"
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    want = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return f"rows {len(a)} / {len(b)}; only spark {only_a}; only sql {only_b}"
    return None


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cores}]").appName("tabulon-check")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as e

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    sql, bad = e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if wanted and name not in wanted:
            continue
        t0 = time.time()
        try:
            diff = compare(spark, con, fn, sql.get(name), sf_dir)
        except Exception as err:  # report and go on with the next query
            diff = f"{type(err).__name__}: {str(err)[:700]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name:28s} {time.time() - t0:6.2f}s"
              f"{'' if name in sql else '  (rows only)'}{'' if diff is None else '  ' + diff[:1200]}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main()))
