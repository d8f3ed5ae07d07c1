"""Compare every query with its SQL on one scale: python tests/check_oracles.py [dir] [name...]"""

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, db, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got), None
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    want = normal(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return len(got), f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        g, w = set(got), set(want)
        return len(got), f"{len(got)} vs {len(want)} rows; only here {list(g - w)[:2]}; only SQL {list(w - g)[:2]}"
    return len(got), None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    db, oracles = connect(sf), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            n, fault = compare(spark, db, name, query, oracles.get(name), sf)
        except Exception as error:
            n, fault = -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += fault is not None
        print(f"{name:26s} {n:8d} {time.time() - started:6.1f}s {'ok' if fault is None else 'FAIL ' + fault}", flush=True)
    print("failed:", bad)
