"""Run registered queries next to their SQL in DuckDB: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(v):
        if isinstance(v, bool) or v is None:
            return v
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9) + 0.0
        return v
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, build, sql, sf_dir):
    df = build(spark, sf_dir)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    compare.spark_seconds = time.time() - compare.start
    if sql is None:
        return None, f"{len(got)} rows, no SQL"
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = normal(cursor.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}; first differing {next(((a, b) for a, b in zip(got, want) if a != b), None)}"
    types = [(a, b) for a, b in zip(got[:1], want[:1]) for a, b in zip(a, b) if type(a) is not type(b)]
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"
    return True, f"{len(got)} rows" + (f" TYPES {types}" if types else "")


compare.spark_seconds = 0.0


def main():
    import duckdb
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    oracles, failed = e.oracle_sql(), []
    for name, build in e.queries().items():
        if names and name not in names:
            continue
        start = compare.start = time.time()
        try:
            ok, note = compare(spark, connection, build, oracles.get(name), sf_dir)
        except Exception as error:  # report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        if ok is False:
            failed.append(name)
        print(f"{'FAIL' if ok is False else 'ok  '} {name:28s} {compare.spark_seconds:6.2f}s of {time.time() - start:6.2f}s {note}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
