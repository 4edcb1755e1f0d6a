"""Runs registered queries on Spark and their SQL on DuckDB, and compares.

    python -m checks.verify [scale factor folder] [query ...]
"""

from __future__ import annotations

import collections
import sys
import time

import duckdb

from postpulse.session import build_session

from .oracle import oracle_sql
from .registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _rows(columns, rows) -> collections.Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(
        tuple(round(row[i], 9) if isinstance(row[i], float) else row[i] for i in order)
        for row in rows
    )


def compare(spark, connection, name: str, sf_dir: str) -> tuple[bool, str]:
    begun = time.time()
    df = QUERIES[name](spark, sf_dir)
    spark_rows = df.collect()
    took = time.time() - begun
    result = connection.execute(oracle_sql()[name])
    columns = [item[0] for item in result.description]
    types = {item[0]: str(item[1]) for item in result.description}
    ours, theirs = _rows(df.columns, spark_rows), _rows(columns, result.fetchall())
    same = sorted(df.columns) == sorted(columns) and ours == theirs
    note = f"{len(spark_rows)} rows, {took:.2f} s, {dict(df.dtypes)} / {types}"
    if not same:
        note += f"\n   spark only {list((ours - theirs).items())[:3]}"
        note += f"\n   sql only   {list((theirs - ours).items())[:3]}"
    return same, note


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "verify", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = []
    for name in names:
        try:
            same, note = compare(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            same, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if same else "FAIL", name, note, flush=True)
        if not same:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} equal", failed)


if __name__ == "__main__":
    main()
