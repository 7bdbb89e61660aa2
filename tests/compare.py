"""Compares registered queries with their SQL on one data folder."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    """Values of both engines in one comparable form."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    try:
        number = float(value)
    except (TypeError, ValueError):
        return str(value)
    return 0.0 if number == 0 else number


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(found, key=repr)


def differences(spark_df, connection, sql: str) -> str | None:
    """None when equal, else a short description."""
    cursor = connection.execute(sql)
    expected_names, expected = table([c[0] for c in cursor.description], cursor.fetchall())
    names, rows = table(spark_df.columns, spark_df.collect())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    bad = [(a, b) for a, b in zip(rows, expected) if a != b]
    return f"{len(bad)} of {len(rows)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    from workload.oracles import ORACLES
    from workload.queries import QUERIES

    folder, chosen = sys.argv[1], [a for a in sys.argv[2:] if "=" not in a] or list(QUERIES)
    settings = dict(a.split("=") for a in sys.argv[2:] if "=" in a)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for key, value in settings.items():
        spark.conf.set(key, value)
    connection = duck(folder)
    for name in chosen:
        start = time.time()
        try:
            result = QUERIES[name](spark, folder)
            if name in ORACLES:
                outcome = differences(result, connection, ORACLES[name]) or "ok"
            else:
                outcome = f"{len(result.collect())} rows, no sql"
        except Exception as error:  # noqa: BLE001
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name}: {outcome} ({time.time() - start:.1f}s)", flush=True)
