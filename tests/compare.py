"""Compare a Spark result with the rows DuckDB finds for the same tables."""

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duckdb_on(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(normal(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(found, key=repr)


def spark_rows(frame):
    return rows_of(frame.columns, [tuple(row) for row in frame.collect()])


def duckdb_rows(connection, sql):
    result = connection.execute(sql)
    return rows_of([column[0] for column in result.description], result.fetchall())


def differences(frame, connection, sql):
    """What differs, as text; empty when names, types of values and rows agree."""
    names, rows = spark_rows(frame)
    wanted_names, wanted = duckdb_rows(connection, sql)
    if names != wanted_names:
        return f"columns {names} instead of {wanted_names}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows instead of {len(wanted)}"
    wrong = [(a, b) for a, b in zip(rows, wanted) if repr(a) != repr(b)]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else ""
