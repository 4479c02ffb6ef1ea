"""Compare queries with their SQL oracles: names, types, rows and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(spark, connection, folder: str, name: str, build, sql: str) -> list[str]:
    frame = build(spark, folder)
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    kinds = {column[0]: str(column[1]) for column in result.description}
    problems = []
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} vs {sorted(columns)}"]
    for column, kind in frame.dtypes:
        if _TYPES.get(kind) != kinds[column]:
            problems.append(f"type of {column}: {kind} vs {kinds[column]}")
    ours = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    theirs = _rows(columns, result.fetchall())
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        problems.append(
            f"rows {sum(ours.values())} vs {sum(theirs.values())}; only ours {sum(only_ours.values())} "
            f"{list(only_ours)[:2]}; only oracle {sum(only_theirs.values())} {list(only_theirs)[:2]}")
    return problems


def main() -> None:
    import __spark_entry__ as driver
    from meseta.session import build_session

    plain, (folder, *wanted) = "--plain" in sys.argv, [a for a in sys.argv[1:] if a != "--plain"]
    if plain:  # a session with Spark's own defaults
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    else:
        spark = build_session("oracle", spark__master="local[8]", spark__sql__shuffle__partitions="8",
                              spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                              spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles = driver.oracle_sql()
    failed = 0
    for name, build in driver.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            problems = differences(spark, connection, folder, name, build, oracles[name]) if name in oracles \
                else [] if build(spark, folder).count() >= 0 else ["?"]
        except Exception as error:  # noqa: BLE001 - report every query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.1f}s", *problems, sep="\n     "
              if problems else " ", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
