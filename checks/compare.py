"""Run registered queries and their SQL side by side and compare them value for value.

    python -m checks.compare FOLDER [NAME ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, Decimal):
        return str(value)
    return value


def _sorted(rows, order):
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(v is None, str(v)) for v in row])


def spark_rows(df):
    names = df.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], _sorted([tuple(r) for r in df.collect()], order)


def sql_rows(connection, statement):
    result = connection.execute(statement)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], _sorted(result.fetchall(), order)


def sql_types(connection, statement) -> dict[str, str]:
    rows = connection.execute(f"describe {statement}").fetchall()
    return {row[0]: row[1].lower() for row in rows}


# Names of the same types in the two engines.
SAME_TYPES = {"int": "integer", "bigint": "bigint", "string": "varchar", "date": "date",
              "timestamp": "timestamp", "boolean": "boolean"}


def difference(df, connection, statement) -> str:
    """Empty if both agree in names, types and values; else what differs."""
    ours, theirs = spark_rows(df), sql_rows(connection, statement)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    kinds = sql_types(connection, statement)
    for name, kind in df.dtypes:
        if SAME_TYPES.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} / {kinds[name]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} / {len(theirs[1])} rows"
    wrong = [pair for pair in zip(ours[1], theirs[1]) if pair[0] != pair[1]]
    return f"{len(wrong)} rows differ, first {wrong[0]} under {ours[0]}" if wrong else ""


def main(folder: str, wanted: list[str]) -> int:
    from checks import oracle, queries
    from starloom.session import local_session

    spark = local_session("compare", **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(folder), 0
    statements = oracle.statements()
    for name, run in queries.registered().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            text = difference(run(spark, folder), connection, statements[name])
        except Exception as error:  # report and go on with the next query
            text = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(text)
        print(f"{'BAD ' if text else 'ok  '} {name} {time.time() - start:.1f}s {text}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
