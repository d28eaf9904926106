"""Compare registered queries with their SQL twins; also a command: ``python tests/oracle_check.py DIR [names]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _normal(row: tuple) -> tuple:
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row)


def _type(name: str) -> str:
    names = {
        "bigint": "long", "integer": "int", "varchar": "string", "timestamp": "timestamp_ntz",
        "bool": "boolean", "boolean": "boolean",
    }
    return names.get(name.lower(), name.lower())


def differences(ours, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL result: columns, types, rows as a bag."""
    relation = connection.sql(sql)
    columns = sorted(relation.columns)
    if sorted(ours.columns) != columns:
        return [f"columns {sorted(ours.columns)} against {columns}"]
    problems = []
    theirs = dict(zip(relation.columns, relation.types))
    for field in ours.schema.fields:
        mine = field.dataType.simpleString().replace("bigint", "long")
        if mine != _type(str(theirs[field.name])):
            problems.append(f"{field.name} is {mine} against {theirs[field.name]}")
    order = ", ".join(f'"{c}"' for c in columns)
    expected = sorted((_normal(r) for r in connection.sql(f"SELECT {order} FROM ({sql})").fetchall()), key=repr)
    found = sorted((_normal(tuple(r)) for r in ours.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    if len(found) != len(expected):
        problems.append(f"{len(found)} rows against {len(expected)}")
    unequal = [(f, e) for f, e in zip(found, expected) if f != e]
    if unequal:
        problems.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from meterlake.session import local_session

    spark = local_session(8)
    connection = connect(sf_dir)
    oracles, failed = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        if name in oracles:
            problems = differences(query(spark, sf_dir), connection, oracles[name])
            state = "ok" if not problems else f"DIFFERS {problems}"
            failed += bool(problems)
        else:
            state = f"{query(spark, sf_dir).count()} rows, no SQL"
        print(f"{name:30s} {time.time() - start:6.2f}s {state}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
