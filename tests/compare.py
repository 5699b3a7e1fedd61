"""Compare a Spark result with a DuckDB result as bags of rows, columns by name."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _value(v):
    return round(v, 9) if isinstance(v, float) else v


def bag(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_value(row[i]) for i in order) for row in rows)


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    cursor = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in cursor.description}
    names, expected = bag(list(duck_types), cursor.fetchall())
    got_names, got = bag(spark_df.columns, spark_df.collect())
    if names != got_names:
        return [f"columns {got_names} instead of {names}"]
    found = []
    for name, kind in spark_df.dtypes:
        if _KINDS.get(kind, kind) != duck_types[name]:
            found.append(f"type of {name}: {kind} against {duck_types[name]}")
    if got != expected:
        extra, absent = got - expected, expected - got
        found.append(f"{sum(extra.values())} rows too many, {sum(absent.values())} absent of {sum(expected.values())}")
        found += [f"+ {row}" for row in list(extra)[:2]] + [f"- {row}" for row in list(absent)[:2]]
    return found
