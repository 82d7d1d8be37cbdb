"""Compare a Spark result with a DuckDB result: columns, types, rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def differences(spark_df: DataFrame, sql_result: duckdb.DuckDBPyRelation) -> str | None:
    """None when equal, else what differs."""
    order = sorted(spark_df.columns)
    if order != sorted(sql_result.columns):
        return f"columns {order} / {sorted(sql_result.columns)}"
    types = dict(zip(sql_result.columns, map(str, sql_result.types)))
    for name, dtype in spark_df.dtypes:
        if TYPES.get(dtype, dtype) != types[name]:
            return f"type of {name}: {dtype} / {types[name]}"
    ours = [tuple(_cell(row[c]) for c in order) for row in spark_df.collect()]
    at = [sql_result.columns.index(c) for c in order]
    theirs = [tuple(_cell(row[i]) for i in at) for row in sql_result.fetchall()]
    if Counter(ours) == Counter(theirs):
        return None
    more, less = Counter(ours) - Counter(theirs), Counter(theirs) - Counter(ours)
    show = [str(row)[:300] for row in list(more)[:2]], [str(row)[:300] for row in list(less)[:2]]
    return f"{len(ours)} / {len(theirs)} rows; only spark {sum(more.values())} {show[0]}; only sql {show[1]}"
