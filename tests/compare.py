"""Compare a Spark result with the SQL result of the same name."""

from __future__ import annotations

import datetime
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(df, con, sql: str) -> str | None:
    """None when columns, types and rows agree, else what differs."""
    relation = con.sql(sql)
    spark_types = {name: _KINDS.get(kind, kind) for name, kind in df.dtypes}
    sql_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    if set(spark_types) != set(sql_types):
        return f"columns: only spark {set(spark_types) - set(sql_types)}, only sql {set(sql_types) - set(spark_types)}"
    mine = _rows(df.columns, df.collect())
    theirs = _rows(relation.columns, relation.fetchall())
    if mine != theirs:
        left, right = mine - theirs, theirs - mine
        return (
            f"rows: spark {sum(mine.values())}, sql {sum(theirs.values())}; "
            f"columns {sorted(df.columns)}; only spark {list(left)[:2]}; only sql {list(right)[:2]}"
        )
    types = {c: (spark_types[c], sql_types[c]) for c in spark_types if spark_types[c] != sql_types[c]}
    return f"types: {types}" if types else None
