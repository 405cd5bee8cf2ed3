"""Compare Spark and DuckDB results over the same Parquet files."""

from __future__ import annotations

import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame, types as T


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "tzinfo"):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple], list[str]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = [str(d[1]) for d in cur.description]
    return sorted(names), rows_of(names, cur.fetchall()), [k for _, k in sorted(zip(names, kinds))]


# Spark type -> DuckDB type names that read back as the same values.
SAME = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "timestamp": {"TIMESTAMP"}, "timestamp_ntz": {"TIMESTAMP"}, "boolean": {"BOOLEAN"},
}


def type_mismatches(df: DataFrame, kinds: list[str]) -> list[str]:
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return [
        f"{f.name}: {f.dataType.simpleString()} vs {kind}"
        for f, kind in zip(fields, kinds)
        if kind not in SAME.get(f.dataType.simpleString(), {kind})
    ]
