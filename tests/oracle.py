"""Compare a Spark result with its DuckDB counterpart, independent of row and column order."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _normal(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = []
    for record in frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist():
        rows.append(tuple(_cell(v) for v in record))
    return sorted(rows, key=repr)


def _cell(value):
    if value is None:
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10]
    if isinstance(value, float) and value.is_integer() and abs(value) < 1e15:
        return int(value)
    return value


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> list[str]:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return [f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"]
    left, right = _normal(spark_frame), _normal(sql_frame)
    if len(left) != len(right):
        return [f"rows {len(left)} / {len(right)}"]
    return [f"{a} / {b}" for a, b in zip(left, right) if a != b][:3]


def kinds(spark_schema, description) -> list[str]:
    """Column types that differ between the two results."""
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "date": "DATE", "boolean": "BOOLEAN",
    }
    sql = {name: str(kind) for name, kind in description}
    return [
        f"{f.name}: {f.dataType.simpleString()} / {sql.get(f.name)}"
        for f in spark_schema.fields
        if same.get(f.dataType.simpleString()) != sql.get(f.name)
    ]
