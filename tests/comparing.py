"""Exact comparison of a Spark result with the DuckDB result of its SQL."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _type_name(dtype: pa.DataType) -> str:
    if pa.types.is_timestamp(dtype):
        return "timestamp"
    if pa.types.is_string(dtype) or pa.types.is_large_string(dtype) or "string_view" in str(dtype):
        return "string"
    return str(dtype)


def _rows(table: pa.Table) -> Counter:
    columns = []
    for name in sorted(table.column_names):
        column = table.column(name)
        if pa.types.is_timestamp(column.type):
            column = column.cast(pa.timestamp("us", column.type.tz)).cast(pa.int64())
        columns.append(column.to_pylist())
    return Counter(zip(*columns))


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: column names, types, or the multiset of rows; empty when all is equal."""
    left = spark_df.toArrow()
    right = con.sql(sql).to_arrow_table()
    types = [
        {f.name: _type_name(f.type) for f in table.schema} for table in (left, right)
    ]
    found = []
    if types[0] != types[1]:
        found.append(f"columns {types[0]} != {types[1]}")
        return found
    ours, theirs = _rows(left), _rows(right)
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        found.append(
            f"rows {left.num_rows} vs {right.num_rows}; {sum(extra.values())} only in Spark, such as"
            f" {list(extra)[:3]}; {sum(missing.values())} only in SQL, such as {list(missing)[:3]}"
        )
    if left.num_rows == 0:
        found.append("no rows")
    return found
