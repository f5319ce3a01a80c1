"""Raw CSV with a header row."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfmark.schemas import TableSpec


def literal_path(uri: str) -> str:
    """One of a frame's input files as a path that reads just that file."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    spec: TableSpec,
    infer: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """All files under `path` (a file, a directory, a glob, or several) in the types of `spec`.

    Columns are found by their header name, in any order, so the first header is read up front; a
    later file with another header is an error. By default values are parsed straight to the
    declared types and a malformed one fails the read (mode="PERMISSIVE" turns it into NULL). With
    `infer` Spark reads everything once more to guess the types, and then casts.
    """
    reader = spark.read.option("header", True)
    if infer:
        raw = reader.option("inferSchema", True).csv(path)
        _check_columns(raw.columns, spec)
        return raw.to(spec.raw_schema)

    header = reader.csv(path).columns
    _check_columns(header, spec)
    in_file_order = T.StructType([spec.raw_schema[name] for name in header])
    raw = reader.schema(in_file_order).option("mode", mode).option("enforceSchema", False).csv(path)
    return raw.select(spec.raw_schema.names)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a directory of CSV files with headers."""
    df.write.option("header", True).csv(path)


def _check_columns(header: list[str], spec: TableSpec) -> None:
    expected = set(spec.raw_schema.names)
    if set(header) != expected:
        raise ValueError(
            f"{spec.layer}.{spec.name}: missing columns {sorted(expected - set(header))},"
            f" unknown columns {sorted(set(header) - expected)}"
        )
