"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import scratch_dir

# What separates the words of the decontamination rule: ASCII that is neither a digit nor a lower-case letter.
# A-Z maps to a-z first; bytes from 0x80 on belong to words.
FOLDED = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def spaced_words(raw: bytes | None) -> list[bytes]:
    """Words between ASCII white space (\\x20, \\x09-\\x0D), as they are."""
    return raw.split() if raw else []


def lower_words(raw: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased; other letters stay."""
    return raw.lower().split() if raw else []


def folded_words(raw: bytes | None) -> list[bytes]:
    """Lower-cased runs of digits, letters a-z and all that is not ASCII."""
    return raw.translate(FOLDED).split() if raw else []


def remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of a key's text, modulo; NULL for a NULL key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string").cast("binary")) % modulus


def held_out(key: str | Column, modulus: int, value: int) -> Column:
    """Whether a row is kept from learning: its remainder is `value`. Rows without a key are held out."""
    return F.coalesce(remainder(key, modulus) == value, F.lit(True))


def materialise(frame: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write a table to the shared scratch folder and read it again: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    frame.write.option("compression", compression).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors' Python, once an application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="shelfmark-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as to:
            for module in sorted(package.rglob("*.py")):
                to.write(module, module.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(application)


Batches = Iterator[pa.RecordBatch]


def in_batches(frame: DataFrame, run: Callable[[Batches], Batches], schema: Any) -> DataFrame:
    """mapInArrow with this package on the executors. Workers live on after a task, so what Arrow holds unused then goes back."""

    def task(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    ship_package(frame.sparkSession)
    return frame.mapInArrow(task, schema)


SLICE_ROWS = 512


def sliced(batches: Batches) -> Batches:
    """The same rows in smaller batches, so that what Python makes of one stays small."""
    for batch in batches:
        for i in range(0, len(batch), SLICE_ROWS):
            yield batch.slice(i, SLICE_ROWS)


def per_row(
    frame: DataFrame,
    row: Callable[..., tuple],
    inputs: list[str],
    outputs: str,
    setup: Callable[[], Any] | None = None,
    gone: tuple[str, ...] = (),
) -> DataFrame:
    """The frame with columns added by a Python function of some of its columns, in Arrow batches.

    `outputs` is a schema string; an added column replaces one of the same name, and columns in `gone` don't come back. `row` gets the values of
    `inputs`, after the result of `setup` (called once a task) if that is given, and returns a tuple.
    Memory is bounded by an Arrow batch, which Spark bounds by rows and bytes.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(outputs)
    kept = [c for c in frame.columns if c not in added.names and c not in gone]
    schema = StructType([*(frame.schema[c] for c in kept), *added.fields])
    types = list(to_arrow_schema(added))

    def run(batches: Batches) -> Batches:
        state = (setup(),) if setup else ()
        for batch in sliced(batches):
            columns = [batch.column(c).to_pylist() for c in inputs]
            results = [row(*state, *values) for values in zip(*columns, strict=True)]
            made = [
                pa.array([r[i] for r in results], type=field.type) for i, field in enumerate(types)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *made], names=[*kept, *added.names]
            )

    return in_batches(frame, run, schema)


def tucked(frame: DataFrame, used: list[str]) -> DataFrame:
    """The columns an operator uses, and the others in one struct `_rest`, where their names clash with nothing."""
    rest = [F.col(f"`{c}`") for c in frame.columns if c not in used]
    return frame.select(*used, (F.struct(*rest) if rest else F.lit(0)).alias("_rest"))


def untucked(frame: DataFrame, columns: list[str], used: list[str]) -> list[Column]:
    """The columns of the frame that `tucked` got, in their order."""
    return [F.col(c) if c in used else F.col("_rest").getField(c).alias(c) for c in columns]
