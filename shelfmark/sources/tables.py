"""Catalogued Parquet tables, one database per layer."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.dates import month_start, year_start
from shelfmark.schemas import LAYERS, TableSpec
from shelfmark.streaming.contracts import Contract
from shelfmark.streaming.ingest import read_ingested

_TRUNCATE = {"month": month_start, "year": year_start}
_COMMITTED = "_COMMITTED"
_TRACKED = "spark.sql.hive.manageFilesourcePartitions"
_KEPT = 2  # versions of a replaced table: the current one, and the one that queries may still read


def _number(version: str) -> int:
    """The number of a replacement, by its folder's name."""
    return int(version.rsplit("/", 1)[-1].split("-")[0])


class Lakehouse:
    """The tables of one catalog.

    `prefix` goes before the database names; `location` is the folder of the databases, by default
    the session's warehouse. Each table has a folder there, and a catalog that forgets its tables
    when its process ends gets them from those folders again.

    Rows are shuffled to their partition before they are written, for few full files; Spark splits a
    partition that holds much more than the others. Rows of a bronze table are left in the tasks
    they are in if these have them about in date order, which is measured: rows in date order lie
    in fewer (task, partition) pairs, each of which becomes a file, than there are tasks and
    partitions together; up to twice as many are written as they are. `rebalance` decides it
    instead of the measurement.

    A table's rows lie in its folder until it is replaced for the first time. Each replacement is
    written to a folder of its own beside it, gets a marker when it is whole, and only then does
    the table's location change; so a failure at any point leaves the old rows or the new ones. The
    last replacement that has its marker is the table, also for a process that comes later.
    """

    def __init__(
        self,
        spark: SparkSession,
        location: str | None = None,
        prefix: str = "",
        rebalance: bool | None = None,
    ) -> None:
        self.spark = spark
        self.location = location.rstrip("/") if location else None
        self.prefix = prefix
        self.rebalance = rebalance

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def table_name(self, spec: TableSpec) -> str:
        return f"{self.database(spec.layer)}.{spec.name}"

    def ensure_databases(self) -> None:
        for layer in LAYERS:
            self._ensure_database(layer)

    def _ensure_database(self, layer: str) -> None:
        name = self.database(layer)
        place = f" LOCATION '{self.location}/{name}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")

    def drop_databases(self) -> None:
        """Take the databases and their tables out of the catalog; the files stay."""
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")

    def folder(self, spec: TableSpec) -> str:
        """Where the table's files lie; its database must exist."""
        place = self.spark.catalog.getDatabase(self.database(spec.layer)).locationUri
        return f"{place.rstrip('/')}/{spec.name}"

    def events_folder(self, topic: str) -> str:
        """Where the messages of a stream lie, among the bronze tables."""
        self._ensure_database("bronze")
        place = self.spark.catalog.getDatabase(self.database("bronze")).locationUri
        return f"{place.rstrip('/')}/events-{topic}"

    def read_events(
        self,
        contract: Contract,
        rejects: bool = False,
        start: date | None = None,
        end: date | None = None,
    ) -> DataFrame:
        """The accepted (or rejected) messages of a stream, of the days from `start` to `end`."""
        folder = self.events_folder(contract.topic)
        return read_ingested(self.spark, folder, contract, rejects, start, end)

    def _path(self, path: str):
        """A path and its file system."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _has(self, path: str) -> bool:
        found, files = self._path(path)
        return files.exists(found)

    def _replacements(self, spec: TableSpec) -> list[str]:
        """The folders of all replacements, the latest last, whole or not."""
        found, files = self._path(f"{self.folder(spec)}-versions")
        if not files.exists(found):
            return []
        return sorted(status.getPath().toString() for status in files.listStatus(found))

    def current_folder(self, spec: TableSpec) -> str:
        """Where the rows of the table are: its last whole replacement, or its own folder."""
        whole = (v for v in reversed(self._replacements(spec)) if self._has(f"{v}/{_COMMITTED}"))
        return next(whole, self.folder(spec))

    def ensure_table(self, spec: TableSpec) -> None:
        """Create the table, with its derived partition column, if it is absent. Files that another
        process has written for it are its rows."""
        if self.spark.catalog.tableExists(self.table_name(spec)):
            self._follow(spec)
        else:
            self._create(spec, self.current_folder(spec))

    def _create(self, spec: TableSpec, folder: str) -> None:
        columns = [f"{f.name} {f.dataType.simpleString()}" for f in spec.schema]
        layout = ""
        if spec.partition:
            columns.append(f"{spec.partition_column} date")
            layout = f" PARTITIONED BY ({spec.partition_column})"
        with self._partitions_in_catalog(spec.layer != "gold"):
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.table_name(spec)} ({', '.join(columns)})"
                f" USING parquet{layout} LOCATION '{folder}'"
            )
        if self._tracks_partitions(spec) and self._has(folder):
            self.spark.sql(f"ALTER TABLE {self.table_name(spec)} RECOVER PARTITIONS")

    @contextmanager
    def _partitions_in_catalog(self, tracked: bool) -> Iterator[None]:
        """Whether tables created meanwhile have their partitions in the catalog. Those of a table
        that is replaced are found in its folder instead, so that its location is all that a
        replacement changes."""
        before = self.spark.conf.get(_TRACKED)
        self.spark.conf.set(_TRACKED, str(tracked).lower())
        try:
            yield
        finally:
            self.spark.conf.set(_TRACKED, before)

    def _described(self, spec: TableSpec, what: str) -> str | None:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table_name(spec)}")
        return next((r.data_type for r in rows.collect() if r.col_name == what), None)

    def _tracks_partitions(self, spec: TableSpec) -> bool:
        return self._described(spec, "Partition Provider") == "Catalog"

    def _follow(self, spec: TableSpec) -> None:
        """Let the table be its last whole replacement, if it has one."""
        if not self._replacements(spec):
            return
        folder = self.current_folder(spec)
        stored = self._described(spec, "Location") or ""
        if self._path(stored)[0].getName() == self._path(folder)[0].getName():
            return
        if self._tracks_partitions(spec):  # the files say what it is, should this be cut short
            self.spark.sql(f"DROP TABLE {self.table_name(spec)}")
            self._create(spec, folder)
        else:
            self.spark.sql(f"ALTER TABLE {self.table_name(spec)} SET LOCATION '{folder}'")

    def table(self, spec: TableSpec) -> DataFrame:
        """The table as it is stored, partition column included."""
        if not self.spark.catalog.tableExists(self.table_name(spec)):
            self._ensure_database(spec.layer)
            if self._has(self.current_folder(spec)):
                self.ensure_table(spec)
        else:
            self._follow(spec)
        return self.spark.table(self.table_name(spec))

    def append(
        self,
        df: DataFrame,
        spec: TableSpec,
        like: TableSpec | None = None,
        part: DataFrame | None = None,
    ) -> int:
        """Add the rows, matched by column name; returns how many there were.

        `part` is a part of raw rows that is cheaper to read, for the measurement of their order.

        `like` is the table whose rows these are, one for one and in its files' order. If it has the
        same partitions, every task already holds rows of one or two of them, and nothing is
        shuffled.
        """
        placed = like is not None and like.partition == spec.partition
        rows, counted = self._rows(df, spec, placed, part)
        self._follow(spec)
        rows.write.insertInto(self.table_name(spec))
        return counted.get["rows"]

    def overwrite(self, df: DataFrame, spec: TableSpec) -> int:
        """Replace all rows, keeping the declared schema; returns how many there are now.

        `df` may read the table itself. Replacements older than the last but one are deleted.
        """
        rows, counted = self._rows(df, spec)
        before = self._replacements(spec)
        number = 1 + max((_number(v) for v in before), default=0)
        folder = f"{self.folder(spec)}-versions/{number:08d}-{uuid.uuid4().hex}"
        writer = rows.write
        if spec.partition:
            writer = writer.partitionBy(spec.partition_column)
        writer.parquet(folder)
        marker, files = self._path(f"{folder}/{_COMMITTED}")
        files.create(marker).close()
        self._follow(spec)
        if number >= _KEPT:
            stale = [v for v in before if _number(v) <= number - _KEPT]
            for old in [*stale, self.folder(spec)]:
                path, files = self._path(old)
                files.delete(path, True)
        return counted.get["rows"]

    def read(
        self, spec: TableSpec, start: date | None = None, end: date | None = None
    ) -> DataFrame:
        """The declared columns. `start` and `end` (inclusive) bound the partition date, and prune
        the partitions outside."""
        bounded = start is not None or end is not None
        if bounded and not spec.partition:
            raise ValueError(f"{spec.layer}.{spec.name} has no partition date")
        df = self.table(spec)
        if not bounded:
            return df.select(spec.schema.names)
        source, unit = spec.partition
        part, day = F.col(spec.partition_column), F.to_date(source)
        if start is not None:
            df = df.where((part >= _TRUNCATE[unit](F.lit(start))) & (day >= F.lit(start)))
        if end is not None:
            df = df.where((part <= _TRUNCATE[unit](F.lit(end))) & (day <= F.lit(end)))
        return df.select(spec.schema.names)

    def _shuffled(self, df: DataFrame, spec: TableSpec) -> bool:
        """Whether rows go to their partition before they are written: see above."""
        if self.rebalance is not None:
            return self.rebalance
        source, unit = spec.partition
        pairs = df.select(F.spark_partition_id().alias("task"), _TRUNCATE[unit](source).alias("part"))
        seen = pairs.distinct().agg(
            F.count(F.lit(1)).alias("pairs"),
            F.count_distinct("task").alias("tasks"),
            F.count_distinct(F.coalesce(F.col("part").cast("string"), F.lit(""))).alias("parts"),
        ).first()
        return seen.pairs > 2 * (seen.tasks + seen.parts)

    def _rows(
        self,
        df: DataFrame,
        spec: TableSpec,
        placed: bool = False,
        part: DataFrame | None = None,
    ) -> tuple[DataFrame, Observation]:
        """The rows as they are stored, and their number, counted while they are written."""
        expected, given = set(spec.schema.names), set(df.columns)
        if expected != given:
            raise ValueError(
                f"{spec.layer}.{spec.name}: missing columns {sorted(expected - given)},"
                f" unknown columns {sorted(given - expected)}"
            )
        rows = df.to(spec.schema)
        if spec.partition:
            source, unit = spec.partition
            rows = rows.withColumn(spec.partition_column, _TRUNCATE[unit](source))
            if not placed and (spec.layer != "bronze" or self._shuffled(df if part is None else part, spec)):
                rows = rows.hint("rebalance", spec.partition_column)
        counted = Observation(f"rows_{uuid.uuid4().hex}")
        return rows.observe(counted, F.count(F.lit(1)).alias("rows")), counted
