"""Spark session and shared-folder settings."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# What results depend on: dates are cut in UTC, and bad casts and overflows raise.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.storeAssignmentPolicy": "ANSI",
}

# How plans run: re-plan at run time, split skewed shuffle partitions, and write timestamps so that
# filters on them reach the file statistics.
EXECUTION = {
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

LOCAL = {
    "spark.sql.shuffle.partitions": "16",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}

# Elsewhere, and only where the cluster has not said otherwise: merge what turns out small.
MERGED = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

# What a shuffle partition should hold before Spark merges or splits any.
_PARTITION_BYTES = 512 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_width(input_bytes: int) -> int:
    """Partitions to start a shuffle of so much data with: 200,000 for 100 TB."""
    return max(200, -(-input_bytes // _PARTITION_BYTES))


def build_session(
    app_name: str = "shelfmark",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """A session with the library's semantics; `conf` wins over the defaults. On a cluster,
    `input_bytes`, the size of what the job reads, sets how wide shuffles start."""
    builder = SparkSession.builder.appName(app_name)
    settings = {**SEMANTICS, **EXECUTION}
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings.update(LOCAL)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not is_local(spark):
        wide = {_INITIAL: str(shuffle_width(input_bytes))} if input_bytes else {}
        for key, value in {**MERGED, **wide}.items():
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


@cache
def _local_scratch_root() -> str:
    """A temporary folder of this process, for a local session; it goes when the process ends."""
    root = tempfile.mkdtemp(prefix="shelfmark-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named in spark.checkpoint.dir.

    Where that setting is absent a local session gets a temporary folder; on a cluster, where every
    executor must see the path, its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_scratch_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
