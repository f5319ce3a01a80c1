"""Load-time stamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INGESTION_TIME = "_ingestion_time"


def stamped(df: DataFrame) -> DataFrame:
    """Set the load time; one value for the whole query."""
    return df.withColumn(INGESTION_TIME, F.current_timestamp())
