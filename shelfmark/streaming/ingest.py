"""Streams to bronze files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from shelfmark.functions.audit import INGESTION_TIME, stamped
from shelfmark.streaming.contracts import RAW, REASON, Contract, checked

ACCEPTED, DAY = "accepted", "event_day"


def file_stream(
    spark: SparkSession,
    path: str,
    contract: Contract,
    source_format: str = "parquet",
    max_files_per_trigger: int = 1000,
) -> DataFrame:
    """Messages that land as files in a folder, in the wire types of the contract.

    A JSON line that can't be read so has NULL fields, and is whole in `_raw`.
    """
    schema = contract.wire_schema
    reader = spark.readStream.format(source_format).option("maxFilesPerTrigger", max_files_per_trigger)
    if source_format == "json":
        schema = T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", RAW)
    return reader.schema(schema).load(path)


def ingest(messages: DataFrame, contract: Contract, target: str, checkpoint: str) -> StreamingQuery:
    """Start writing the messages to `target`: accepted and rejected ones, from one read.

    Takes what is there now, in as many batches as the source gives, and stops. The file sink and
    its checkpoint together write every message once, also when the query is started again. Files
    lie in one folder for the accepted and one for the rejected, and there in one per day of the
    message.
    """
    both = stamped(checked(messages, contract))
    return (
        both.withColumns(
            {ACCEPTED: F.col(REASON) == "", DAY: F.to_date(contract.time_field)}
        )
        .writeStream.format("parquet")
        .partitionBy(ACCEPTED, DAY)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_schema(contract: Contract) -> T.StructType:
    """What `ingest` stores: the message with its time as TIMESTAMP, the audit stamp, the reasons and
    raw value of a rejected one, and the two folder columns."""
    fields = [
        T.StructField(f.name, T.TimestampType() if f.name == contract.time_field else f.dataType)
        for f in contract.wire_schema
    ]
    return T.StructType(
        [
            *fields,
            T.StructField(REASON, T.StringType()),
            T.StructField(RAW, T.StringType()),
            T.StructField(INGESTION_TIME, T.TimestampType()),
            T.StructField(ACCEPTED, T.BooleanType()),
            T.StructField(DAY, T.DateType()),
        ]
    )


def read_ingested(
    spark: SparkSession,
    target: str,
    contract: Contract,
    rejects: bool = False,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """The accepted (or the rejected) messages that `ingest` has written so far, from the day `start`
    to the day `end`; other days' folders are not read. Nothing written yet gives no rows."""
    schema = stored_schema(contract)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        stored = spark.read.schema(schema).parquet(target)
    else:
        stored = spark.createDataFrame([], schema)
    chosen = stored.where(F.col(ACCEPTED) == (not rejects))
    if start is not None:
        chosen = chosen.where(F.col(DAY) >= F.lit(start))
    if end is not None:
        chosen = chosen.where(F.col(DAY) <= F.lit(end))
    hidden = [ACCEPTED, DAY] if rejects else [ACCEPTED, DAY, REASON, RAW]
    return chosen.drop(*hidden)
