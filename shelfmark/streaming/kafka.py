"""The same messages on Kafka, as Avro with a schema-registry header.

Needs the spark-sql-kafka and spark-avro packages on the cluster; nothing else here imports this.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.streaming.contracts import RAW, Contract

# One magic byte and a four-byte schema id precede the Avro body.
_HEADER_BYTES = 5
_AVRO_TYPES = {"string": "string", "double": "double", "bigint": "long"}


def avro_schema(contract: Contract) -> str:
    """The contract as an Avro record schema."""
    fields = []
    for name, wire_type in contract.fields.items():
        avro_type: object = _AVRO_TYPES[wire_type]
        if name in contract.enums:
            avro_type = {
                "type": "enum",
                "name": f"{contract.topic}_{name}",
                "symbols": list(contract.enums[name]),
            }
        elif name == contract.time_field:
            avro_type = {"type": "long", "logicalType": "timestamp-millis"}
        elif name in contract.optional:
            avro_type = ["null", avro_type]
        fields.append({"name": name, "type": avro_type})
    return json.dumps({"type": "record", "name": f"{contract.topic}_event", "fields": fields})


def kafka_stream(
    spark: SparkSession, contract: Contract, bootstrap_servers: str, **options: str
) -> DataFrame:
    """Messages of the contract's topic, in its wire types, from the earliest one kept unless
    `startingOffsets` says otherwise. A body that is not Avro of the contract gives NULL fields, so
    the contract check rejects it; `_raw` has the body in base 64."""
    from pyspark.sql.avro.functions import from_avro

    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", contract.topic)
        .options(**{"startingOffsets": "earliest", **options})
        .load()
    )
    body = F.expr(f"substring(value, {_HEADER_BYTES + 1})")
    event = from_avro(body, avro_schema(contract), {"mode": "PERMISSIVE"})
    fields = raw.select(event.alias("event"), F.base64("value").alias(RAW)).select("event.*", RAW)
    return fields.withColumn(contract.time_field, F.unix_millis(contract.time_field))
