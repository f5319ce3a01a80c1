"""What a message must look like to be accepted."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    """Message fields, as `name -> wire type`; times travel as milliseconds since the epoch."""

    topic: str
    fields: dict[str, str]
    time_field: str
    enums: dict[str, tuple[str, ...]] = field(default_factory=dict)
    optional: tuple[str, ...] = ()

    @property
    def wire_schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in self.fields.items()))

    @property
    def columns(self) -> list[str]:
        return list(self.fields)


# The two published message contracts.
CLICKSTREAM = Contract(
    topic="clickstream",
    fields={
        "event_id": "string",
        "user_id": "string",
        "session_id": "string",
        "page_url": "string",
        "event_type": "string",
        "event_time": "bigint",
        "device_type": "string",
    },
    time_field="event_time",
    enums={"event_type": ("view", "click", "add_to_cart", "purchase")},
    optional=("device_type",),
)
OFFERS = Contract(
    topic="offers",
    fields={
        "offer_id": "string",
        "user_id": "string",
        "promo_id": "string",
        "discount_pct": "double",
        "offer_time": "bigint",
        "status": "string",
    },
    time_field="offer_time",
    enums={"status": ("sent", "viewed", "accepted", "expired")},
)
CONTRACTS = {c.topic: c for c in (CLICKSTREAM, OFFERS)}


# Milliseconds of the first and the last moment of the years 1 to 9999, which files and dates hold.
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999
RAW, REASON = "_raw", "rejected_for"


def _in_range(millis: Column) -> Column:
    return F.coalesce(millis.between(FIRST_MILLIS, LAST_MILLIS), F.lit(False))


def violations(contract: Contract) -> Column:
    """Names of the fields that break the contract, comma-separated; empty for a good message."""
    broken = []
    for name in contract.columns:
        bad = F.lit(False) if name in contract.optional else F.col(name).isNull()
        if name in contract.enums:
            bad = bad | ~F.coalesce(F.col(name).isin(*contract.enums[name]), F.lit(False))
        if name == contract.time_field:
            bad = bad | ~_in_range(F.col(name))
        broken.append(F.when(bad, name))
    return F.concat_ws(",", *broken)


def typed(messages: DataFrame, contract: Contract) -> DataFrame:
    """The message time as TIMESTAMP; NULL where it is out of range."""
    millis = F.col(contract.time_field)
    kept = F.when(_in_range(millis), millis)
    return messages.withColumn(contract.time_field, F.timestamp_millis(kept))


def checked(messages: DataFrame, contract: Contract) -> DataFrame:
    """All messages, typed, with `rejected_for` (the broken fields; empty if none) and, where there
    are any, the message as it came in `_raw`: what the source gives there, else its fields as
    JSON. Works on batch and streaming frames alike."""
    fields = F.to_json(F.struct(*contract.columns), {"ignoreNullFields": "false"})
    came = F.coalesce(F.col(RAW).cast("string"), fields) if RAW in messages.columns else fields
    named = messages.withColumns({REASON: violations(contract), RAW: came})
    raw = F.when(F.col(REASON) != "", F.col(RAW))
    return typed(named, contract).select(*contract.columns, REASON, raw.alias(RAW))


def split_by_contract(messages: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) messages, typed; rejected ones have their broken fields and raw value."""
    both = checked(messages, contract)
    accepted = both.where(F.col(REASON) == "").drop(REASON, RAW)
    return accepted, both.where(F.col(REASON) != "")
