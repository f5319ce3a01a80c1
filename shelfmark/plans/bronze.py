"""Raw rows to bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.audit import stamped


def sales(raw: DataFrame) -> DataFrame:
    return stamped(raw)


def returns(raw: DataFrame) -> DataFrame:
    return stamped(raw)


def promotions(raw: DataFrame) -> DataFrame:
    return stamped(
        raw.withColumns({c: F.to_date(c) for c in ("start_date", "end_date")})
    )
