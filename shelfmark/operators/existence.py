"""Does a key exist on the other side: the referential check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def existence_flag(rows: DataFrame, keys: DataFrame, on: str, flag: str) -> DataFrame:
    """Add BOOLEAN `flag`: the text key `on` of the row occurs in `keys`. Rows never multiply; a NULL key
    occurs nowhere.

    The rows are read and shuffled once, to the distinct keys. Where a key has many rows, Spark
    splits them over tasks at run time, which it does only if both sides of the join come straight
    from a shuffle of their own. The distinct keys would come from the shuffle that made them
    distinct; appending nothing to them makes them another expression, so they are shuffled again:
    one column, one row a key.
    """
    known = keys.where(F.col(on).isNotNull()).select(on).distinct()
    known = known.select(F.concat(F.col(on), F.lit("")).alias("_known_key"))
    joined = rows.join(known, F.col(on) == F.col("_known_key"), "left")
    return joined.withColumn(flag, F.col("_known_key").isNotNull()).drop("_known_key")
