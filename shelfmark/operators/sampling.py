"""Exact-size random sample that is the same on every run and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import scratch_dir

# Hex digits of a hash per counting round: 16^4 = 65,536 groups at most.
_DIGITS = 4
# Copies of one row that a task makes at once.
_COPIES = 10_000


def _digits(digest: Column, turn: int) -> Column:
    """The turn-th few hex digits of a hash."""
    return F.substring(digest, 1 + turn * _DIGITS, _DIGITS)


def _boundary(rows: DataFrame, group: Column, times: Column, wanted: int):
    """The value of `group` that holds the `wanted`-th row in its order, how many rows of it are
    wanted, and how many it has. Only the groups' counts come to the driver."""
    counts = rows.groupBy(group.alias("value")).agg(F.sum(times).alias("rows")).toArrow()
    for value, n in sorted(zip(counts["value"].to_pylist(), counts["rows"].to_pylist()), key=_order):
        if wanted <= n:
            return value, wanted, n
        wanted -= n
    raise ValueError("the rows have changed since they were counted")


def _order(pair):
    """As Spark orders values: structs field by field, NULL first, text by its bytes."""

    def comparable(value):
        if isinstance(value, dict):
            return tuple(comparable(v) for v in value.values())
        return (value is not None, value.encode() if isinstance(value, str) else value)

    return comparable(pair[0])


def _spread(rows: DataFrame, times: Column) -> DataFrame:
    """Each row so many times; many copies of one are made by several tasks."""
    chunks = F.sequence(F.lit(0).cast("bigint"), F.ceil(times / _COPIES).cast("bigint") - 1)
    dealt = rows.withColumn("_times", times).withColumn("_chunk", F.explode(chunks))
    mine = F.least(F.lit(_COPIES), F.col("_times") - F.col("_chunk") * _COPIES)
    dealt = dealt.withColumn("_times", mine).repartition("_chunk")
    return dealt.withColumn("_chunk", F.explode(F.sequence(F.lit(1).cast("bigint"), "_times")))


def sample_exact(df: DataFrame, key: str, rate: float, seed: int) -> DataFrame:
    """max(1, floor(count * rate)) rows of `df`, without replacement.

    Rows are ordered by md5(key|seed), then key, then the md5 of the row as JSON, then that JSON; of
    identical rows as many are taken as are still wanted. Instead of sorting, the input is read
    three times: rows are counted per first four hex digits of the key's hash; the rows of the group
    that holds the last sampled one are written to the scratch folder, equal ones as one row and a
    number; and the sample is a filter on the groups before, and what that table has up to the last
    row. The last row is found there by counting the next digits of the key's hash, then keys (one
    in 2^32), then digits of the row's hash, then rows. No task ever holds more than its own input,
    also where one key or one row makes up most of the table. The counting runs when this is called.
    """
    if not 0 <= rate <= 1:
        raise ValueError("rate must be between 0 and 1")
    spark, one = df.sparkSession, F.lit(1)
    digest = F.md5(F.concat_ws("|", F.col(key), F.lit(seed)))
    first = _digits(digest, 0)
    groups = df.groupBy(first.alias("value")).agg(F.count(one).alias("rows")).toArrow()
    counts = dict(zip(groups["value"].to_pylist(), groups["rows"].to_pylist()))
    if not counts:
        return df.limit(0)
    wanted = max(1, int(sum(counts.values()) * rate))
    for last in sorted(counts):
        if wanted <= counts[last]:
            break
        wanted -= counts[last]
    if wanted == counts[last]:
        return df.where(first <= last)

    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    edge = (
        df.where(first == last)
        .select(
            F.struct(digest.alias("hash"), F.col(key).alias("key")).alias("_place"),
            F.struct(F.md5(text).alias("hash"), text.alias("text")).alias("_row"),
            F.struct(*df.columns).alias("_same"),
        )
        .groupBy("_place", "_row")
        .agg(F.count(one).alias("_n"), F.first("_same").alias("_same"))
    )
    path = scratch_dir(spark, "sample-edge")
    edge.write.parquet(path)
    edge = left = spark.read.schema(edge.schema).parquet(path)
    place, row, n = F.col("_place"), F.col("_row"), F.col("_n")
    before = F.lit(False)
    tied = F.lit(True)
    for value in (_digits(place["hash"], 1), place, _digits(row["hash"], 0), row):
        found, wanted, there = _boundary(left, value, n, wanted)
        same = value == _literal(found)
        before = before | (tied & (value < _literal(found)))
        tied = tied & same
        if wanted == there:
            before, tied = before | tied, F.lit(False)
            break
        left = left.where(same)
    kept = edge.withColumn("_n", F.when(before, n).when(tied, F.lit(wanted).cast("bigint"))).where("_n > 0")
    return df.where(first < last).unionByName(_spread(kept, F.col("_n")).select("_same.*"))


def _literal(value) -> Column:
    """A collected value as a constant, structs field by field."""
    if isinstance(value, dict):
        return F.struct(*(F.lit(v).alias(k) for k, v in value.items()))
    return F.lit(value)
