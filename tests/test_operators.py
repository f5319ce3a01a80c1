"""Operators against brute force, with hot keys and odd partitionings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.coverage import covered_days
from shelfmark.operators.existence import existence_flag
from shelfmark.operators.sampling import sample_exact
from tests.test_plans import settings


def keyed_rows(spark, n=6000):
    """A third of the rows have the key HOT, another third COLD; one in eleven has none."""
    key = (
        F.when(F.col("id") % 11 == 0, None)
        .when(F.col("id") % 3 == 0, "HOT")
        .when(F.col("id") % 3 == 1, "COLD")
        .otherwise(F.concat(F.lit("K"), F.col("id") % 500))
    )
    return spark.range(0, n, 1, 8).select(F.col("id").alias("row"), key.alias("k"))


def known_keys(spark):
    """HOT is known, and again in a third of the rows; COLD is not; of the others, every second."""
    return spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "HOT")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("K"), (F.col("id") * 2) % 500))
        .alias("k")
    )


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_existence_flag_equals_brute_force(spark, adaptive):
    rows, keys = keyed_rows(spark), known_keys(spark)
    known = {r.k for r in keys.collect()} - {None}
    with settings(spark, spark__sql__adaptive__enabled=adaptive):
        result = existence_flag(rows, keys, "k", "found").collect()
    assert len(result) == 6000
    assert {(r.row, r.k, r.found) for r in result} == {
        (r.row, r.k, r.k in known) for r in rows.collect()
    }


def test_covered_days_equal_brute_force(spark):
    rng = random.Random(5)
    base = date(2024, 1, 1)
    spans = [
        (base + timedelta(rng.randrange(300)), base + timedelta(rng.randrange(300)))
        for _ in range(40)
    ] + [(None, base), (base, None), (base, base)]
    covered = set()
    for start, end in spans:
        if start and end:
            first, last = min(start, end), max(start, end)
            covered |= {first + timedelta(n) for n in range((last - first).days + 1)}
    df = spark.createDataFrame(spans, "s date, e date")
    result = [r.day for r in covered_days(df, "s", "e", "day").collect()]
    assert len(result) == len(set(result)) and set(result) == covered


def test_open_ended_intervals_do_not_multiply(spark):
    """A thousand first days, all until the end of the calendar: each day once."""
    first = date(2024, 1, 1)
    df = spark.range(1000).select(
        F.date_add(F.lit(first), F.col("id").cast("int") * 2).alias("s"),
        F.lit(date(9999, 12, 31)).alias("e"),
    )
    days = covered_days(df, "s", "e", "day")
    assert days.count() == days.distinct().count() == (date(9999, 12, 31) - first).days + 1


def test_gaps_stay_uncovered(spark):
    january = [(1, 2), (2, 2), (5, 5)]
    spans = [(date(2024, 1, s), date(2024, 1, e)) for s, e in january]
    days = covered_days(spark.createDataFrame(spans, "s date, e date"), "s", "e", "day")
    assert sorted(r.day.day for r in days.collect()) == [1, 2, 5]


def brute_sample(keys, rate, seed):
    def order(k):
        return hashlib.md5(f"{k}|{seed}".encode()).hexdigest(), k

    return set(sorted(keys, key=order)[: max(1, int(len(keys) * rate))])


@pytest.mark.parametrize(
    "n,rate", [(1, 0.08), (5, 0.08), (1000, 0.08), (1000, 0.5), (1000, 1.0), (70000, 0.3)]
)
@pytest.mark.parametrize("partitions", [1, 7])
def test_sample_equals_brute_force(spark, n, rate, partitions):
    df = spark.range(0, n, 1, partitions)
    result = [r.id for r in sample_exact(df, "id", rate, 999).collect()]
    assert len(result) == len(set(result)) and set(result) == brute_sample(range(n), rate, 999)


def test_sample_depends_on_the_seed(spark):
    df = spark.range(1000)
    one, two = ({r.id for r in sample_exact(df, "id", 0.1, s).collect()} for s in (1, 2))
    assert len(one) == len(two) == 100 and one != two


def test_sample_of_nothing_is_empty(spark):
    assert sample_exact(spark.range(0), "id", 0.5, 1).count() == 0


def test_sample_rate_is_checked(spark):
    with pytest.raises(ValueError):
        sample_exact(spark.range(1), "id", 1.5, 1)


def keyed(spark, n=900):
    """A third of all rows share one key; a third of those are the same row."""
    i = F.col("id")
    key = F.when(i % 3 == 0, -1).otherwise(i)
    return spark.range(0, n, 1, 4).select(
        key.alias("k"), F.when((i % 3 == 0) & (i % 9 != 0), i).otherwise(0).alias("v"),
        F.lit(None).cast("double").alias("x"),
    )


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.35, 0.5, 0.77, 1.0])
@pytest.mark.parametrize("seed", range(3))
def test_sample_is_exact_when_keys_repeat(spark, rate, seed):
    df = keyed(spark)
    rows = Counter(tuple(r) for r in sample_exact(df, "k", rate, seed).collect())
    again = Counter(tuple(r) for r in sample_exact(df.repartition(7), "k", rate, seed).collect())
    assert rows == again
    assert sum(rows.values()) == max(1, int(900 * rate))
    assert not rows - Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("wanted", [1, 100, 999, 1000])
def test_sample_of_one_key_and_of_one_row(spark, wanted):
    same = spark.range(0, 1000, 1, 4).select(F.lit("K").alias("k"))
    assert sample_exact(same, "k", wanted / 1000, 1).count() == wanted
    one_key = spark.range(0, 1000, 1, 4).select(F.lit("K").alias("k"), F.col("id").alias("v"))
    result = [r.v for r in sample_exact(one_key, "k", wanted / 1000, 1).collect()]
    assert len(result) == len(set(result)) == wanted


def test_sample_does_not_sort_its_input(spark):
    text = sample_exact(keyed(spark), "k", 0.5, 1)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text


def test_sample_reads_its_input_three_times(spark, tmp_path):
    """Counted by a row counter in the plan, which each read of the input passes."""
    n = 5000
    spark.range(0, n, 1, 4).withColumn("k", F.col("id") % 700).write.parquet(str(tmp_path / "in"))
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    source = spark.read.parquet(str(tmp_path / "in"))
    result = sample_exact(source.mapInArrow(counted, source.schema), "k", 0.3, 5)
    assert result.count() == 1500
    assert seen.value <= 3 * n


def test_many_copies_of_the_last_row_are_made_by_several_tasks(spark):
    same = spark.range(0, 60_000, 1, 4).select(F.lit("K").alias("k"), F.lit(1.5).alias("v"))
    result = sample_exact(same, "k", 0.9, 1)
    sizes = [r["count"] for r in result.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 54_000
    assert set(map(tuple, result.distinct().collect())) == {("K", 1.5)}
