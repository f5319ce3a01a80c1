from __future__ import annotations

from contextlib import contextmanager
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.audit import stamped
from shelfmark.plans import bronze, jobs, silver
from shelfmark.schemas import LAYERS, TABLES
from shelfmark.sources import supplied
from shelfmark.sources.tables import Lakehouse


def daily(spark, rows):
    return stamped(spark.createDataFrame(rows, schemas.GOLD_DAILY_SALES.raw_schema))


ONE = (date(2024, 1, 5), 10.0, 1, 10.0)
TWO = (date(2024, 2, 6), 20.0, 2, 10.0)


@contextmanager
def executed(spark):
    """The plans of what runs meanwhile, from the query log of the session, which keeps only the last ones."""
    store = spark._jsparkSession.sharedState().statusStore()

    def listed():
        spark._jsc.sc().listenerBus().waitUntilEmpty()
        found = store.executionsList()
        return {found.apply(i).executionId(): found.apply(i) for i in range(found.size())}

    before, plans = max(listed(), default=-1), []
    yield plans
    plans += [e.physicalPlanDescription() for i, e in listed().items() if i > before]
    assert plans, "no plan was seen"


def ready(lake, spec):
    lake.ensure_databases()
    lake.ensure_table(spec)
    return lake


def test_databases_and_tables_are_created_once(spark, lake):
    for _ in range(2):
        lake.ensure_databases()
        for spec in TABLES.values():
            lake.ensure_table(spec)
    for layer in LAYERS:
        names = {r.tableName for r in spark.sql(f"SHOW TABLES IN {lake.database(layer)}").collect()}
        assert names == {s.name for s in TABLES.values() if s.layer == layer}


@pytest.mark.parametrize("key", sorted(TABLES))
def test_declared_columns_come_back(lake, key):
    spec = TABLES[key]
    assert ready(lake, spec).read(spec).schema == spec.schema


def test_append_adds_and_overwrite_replaces(spark, lake):
    spec = schemas.GOLD_DAILY_SALES
    ready(lake, spec)
    assert lake.append(daily(spark, [ONE]), spec) == 1
    assert lake.append(daily(spark, [ONE, TWO]), spec) == 2
    assert lake.read(spec).count() == 3
    assert lake.overwrite(daily(spark, [TWO]), spec) == 1
    assert [r.order_date for r in lake.read(spec).collect()] == [TWO[0]]
    assert lake.read(spec).schema == spec.schema


def test_overwrite_replaces_all_partitions_in_dynamic_mode_too(spark, lake):
    spec = schemas.GOLD_DAILY_SALES
    ready(lake, spec)
    lake.append(daily(spark, [ONE]), spec)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        lake.overwrite(daily(spark, [TWO]), spec)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert lake.read(spec).count() == 1


def test_columns_are_matched_by_name_and_cast(spark, lake):
    spec = schemas.GOLD_RETURN_RATE
    ready(lake, spec)
    rows = spark.createDataFrame(
        [(3, 3.7, 1.0, 0.5, "P", date(2024, 1, 1))],
        "total_return_value int, sold_qty double, returned_qty double, return_rate double,"
        " product_id string, return_month date",
    )
    lake.append(stamped(rows), spec)
    row = lake.read(spec).drop("_ingestion_time").first()
    assert tuple(row) == ("P", date(2024, 1, 1), 3, 1, 0.5, 3.0)


def test_missing_unknown_and_uncastable_columns_are_refused(spark, lake):
    spec = schemas.GOLD_DAILY_SALES
    ready(lake, spec)
    good = daily(spark, [ONE])
    with pytest.raises(ValueError, match="total_orders"):
        lake.append(good.drop("total_orders"), spec)
    with pytest.raises(ValueError, match="surprise"):
        lake.append(good.withColumn("surprise", F.lit(1)), spec)
    with pytest.raises(Exception, match="total_revenue"):
        lake.append(good.withColumn("total_revenue", F.lit("12.5")), spec)
    assert lake.read(spec).count() == 0


def test_too_large_a_number_is_refused(spark, lake):
    spec = schemas.GOLD_DAILY_SALES
    ready(lake, spec)
    with pytest.raises(Exception, match="OVERFLOW"):
        lake.append(daily(spark, [ONE]).withColumn("total_orders", F.lit(1e30)), spec)


def scan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reader_prunes_months_outside_the_dates(spark, lake):
    spec = schemas.GOLD_DAILY_SALES
    ready(lake, spec)
    rows = [(date(2024, m, d), 1.0, 1, 1.0) for m in range(1, 13) for d in (1, 15, 28)]
    lake.append(daily(spark, rows), spec)
    part = lake.read(spec, start=date(2024, 3, 15), end=date(2024, 4, 14))
    assert sorted(r.order_date for r in part.collect()) == [
        date(2024, 3, 15), date(2024, 3, 28), date(2024, 4, 1),
    ]
    assert f"PartitionFilters: [isnotnull({spec.partition_column}" in scan_text(part)
    with pytest.raises(ValueError):
        lake.read(schemas.GOLD_CUSTOMER_LTV, start=date(2024, 1, 1))


def test_partition_column_is_the_start_of_month_or_year(spark, lake):
    spec = schemas.BRONZE_RETURNS
    ready(lake, spec)
    row = ("R", "O", "C", "P", datetime(2024, 5, 31, 23, 59), "Defective", 1.0)
    undated = row[:4] + (None,) + row[5:]
    lake.append(stamped(spark.createDataFrame([row, undated], spec.raw_schema)), spec)
    months = {r[0] for r in spark.table(lake.table_name(spec)).select("return_date_month").collect()}
    assert months == {date(2024, 5, 1), None}
    spec = schemas.BRONZE_PROMOTIONS
    ready(lake, spec)
    promo = ("X", "n", 10.0, date(2024, 5, 31), date(2025, 1, 1), "All", "Active")
    lake.append(stamped(spark.createDataFrame([promo], spec.raw_schema)), spec)
    assert spark.table(lake.table_name(spec)).first()["start_date_year"] == date(2024, 1, 1)


def test_a_month_with_most_rows_is_split_over_files(spark, lake):
    """The rebalance hint splits one huge month, while small months stay whole."""
    spec = schemas.SILVER_SALES
    ready(lake, spec)
    rows = spark.range(0, 200_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("order_id"),
        F.md5((F.col("id") + 1).cast("string")).alias("customer_id"),
        F.lit("P").alias("product_id"),
        F.lit(1.0).alias("quantity"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("total_amount"),
        F.when(F.col("id") % 20 == 0, F.lit("2024-02-01")).otherwise(F.lit("2024-01-01"))
        .cast("date").alias("order_date"),
        F.lit(True).alias("is_valid"),
    )
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(conf, "1m")
    try:
        assert lake.append(stamped(rows), spec) == 200_000
    finally:
        spark.conf.unset(conf)
    stored = spark.table(lake.table_name(spec)).groupBy(
        spec.partition_column, F.input_file_name().alias("file")
    ).count().collect()
    sizes = [r["count"] for r in stored if r[spec.partition_column] == date(2024, 1, 1)]
    assert sum(sizes) == 190_000 and len(sizes) >= 4 and max(sizes) < 80_000


def unsorted_sales(spark):
    """Rows of three months in each of eight tasks."""
    month = (F.col("id") % 3 * 31).cast("int")
    return spark.range(0, 2400, 1, 8).select(
        *(F.lit("x").alias(c) for c in ("order_id", "customer_id", "product_id")),
        *(F.lit(1.0).alias(c) for c in ("quantity", "price")),
        F.date_add(F.lit(date(2024, 1, 1)), month).cast("timestamp").alias("order_date"),
    )


@pytest.mark.parametrize("rebalance", [None, False, True])
def test_raw_rows_in_no_order_go_to_their_month(spark, tmp_path, rebalance):
    """One file a month, as measured or as told; told not to, at most tasks times months."""
    spec = schemas.BRONZE_SALES
    shuffled = rebalance is not False
    lake = ready(Lakehouse(spark, str(tmp_path), f"raw{rebalance}_".lower(), rebalance), spec)
    rows = stamped(unsorted_sales(spark))
    with executed(spark) as plans:
        assert lake.append(rows, spec) == 2400
    assert any("Exchange" in p for p in plans if "InsertInto" in p) == shuffled
    files = lake.table(spec).select(F.input_file_name()).distinct().count()
    assert files == (3 if shuffled else 24)


def in_files(spark, path, months_of):
    """Parquet files of 100 sales each, the i-th with rows of the months that months_of(i) names."""
    for i in range(40):
        months = F.element_at(F.array(*map(F.lit, months_of(i))), (F.col("id") % len(months_of(i)) + 1).cast("int"))
        spark.range(100).coalesce(1).select(
            *(F.lit("x").alias(c) for c in ("order_id", "customer_id", "product_id")),
            *(F.lit(1.0).alias(c) for c in ("quantity", "price")),
            F.add_months(F.lit(date(2020, 1, 1)), months).cast("timestamp").alias("order_date"),
        ).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("ordered", [True, False])
def test_the_layout_is_measured(spark, tmp_path, ordered):
    """Raw rows in date order are written without an exchange, others as about one file a month."""
    raw = in_files(spark, str(tmp_path / "raw"), lambda i: [i // 2] if ordered else list(range(i % 4, 40, 4)))
    spec = schemas.BRONZE_SALES
    lake = ready(Lakehouse(spark, str(tmp_path / "lake"), f"measured{ordered}_".lower()), spec)
    conf = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(conf, "4k")
    try:
        with executed(spark) as plans:
            assert lake.append(bronze.sales(raw), spec) == 4000
    finally:
        spark.conf.unset(conf)
    assert any("Exchange" in p for p in plans if "InsertInto" in p) != ordered
    months = lake.table(spec).select(spec.partition_column).distinct().count()
    files = lake.table(spec).select(F.input_file_name()).distinct().count()
    assert files <= (2 * (40 + months) if ordered else 1.2 * months)


def test_tables_are_found_by_another_catalog(spark, tmp_path):
    """A session that has never seen the tables, as in a new process, finds their rows."""
    spec = schemas.GOLD_DAILY_SALES
    first = ready(Lakehouse(spark, str(tmp_path), "again_"), spec)
    first.append(daily(spark, [ONE, TWO]), spec)
    for _ in range(2):
        spark.sql(f"DROP TABLE {first.table_name(spec)}")
        assert first.read(spec).count() == 2
    spark.sql(f"DROP TABLE {first.table_name(spec)}")
    assert ready(first, spec).append(daily(spark, [ONE]), spec) == 1
    assert first.read(spec).count() == 3
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        first.read(schemas.GOLD_CUSTOMER_LTV)


def test_rows_from_a_table_with_the_same_months_are_not_shuffled(spark, sf_dir, lake):
    """Silver from bronze: no more files than bronze has, each of one month, and no exchange."""
    for spec in (schemas.BRONZE_SALES, schemas.SILVER_SALES):
        ready(lake, spec)
    lake.append(bronze.sales(supplied.sales(spark, sf_dir)), schemas.BRONZE_SALES)
    rows = silver.sales(lake.read(schemas.BRONZE_SALES))
    assert "Exchange" not in scan_text(rows)
    assert lake.append(rows, schemas.SILVER_SALES, like=schemas.BRONZE_SALES) == 5855

    def files(spec):
        return spark.table(lake.table_name(spec)).select(F.input_file_name()).distinct().count()

    assert files(schemas.SILVER_SALES) <= files(schemas.BRONZE_SALES)


def test_like_a_table_with_other_partitions_still_rebalances(spark, lake):
    spec = schemas.GOLD_DAILY_SALES
    ready(lake, spec)
    rows = [(date(2024, 1, d), 1.0, 1, 1.0) for d in range(1, 31)]
    spread = daily(spark, rows).repartition(10)
    assert lake.append(spread, spec, like=schemas.BRONZE_PROMOTIONS) == 30
    stored = spark.table(lake.table_name(spec)).select(F.input_file_name()).distinct().count()
    assert stored == 1


def test_jobs_on_empty_tables_write_and_count_nothing(lake):
    for spec in TABLES.values():
        ready(lake, spec)
    assert {job: run(lake) for job, run in jobs.REFRESH.items()} == dict.fromkeys(jobs.REFRESH, 0)


def failing(rows, after=0):
    """Rows of which those beyond the first `after` fail when they are computed."""
    bad = F.when(F.monotonically_increasing_id() >= after, F.raise_error(F.lit("lost"))).otherwise(F.lit(0.0))
    return rows.withColumn("_bad", bad.cast("double")).where("_bad IS NOT NULL").drop("_bad")


def of(spark, spec, n):
    """n rows of any gold table, over three months."""
    made = {"string": F.col("id").cast("string"), "date": F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 90).cast("int"))}
    columns = [made.get(f.dataType.simpleString(), F.col("id")).cast(f.dataType).alias(f.name) for f in spec.raw_schema]
    return stamped(spark.range(0, n, 1, 4).select(*columns))


GOLD = sorted(k for k, s in TABLES.items() if s.layer == "gold")


@pytest.mark.parametrize("key", GOLD)
@pytest.mark.parametrize("after", [0, 100])
def test_a_failed_replacement_leaves_the_old_rows(spark, tmp_path, key, after):
    """At once and half way, before and after the first replacement, also for a new catalog."""
    spec = TABLES[key]
    lake = ready(Lakehouse(spark, str(tmp_path), f"fail{after}_{spec.name}_"), spec)
    lake.append(of(spark, spec, 30), spec)
    for n in (30, 200):
        if n != 30:
            assert lake.overwrite(of(spark, spec, n), spec) == n
        with pytest.raises(Exception, match="lost"):
            lake.overwrite(failing(of(spark, spec, 300), after), spec)
        assert lake.read(spec).count() == n
        spark.sql(f"DROP TABLE {lake.table_name(spec)}")
        assert lake.read(spec).count() == n


@pytest.mark.parametrize("key", ["gold.daily_sales", "gold.customer_ltv", "silver.sales"])
def test_a_replacement_cut_short_is_the_old_table_or_the_new(spark, tmp_path, monkeypatch, key):
    """Without its marker it is nothing; with it, the next reader gets the new rows."""
    spec = TABLES[key]
    lake = ready(Lakehouse(spark, str(tmp_path), f"cut_{spec.name}_"), spec)
    rows = of(spark, spec, 50) if spec.layer == "gold" else of(spark, spec, 50).withColumn("is_valid", F.lit(True))
    lake.append(rows, spec)
    follow = Lakehouse._follow

    def stopped(*_):
        raise RuntimeError("cut short")

    monkeypatch.setattr(Lakehouse, "_follow", stopped)
    with pytest.raises(RuntimeError):
        lake.overwrite(rows.limit(20), spec)
    assert spark.table(lake.table_name(spec)).count() == 50
    monkeypatch.setattr(Lakehouse, "_follow", follow)
    assert lake.read(spec).count() == 20
    marker, files = lake._path(f"{lake.current_folder(spec)}/_COMMITTED")
    files.delete(marker, False)
    assert lake.current_folder(spec) == lake.folder(spec)


def test_a_table_can_be_replaced_by_what_it_holds(spark, lake):
    spec = schemas.GOLD_DAILY_SALES
    ready(lake, spec)
    lake.overwrite(daily(spark, [ONE, TWO]), spec)
    for _ in range(3):
        assert lake.overwrite(lake.read(spec).where("total_orders = 2"), spec) == 1
    assert [r.order_date for r in lake.read(spec).collect()] == [TWO[0]]
    assert len(lake._replacements(spec)) == 2
    assert lake.append(daily(spark, [ONE]), spec) == 1
    assert lake.read(spec, start=date(2024, 1, 1), end=date(2024, 1, 31)).count() == 1
    assert lake.overwrite(daily(spark, []), spec) == 0
    assert lake.read(spec).count() == 0


def test_another_catalog_sees_a_replacement(spark, tmp_path):
    """Two names for the same files, as two processes have."""
    spec = schemas.GOLD_CUSTOMER_LTV
    one = ready(Lakehouse(spark, str(tmp_path), "seen_"), spec)
    one.overwrite(of(spark, spec, 5), spec)
    name = one.table_name(spec)
    stale = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type
    one.overwrite(of(spark, spec, 7), spec)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{stale}'")
    assert spark.table(name).count() == 5
    assert one.read(spec).count() == 7
