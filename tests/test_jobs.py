"""All ten jobs, from CSV files to gold, through the command line."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.__main__ import main
from shelfmark.checks.oracle import ORACLE
from shelfmark.plans import jobs
from shelfmark.schemas import TABLES
from shelfmark.sources import supplied
from shelfmark.sources.csv_files import write_csv
from shelfmark.sources.tables import Lakehouse
from shelfmark.streaming.contracts import OFFERS
from tests.comparing import differences, duckdb_over


def test_all_jobs(spark, sf_dir, tmp_path, capsys):
    prefix, place = "cli_", str(tmp_path / "lake")

    def run(job, *more):
        return main([job, "--prefix", prefix, "--location", place, *more])

    for name in ("sales", "returns", "promotions"):
        raw = str(tmp_path / name)
        write_csv(getattr(supplied, name)(spark, sf_dir), raw)
        run(f"bronze.{name}", "--raw", raw)
    counts = {job: run(job) for job in TABLES if not job.startswith("bronze")}
    assert "cli_gold.daily_sales: 1,081 rows written" in capsys.readouterr().out

    con = duckdb_over(sf_dir)
    expected = {
        job: con.sql(ORACLE[job.replace(".", "_")]).to_arrow_table().num_rows for job in counts
    }
    assert counts == expected

    lake = Lakehouse(spark, place, prefix)
    stored = lake.read(schemas.GOLD_DAILY_SALES).drop("_ingestion_time")
    assert differences(stored, con, ORACLE["gold_daily_sales"]) == []
    revenue = stored.agg({"total_revenue": "sum"}).first()[0]

    # Silver appends its whole input again; gold is replaced.
    run("silver.sales")
    assert lake.read(schemas.SILVER_SALES).count() == 2 * counts["silver.sales"]
    assert run("gold.daily_sales") == counts["gold.daily_sales"]
    doubled = lake.read(schemas.GOLD_DAILY_SALES).agg({"total_revenue": "sum"}).first()[0]
    assert doubled == pytest.approx(2 * revenue)


def test_every_job_in_a_process_of_its_own(spark, sf_dir, tmp_path):
    """No catalog outlives a process here; the files do. Bronze and silver then append, gold replaces."""
    root = Path(__file__).resolve().parents[1]
    for name in ("sales", "returns", "promotions"):
        write_csv(getattr(supplied, name)(spark, sf_dir), str(tmp_path / name))

    def run(job):
        raw = ["--raw", str(tmp_path / job.split(".")[1])] if job.startswith("bronze") else []
        command = [sys.executable, "-m", "shelfmark", job, "--location", str(tmp_path / "lake")]
        done = subprocess.run(
            [*command, "--master", "local[2]", *raw], cwd=tmp_path, capture_output=True, text=True,
            env=os.environ | {"PYTHONPATH": str(root)}, timeout=300,
        )
        assert done.returncode == 0, done.stderr[-2000:]
        return int(done.stdout.split(": ")[1].split(" ")[0].replace(",", ""))

    counts = {job: run(job) for job in TABLES}
    con = duckdb_over(sf_dir)
    assert counts == {
        job: con.sql(ORACLE[job.replace(".", "_")]).to_arrow_table().num_rows for job in counts
    }
    for job in ("bronze.promotions", "silver.promotions", "gold.daily_sales"):
        run(job)
    lake = Lakehouse(spark, str(tmp_path / "lake"), "")
    lake.ensure_databases()
    place = {s: lake.current_folder(s) for s in TABLES.values()}
    rows = {k: spark.read.parquet(place[s]).count() for k, s in TABLES.items()}
    assert lake.location == str(tmp_path / "lake")
    assert rows["bronze.promotions"] == 2 * counts["bronze.promotions"]
    assert rows["silver.promotions"] == 3 * counts["silver.promotions"], "its whole input, again"
    assert rows["gold.daily_sales"] == counts["gold.daily_sales"]


def test_a_stream_job_takes_new_messages_once(spark, sf_dir, tmp_path):
    place, landing = str(tmp_path / "lake"), str(tmp_path / "landing")
    messages = supplied.offers(supplied.events(spark, sf_dir))
    messages.write.json(landing)
    job = ["bronze.offers", "--raw", landing, "--location", place, "--prefix", "events_"]
    assert main(job) == messages.count()
    assert main(job) == 0
    lake = Lakehouse(spark, place, "events_")
    both = lake.read_events(OFFERS).count() + lake.read_events(OFFERS, rejects=True).count()
    assert both == messages.count()


def test_a_stream_job_counts_every_batch(spark, sf_dir, tmp_path):
    """Twelve batches, of which Spark would keep five."""
    landing = str(tmp_path / "landing")
    messages = supplied.offers(supplied.events(spark, sf_dir)).limit(12).repartition(12)
    for row in range(12):
        messages.where(F.spark_partition_id() == row).coalesce(1).write.mode("append").json(landing)
    n = spark.read.json(landing).count()
    conf = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(conf, "5")
    try:
        lake = Lakehouse(spark, str(tmp_path / "lake"), "counted_")
        assert jobs.ingest_events(lake, OFFERS, landing, "json", files_per_batch=1) == n == 12
        assert jobs.ingest_events(lake, OFFERS, landing, "json") == 0
        assert spark.conf.get(conf) == "5"
    finally:
        spark.conf.unset(conf)


def test_raw_files_are_measured_on_some(spark, sf_dir, tmp_path):
    """Fifty files in no date order: months get about a file each."""
    raw, spec = str(tmp_path / "raw"), schemas.BRONZE_SALES
    rows = supplied.sales(spark, sf_dir)
    write_csv(rows.repartition(50), raw)
    lake = Lakehouse(spark, str(tmp_path / "lake"), "dealt_")
    assert jobs.ingest_raw(lake, spec, raw) == rows.count()
    stored = lake.table(spec)
    files = stored.select(F.input_file_name()).distinct().count()
    assert files <= 1.2 * stored.select(spec.partition_column).distinct().count()


def test_bronze_needs_raw_files(capsys):
    with pytest.raises(SystemExit):
        main(["bronze.sales"])
    assert "--raw" in capsys.readouterr().err
