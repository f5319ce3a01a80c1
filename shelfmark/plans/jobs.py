"""The ten jobs: read from one layer, transform, write to the next. Each returns its row count."""

from __future__ import annotations

from collections.abc import Callable

from shelfmark import schemas
from shelfmark.plans import bronze, gold, silver
from shelfmark.schemas import TableSpec
from shelfmark.sources.csv_files import literal_path, read_csv
from shelfmark.sources.tables import Lakehouse
from shelfmark.streaming.contracts import Contract
from shelfmark.streaming.ingest import file_stream, ingest

_MEASURED = 32
_KEPT_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"


def ingest_raw(lake: Lakehouse, spec: TableSpec, path: str, infer: bool = False) -> int:
    """Append all CSV files under `path` to a bronze table; a rerun appends them again.

    Whether rows are in date order is measured on at most _MEASURED of the files, evenly spaced.
    """
    transform = {"sales": bronze.sales, "returns": bronze.returns, "promotions": bronze.promotions}[spec.name]
    _prepare(lake, spec)
    raw = read_csv(lake.spark, path, spec, infer)
    files, part = sorted(raw.inputFiles()), None
    if len(files) > _MEASURED:
        chosen = [files[i * len(files) // _MEASURED] for i in range(_MEASURED)]
        part = transform(read_csv(lake.spark, [literal_path(f) for f in chosen], spec, infer))
    return lake.append(transform(raw), spec, part=part)


def ingest_events(
    lake: Lakehouse, contract: Contract, path: str, source_format: str, files_per_batch: int = 1000
) -> int:
    """Take the message files that have landed under `path` and were not taken before; returns how
    many messages that was, accepted or rejected.

    Spark counts the messages of each batch as it writes them. The counts of all batches are kept
    until the stream stops: one for each `files_per_batch` files that have landed.
    """
    stream = file_stream(lake.spark, path, contract, source_format, files_per_batch)
    target = lake.events_folder(contract.topic)
    kept = lake.spark.conf.get(_KEPT_PROGRESS)
    lake.spark.conf.set(_KEPT_PROGRESS, 2**31 - 1)
    try:
        query = ingest(stream, contract, target, f"{target}-checkpoint")
        query.awaitTermination()
        return sum(progress.numInputRows for progress in query.recentProgress)
    finally:
        lake.spark.conf.set(_KEPT_PROGRESS, kept)


def silver_sales(lake: Lakehouse) -> int:
    _prepare(lake, schemas.SILVER_SALES)
    rows = silver.sales(lake.read(schemas.BRONZE_SALES))
    return lake.append(rows, schemas.SILVER_SALES, like=schemas.BRONZE_SALES)


def silver_returns(lake: Lakehouse) -> int:
    _prepare(lake, schemas.SILVER_RETURNS)
    rows = silver.returns(lake.read(schemas.BRONZE_RETURNS), lake.read(schemas.SILVER_SALES))
    return lake.append(rows, schemas.SILVER_RETURNS)


def silver_promotions(lake: Lakehouse) -> int:
    _prepare(lake, schemas.SILVER_PROMOTIONS)
    rows = silver.promotions(lake.read(schemas.BRONZE_PROMOTIONS))
    return lake.append(rows, schemas.SILVER_PROMOTIONS, like=schemas.BRONZE_PROMOTIONS)


def gold_customer_ltv(lake: Lakehouse) -> int:
    _prepare(lake, schemas.GOLD_CUSTOMER_LTV)
    rows = gold.customer_ltv(lake.read(schemas.SILVER_SALES))
    return lake.overwrite(rows, schemas.GOLD_CUSTOMER_LTV)


def gold_daily_sales(lake: Lakehouse) -> int:
    _prepare(lake, schemas.GOLD_DAILY_SALES)
    rows = gold.daily_sales(lake.read(schemas.SILVER_SALES))
    return lake.overwrite(rows, schemas.GOLD_DAILY_SALES)


def gold_promo_revenue(lake: Lakehouse) -> int:
    _prepare(lake, schemas.GOLD_PROMO_REVENUE)
    rows = gold.promo_revenue(
        lake.read(schemas.SILVER_SALES), lake.read(schemas.SILVER_PROMOTIONS)
    )
    return lake.overwrite(rows, schemas.GOLD_PROMO_REVENUE)


def gold_return_rate(lake: Lakehouse) -> int:
    _prepare(lake, schemas.GOLD_RETURN_RATE)
    rows = gold.return_rate_by_product(
        lake.read(schemas.SILVER_SALES), lake.read(schemas.SILVER_RETURNS)
    )
    return lake.overwrite(rows, schemas.GOLD_RETURN_RATE)


# Table-to-table jobs in an order that respects their inputs.
REFRESH: dict[str, Callable[[Lakehouse], int]] = {
    "silver.sales": silver_sales,
    "silver.returns": silver_returns,
    "silver.promotions": silver_promotions,
    "gold.customer_ltv": gold_customer_ltv,
    "gold.daily_sales": gold_daily_sales,
    "gold.promo_revenue": gold_promo_revenue,
    "gold.return_rate_by_product": gold_return_rate,
}


def _prepare(lake: Lakehouse, spec: TableSpec) -> None:
    lake.ensure_databases()
    lake.ensure_table(spec)
