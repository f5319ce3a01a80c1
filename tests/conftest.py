from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession

from shelfmark.session import build_session
from shelfmark.sources.tables import Lakehouse

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> SparkSession:
    session = build_session(
        app_name="tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture
def lake(spark: SparkSession, tmp_path, request: pytest.FixtureRequest) -> Lakehouse:
    prefix = f"{request.node.name.lower()}_".replace("[", "_").replace("]", "_").replace(".", "_")
    return Lakehouse(spark, str(tmp_path / "lake"), prefix=prefix)
