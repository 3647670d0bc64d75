"""One local session for all tests, and builders for the usual frames."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from recordflow.schemas import EAV_SCHEMA  # noqa: E402
from recordflow.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture(scope="session")
def eav(spark):
    """Long rows from (record, field, value[, event[, instrument, instance]])."""

    def build(*rows) -> DataFrame:
        return spark.createDataFrame([(*r, *[None] * (6 - len(r))) for r in rows], EAV_SCHEMA)

    return build
