"""Frames of the small documents of text_cases."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame
from text_cases import CLASHING, DOCS, messy_rows


@pytest.fixture(scope="session")
def messy(spark) -> DataFrame:
    rows = [(*r, 1, "x", "y", 2, 3, "z", 4) for r in messy_rows()]
    return spark.createDataFrame(rows, f"{DOCS}, {CLASHING}")


@pytest.fixture(scope="session")
def no_docs(spark) -> DataFrame:
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def make_docs(spark):
    def build(*texts) -> DataFrame:
        """Documents 0, 1, ... of texts."""
        return spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], DOCS)

    return build
