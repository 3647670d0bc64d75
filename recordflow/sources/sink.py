"""Sinks: fan-out, partitioned outputs, error log, versioned replacement."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


class CountMismatch(RuntimeError):
    """Two targets of one result hold different numbers of rows."""


def fan_out(df: DataFrame, targets: Mapping[str, str]) -> int:
    """Push one result to several Parquet targets and return its row count.

    Every push is a new folder in each target. The result is computed once, for the first
    target; the others are copied from there, so a lost executor cannot make them differ. The
    counts come from the Parquet footers.
    """
    spark, push = df.sparkSession, f"push={uuid.uuid4().hex}"
    (first, path), *rest = targets.items()
    df.write.parquet(f"{path}/{push}")
    written = spark.read.parquet(f"{path}/{push}")
    expected = written.count()
    for name, other in rest:
        written.write.parquet(f"{other}/{push}")
        found = spark.read.parquet(f"{other}/{push}").count()
        if found != expected:
            raise CountMismatch(f"{first}: {expected} rows, {name}: {found} rows")
    return expected


def per_group(df: DataFrame, path: str, group: str, status: Mapping[str, str] | None = None) -> None:
    """Write one output folder per value of `group`, with literal status columns set."""
    for column, value in (status or {}).items():
        df = df.withColumn(column, F.lit(value))
    df.write.mode("append").partitionBy(group).parquet(path)


def per_instrument(df: DataFrame, path: str, instrument: str = "instrument") -> None:
    """Write one output folder per instrument, the ``_redcap`` marker removed from its name."""
    name = F.replace(F.col(instrument), F.lit("_redcap"), F.lit(""))
    per_group(df.withColumn(instrument, name), path, instrument)


def append_error_log(errors: DataFrame, path: str) -> None:
    """Append ``datetime, mrn, error, attempt`` rows to a tab-separated log."""
    errors.select(
        F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("datetime"),
        F.coalesce("mrn", F.lit("N/A")).alias("mrn"),
        "error",
        F.coalesce(F.col("attempt").cast("string"), F.lit("1")).alias("attempt"),
    ).write.mode("append").option("sep", "\t").option("header", True).csv(path)


def write_version(df: DataFrame, base: str) -> str:
    """Write a whole new version of a table beside the old ones and return its path.

    An upsert reads the previous version while it writes, so it never overwrites in place.
    """
    path = f"{base.rstrip('/')}/version={uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return path


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Read a written target."""
    return spark.read.parquet(path)
