"""Ledger of processed keys: what was handled, when, and for how long that counts.

A ledger is an append-only table of entries; of several entries for one key the latest
counts, and an entry whose metadata says ``removed`` takes the key out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordflow.functions.dates import as_timestamp
from recordflow.operators.dedup import table_hash
from recordflow.operators.joins import only_keys
from recordflow.schemas import LEDGER_SCHEMA

REMOVED = "removed"
BATCH = "batch"
DAY = "day"


def entries(
    keys: DataFrame, ledger: str, as_of: datetime | str | Column, metadata: dict[str, str] | None = None
) -> DataFrame:
    """Ledger entries that mark the one-column `keys` as processed."""
    pairs = [F.lit(part) for pair in (metadata or {}).items() for part in pair]
    details = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return keys.toDF("key").distinct().select(
        F.lit(ledger).alias("ledger"),
        F.col("key").cast("string").alias("key"),
        as_timestamp(as_of).alias("processed_at"),
        details.alias("metadata"),
    )


def current(log: DataFrame) -> DataFrame:
    """Latest entry per key; removed keys are left out."""
    newest = log.groupBy("ledger", "key").agg(
        F.max_by(F.struct("processed_at", "metadata"), "processed_at").alias("e")
    )
    rows = newest.select("ledger", "key", "e.processed_at", "e.metadata")
    return rows.where(F.try_element_at("metadata", F.lit(REMOVED)).isNull())


def _oldest(as_of: datetime | str, ttl_minutes: int) -> Column:
    return as_timestamp(as_of) - F.make_dt_interval(mins=F.lit(ttl_minutes))


def live(log: DataFrame, as_of: datetime | str, ttl_minutes: int = 60) -> DataFrame:
    """Entries not older than the time to live.

    The time is tested before the latest entry is chosen, which gives the same rows and lets
    the scan skip files written before.
    """
    return current(log.where(F.col("processed_at") >= _oldest(as_of, ttl_minutes)))


def unprocessed(
    df: DataFrame, log: DataFrame, ledger: str, as_of: datetime | str, ttl_minutes: int = 60,
    key: str = "cache_key",
) -> DataFrame:
    """Rows whose key has no live entry."""
    done = live(log.where(F.col("ledger") == ledger), as_of, ttl_minutes).select(
        F.col("key").alias("_done")
    )
    return only_keys(df, F.col(key).cast("string"), done, "left_anti")


def stats(log: DataFrame, as_of: datetime | str, ttl_minutes: int = 60) -> DataFrame:
    """Entries, oldest and newest time of every ledger."""
    return (
        live(log, as_of, ttl_minutes)
        .groupBy("ledger")
        .agg(
            F.count("*").alias("entries"),
            F.min("processed_at").alias("oldest"),
            F.max("processed_at").alias("newest"),
        )
    )


def with_built_key(
    df: DataFrame, columns: Sequence[str], builder: Callable[..., pd.Series], name: str = "cache_key"
) -> DataFrame:
    """Add a key made by a Python function that takes and returns Series, in Arrow batches.

    Only for rules that columns cannot express; plain keys use ``with_composite_key``.
    """

    @F.pandas_udf("string")
    def build(*parts: pd.Series) -> pd.Series:
        return builder(*parts)

    return df.withColumn(name, build(*[F.col(c) for c in columns]))


def unchanged_groups(
    df: DataFrame, log: DataFrame, ledger: str, as_of: datetime | str, by: str = "instrument",
    ttl_minutes: int = 60,
) -> tuple[DataFrame, DataFrame]:
    """Split per-group content keys into those to load and those already in the ledger.

    Both frames have ``<by>, row_count, content_hash, cache_key``.
    """
    return known_groups(table_hash(df, [by]), log, ledger, as_of, by, ttl_minutes)


def known_groups(
    hashes: DataFrame, log: DataFrame, ledger: str, as_of: datetime | str, by: str = "instrument", ttl_minutes: int = 60
) -> tuple[DataFrame, DataFrame]:
    """`unchanged_groups` for content hashes made before, as by `FolderHash`."""
    key = F.concat_ws(":", F.col(by), "content_hash", F.col("row_count").cast("string"))
    keyed = hashes.withColumn("cache_key", key)
    done = live(log.where(F.col("ledger") == ledger), as_of, ttl_minutes).select(
        F.col("key").alias("_done")
    )
    on = F.col("cache_key") == F.col("_done")
    return keyed.join(done, on, "left_anti"), keyed.join(done, on, "left_semi")


def recent_window(
    log: DataFrame,
    as_of: datetime,
    minutes_back: int = 2,
    stale_after: timedelta = timedelta(hours=2),
    recovery: bool = False,
    full_day_fallback: bool = True,
) -> DataFrame:
    """One row ``window_start, window_end``: the last minutes, or a day when the ledger is stale.

    A ledger that is empty counts as current, as at a first run.
    """
    now = as_timestamp(as_of)
    newest = F.max("processed_at")
    stale = F.coalesce(newest < now - F.lit(stale_after), F.lit(False))
    full_day = F.lit(recovery) | (F.lit(full_day_fallback) & stale)
    return log.agg(
        F.when(full_day, now - F.lit(timedelta(days=1)))
        .otherwise(now - F.lit(timedelta(minutes=minutes_back)))
        .alias("window_start"),
        now.alias("window_end"),
    )


def pull(df: DataFrame, window: DataFrame, column: str = "ts") -> DataFrame:
    """Rows inside a window of `recent_window`; the bounds are read once so that scans prune."""
    start, end = window.first()
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))


class Ledger:
    """A ledger kept as a Parquet folder of one subfolder per day.

    What is live is read from the days that can hold it; `purge` deletes the days past the time
    to live.
    """

    def __init__(self, spark: SparkSession, path: str, name: str, ttl_minutes: int = 60) -> None:
        self.spark, self.path, self.name, self.ttl_minutes = spark, path, name, ttl_minutes
        if not self._exists():
            self._append(spark.createDataFrame([], LEDGER_SCHEMA))

    def _folder(self, *parts: str):
        """A folder under the ledger, and the file system it is on."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path("/".join([self.path.rstrip("/"), *parts]))
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self) -> bool:
        folder, files = self._folder()
        return files.exists(folder)

    def _append(self, rows: DataFrame) -> None:
        dated = rows.withColumn(DAY, F.to_date("processed_at"))
        dated.write.mode("append").partitionBy(DAY).parquet(self.path)

    def log(self, since: Column | None = None) -> DataFrame:
        """Entries of this ledger, of the days from `since` on."""
        rows = self.spark.read.schema(f"{LEDGER_SCHEMA}, {DAY} date").parquet(self.path)
        if since is not None:
            rows = rows.where(F.col(DAY) >= F.to_date(since))
        return rows.where(F.col("ledger") == self.name).drop(DAY)

    def purge(self, as_of: datetime | str) -> list[str]:
        """Delete the days of which no entry is live any more; all ledgers of the folder share them."""
        first = self.spark.range(1).select(F.to_date(_oldest(as_of, self.ttl_minutes))).first()[0]
        folder, files = self._folder()
        days = [s.getPath().getName() for s in files.listStatus(folder) if s.getPath().getName().startswith(f"{DAY}=")]
        gone = sorted(d for d in days if d < f"{DAY}={first}")
        for day in gone:
            files.delete(self._folder(day)[0], True)
        return gone

    def mark(self, keys: DataFrame, as_of: datetime | str, metadata: dict[str, str] | None = None) -> None:
        """Mark keys as processed; marking again restarts their time to live."""
        self._append(entries(keys, self.name, as_of, metadata))

    def remove(self, keys: DataFrame, as_of: datetime | str) -> None:
        """Take keys out."""
        self.mark(keys, as_of, {REMOVED: "true"})

    def clear(self, as_of: datetime | str) -> None:
        """Take all keys out."""
        self.remove(current(self.log()).select("key"), as_of)

    def live(self, as_of: datetime | str) -> DataFrame:
        """Entries that still count."""
        return live(self.log(_oldest(as_of, self.ttl_minutes)), as_of, self.ttl_minutes)

    def unprocessed(
        self, df: DataFrame, as_of: datetime | str, key: str = "cache_key", batch: str | None = None
    ) -> DataFrame:
        """Rows whose key does not count as processed.

        Entries marked by `batch` itself do not count, so that a batch repeated after a failure
        gives the same rows again.
        """
        log = self.log(_oldest(as_of, self.ttl_minutes))
        if batch is not None:
            log = log.where(~F.try_element_at("metadata", F.lit(BATCH)).eqNullSafe(F.lit(batch)))
        return unprocessed(df, log, self.name, as_of, self.ttl_minutes, key)

    def stats(self, as_of: datetime | str) -> DataFrame:
        """Entries, oldest and newest time."""
        return stats(self.log(_oldest(as_of, self.ttl_minutes)), as_of, self.ttl_minutes)
