"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# Literal tables (rename maps, code lists) up to this size are hinted as broadcasts; of larger
# ones Spark decides by their size.
MAX_LITERAL_ROWS = 10_000

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options that results (time zone) and skew handling depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split hot join keys even where a later operator then has to shuffle again.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Stream state on disk: it may outgrow memory, and state with a time to live needs it.
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """Return a new folder name every executor can reach.

    It lies under ``spark.checkpoint.dir``. Where the session names none, a local folder is used
    if all of Spark runs on this machine; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base and spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="recordflow-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, computed now and once: written to a new shared folder and read from there."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_table(
    spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence[str | None]]
) -> DataFrame:
    """Turn Python tuples of strings into a relation, broadcast if it is small."""
    rows = list(rows)
    arrays = [pa.array([row[i] for row in rows], pa.string()) for i in range(len(columns))]
    table = spark.createDataFrame(pa.table(arrays, names=list(columns)))
    return F.broadcast(table) if len(rows) <= MAX_LITERAL_ROWS else table
