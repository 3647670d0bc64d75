"""Questionnaire data load: skip unchanged instruments, map IDs, check, drop known rows, upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordflow.operators.codes import default_no
from recordflow.operators.dedup import changed_rows
from recordflow.operators.joins import only_keys
from recordflow.operators.keys import map_ids_keep
from recordflow.operators.ledger import unchanged_groups
from recordflow.operators.quality import column_gate, data_columns
from recordflow.operators.reshape import column_chunks
from recordflow.operators.select import target_of
from recordflow.operators.upsert import flat_upsert
from recordflow.schemas import EVENT, FLAT_KEYS

CHUNK_THRESHOLD = 150
CHUNK_COLUMNS = 100
RECORD_ID = "record_id"
NO_KEY, NO_DATA = "no key column", "no data columns"


def route(outputs: DataFrame, prefixes: Sequence[str], matched: str, other: str) -> DataFrame:
    """Rows with the target of their instrument."""
    return outputs.withColumn("target", target_of(F.col("instrument"), prefixes, matched, other))


def to_load(
    outputs: DataFrame, log: DataFrame, ledger: str, as_of: datetime | str, ttl_minutes: int = 2
) -> tuple[DataFrame, DataFrame]:
    """Rows of instruments whose content is not in the ledger, and all instruments' keys."""
    load, skip = unchanged_groups(outputs, log, ledger, as_of, ttl_minutes=ttl_minutes)
    rows = only_keys(outputs, F.col("instrument"), load.select("instrument"))
    keys = load.withColumn("skipped", F.lit(False)).unionByName(
        skip.withColumn("skipped", F.lit(True))
    )
    return rows, keys


def reject_reason(df: DataFrame, key: str = RECORD_ID) -> str | None:
    """Why an instrument cannot be loaded, if so."""
    if key not in df.columns:
        return NO_KEY
    return None if data_columns(df, key) else NO_DATA


def loadable(instruments: Mapping[str, DataFrame], key: str = RECORD_ID) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Instruments that can be loaded, and the reason for each other one (`finish.writes` reports them)."""
    reasons = {name: reject_reason(df, key) for name, df in instruments.items()}
    fine = {name: df for name, df in instruments.items() if not reasons[name]}
    return fine, {name: reason for name, reason in reasons.items() if reason}


def rejected_instruments(instruments: Mapping[str, DataFrame], spark: SparkSession, key: str = RECORD_ID) -> DataFrame:
    """``instrument, reason, row_count`` of the instruments that cannot be loaded."""
    rows = [
        instruments[name].agg(F.lit(name).alias("instrument"), F.lit(reason).alias("reason"), F.count("*").alias("row_count"))
        for name, reason in loadable(instruments, key)[1].items()
    ]
    return reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], "instrument string, reason string, row_count long")


def prepare(
    df: DataFrame,
    ids: DataFrame,
    dictionary: DataFrame,
    existing: DataFrame,
    instrument: str,
    positives: DataFrame | None = None,
    alert_event: str | None = None,
    keys: Sequence[str] = ("record_id", EVENT),
    order_by: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Rows of one instrument that are new or changed, and the columns the dictionary lacks.

    The instrument must have its key and data columns; `loadable` sets the others aside.
    """
    if reason := reject_reason(df):
        raise ValueError(f"{instrument}: {reason}")
    mapped = map_ids_keep(df, ids)
    if positives is not None:
        mapped = default_no(mapped, positives, instrument, alert_event, event_column=EVENT)
    known, unknown = column_gate(mapped, dictionary, instrument)
    keys = [k for k in keys if k in known.columns]
    columns = [c for c in known.columns if c not in FLAT_KEYS and c in existing.columns]
    return changed_rows(known, existing, keys, columns, order_by), unknown


def slices(df: DataFrame, threshold: int = CHUNK_THRESHOLD, width: int = CHUNK_COLUMNS) -> list[DataFrame]:
    """Column slices of a wide frame, or the frame itself if it is narrow enough."""
    return column_chunks(df, width) if len(df.columns) > threshold else [df]


def load(existing: DataFrame, changed: DataFrame, keys: Sequence[str] = ("record_id", EVENT)) -> DataFrame:
    """Target table after the load."""
    return flat_upsert(existing, changed, [k for k in keys if k in existing.columns])
