"""Checks against the data dictionary, and what is read out of error texts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.functions.dates import as_date
from recordflow.operators.joins import same_key
from recordflow.schemas import FIELD, FLAT_KEYS

# ---- fixed values: error texts of the target system ----
UNKNOWN_FIELDS = (
    r"The following fields were not found in the project as real data fields: ([^\n]+)"
)
INVALID_CATEGORY = (
    r'"([^"]+)","([^"]+)","([^"]*)","(The value is not a valid category for [^"]+)"'
)
NON_UNIQUE = "Non-unique value."
# ---- end of fixed values ----


def known_fields(
    eav: DataFrame, dictionary: DataFrame, always: Sequence[str] = ("mrn",)
) -> tuple[DataFrame, DataFrame]:
    """Rows of fields the dictionary knows, and the distinct unknown field names."""
    known = dictionary.select(F.col(FIELD).alias("_known")).distinct()
    on = same_key(F.col(FIELD), F.col("_known"))
    always_kept = F.col(FIELD).isin(*always)
    marked = eav.join(known.withColumn("_hit", F.lit(True)), on, "left")
    kept = marked.where(F.col("_hit") | always_kept).drop("_known", "_hit")
    unknown = eav.select(FIELD).where(~always_kept).distinct().join(known, on, "left_anti")
    return kept, unknown


def column_gate(
    df: DataFrame, dictionary: DataFrame, instrument: str, keys: Sequence[str] = FLAT_KEYS
) -> tuple[DataFrame, list[str]]:
    """Frame with only key columns and columns the dictionary knows; the unknown names.

    What is fetched is bounded by the number of columns of the frame.
    """
    rows = dictionary.where(F.col(FIELD).isin(*df.columns)).select(FIELD).distinct().collect()
    known = {row[0] for row in rows} | {f"{instrument.lower()}_complete"}
    unknown = [c for c in df.columns if c not in known and c not in keys]
    if not unknown:
        return df, []
    ids = [c for c in keys if c in df.columns]
    return df.select(*ids, *[c for c in df.columns if c in known and c not in ids]), unknown


def data_columns(df: DataFrame, key: str = "record_id", keys: Sequence[str] = FLAT_KEYS) -> list[str]:
    """Data columns of an instrument frame; empty if it lacks the key."""
    return [c for c in df.columns if c not in keys] if key in df.columns else []


def error_fields(errors: DataFrame, text: str = "error") -> DataFrame:
    """One row per unknown field named in an error text (column ``field_name`` is added)."""
    names = F.nullif(F.regexp_extract(text, UNKNOWN_FIELDS, 1), F.lit(""))
    return errors.withColumn(FIELD, F.explode(F.split(names, ","))).withColumn(FIELD, F.trim(FIELD))


def error_categories(errors: DataFrame, text: str = "error") -> DataFrame:
    """``record, field_name, value, error_message`` of every invalid category in an error text."""

    def group(i: int) -> Column:
        return F.regexp_extract_all(text, F.lit(INVALID_CATEGORY), F.lit(i))

    zipped = F.arrays_zip(
        group(1).alias("record"),
        group(2).alias("field_name"),
        group(3).alias("value"),
        group(4).alias("error_message"),
    )
    rest = [c for c in errors.columns if c != text]
    return errors.select(*rest, F.explode(zipped).alias("e")).select(*rest, "e.*")


def new_today(
    names: DataFrame, log: DataFrame, as_of: date | str, retention_days: int = 7
) -> tuple[DataFrame, DataFrame]:
    """Names not logged today yet, and the log with them added and old days removed.

    Both frames have ``field_name``; the log also has ``day``.
    """
    today = as_date(as_of)
    logged = log.where(F.col("day") == today).select(FIELD)
    new = names.select(FIELD).distinct().join(logged, FIELD, "left_anti")
    kept = log.where(F.col("day") >= F.date_sub(today, retention_days))
    return new, kept.unionByName(new.withColumn("day", today))


def outcome_class(status: Column, message: Column) -> Column:
    """Outcome of a push: created, exists or error."""
    exists = (status == 422) | ((status == 400) & (F.coalesce(message, F.lit("")) == NON_UNIQUE))
    return F.when(status == 200, "created").when(exists, "exists").otherwise("error")

