"""Upserts into long and wide targets, and record numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordflow.operators.dedup import cells_text, keep_one, running_number
from recordflow.schemas import EVENT, FIELD, INSTANCE, INSTRUMENT, RECORD, VALUE

EAV_KEYS = (RECORD, EVENT, FIELD)


def eav_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str] = EAV_KEYS) -> DataFrame:
    """Target after a push: all rows of a key are replaced by the source's rows of that key.

    A key may have several rows (checkbox fields). Blank source values change nothing.
    """
    keys = [k for k in (*keys, INSTRUMENT, INSTANCE) if k in target.columns and k in source.columns]
    filled = source.where(F.col(VALUE).isNotNull() & (F.col(VALUE) != "")).distinct()
    pushed = filled.select([F.col(k).alias(f"_{k}") for k in keys]).distinct()
    on = [target[k].eqNullSafe(pushed[f"_{k}"]) for k in keys]
    return target.join(pushed, on, "left_anti").unionByName(filled, allowMissingColumns=True)


def flat_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    single: bool = False,
) -> DataFrame:
    """Target after a flat push: source cells overwrite unless blank, new keys are added.

    Both sides are first reduced to the last row of each key, so no key can be hot in the join. A
    target that has one row per key already (`single`) is not sorted for that.
    """
    # Null keys become a text of their own, so that one partitioning serves the choice and the join.
    texts = {f"_k{i}": cells_text([F.col(f"`{k}`")]) for i, k in enumerate(keys)}

    def last_per_key(df: DataFrame) -> DataFrame:
        order = [c for c in order_by if c in df.columns] if order_by else df.columns
        return keep_one(df.withColumns(texts), list(texts), order, keep="last")

    columns = [*target.columns, *[c for c in source.columns if c not in target.columns]]
    kinds = {f.name: f.dataType for f in (*source.schema.fields, *target.schema.fields)}

    def cell(name: str) -> Column:
        parts = []
        if name in source.columns:
            part = F.col(f"s.`{name}`").cast(kinds[name])
            parts.append(
                F.nullif(part, F.lit("")) if isinstance(kinds[name], T.StringType) else part
            )
        if name in target.columns:
            parts.append(F.col(f"t.`{name}`"))
        return F.coalesce(*parts).alias(name)

    known = target.withColumns(texts) if single else last_per_key(target)
    new, old = last_per_key(source).alias("s"), known.alias("t")
    on = [f"_k{i}" for i in range(len(keys))]
    return new.join(old, on, "full").select([cell(c) for c in columns])


def auto_number(
    new: DataFrame, target: DataFrame, order_by: Sequence[str], id_column: str = "record_id"
) -> DataFrame:
    """Give new rows the numbers after the target's highest record number."""
    highest = target.agg(F.coalesce(F.max(F.col(id_column).try_cast("bigint")), F.lit(0)))
    numbered = running_number(new.drop(id_column), [], order_by, "_n")
    return numbered.withColumn(id_column, F.col("_n") + highest.scalar()).drop("_n")


def insert_or_update(
    target: DataFrame,
    updates: DataFrame,
    inserts: DataFrame,
    order_by: Sequence[str],
    id_column: str = "record_id",
) -> DataFrame:
    """Target after updates by given ID and inserts with new numbers."""
    numbered = auto_number(inserts, target, order_by, id_column)
    pushed = updates.withColumn(id_column, F.col(id_column).cast("bigint")).unionByName(
        numbered.select(*updates.columns)
    )
    return flat_upsert(target.withColumn(id_column, F.col(id_column).cast("bigint")), pushed, [id_column])


def status_rows(
    records: DataFrame, events: DataFrame, field: str, value: str, record: str = RECORD
) -> DataFrame:
    """Status write-back: a four-column row per record whose event is known.

    `events` has ``record, redcap_event_name``, one row per record.
    """
    ids = records.select(F.col(record).alias(RECORD)).distinct()
    return ids.join(events, RECORD).select(
        RECORD, EVENT, F.lit(field).alias(FIELD), F.lit(value).alias(VALUE)
    )
