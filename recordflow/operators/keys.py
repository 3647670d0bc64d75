"""Joins: identifier remapping, lookups, splits, anti-joins.

Every lookup is reduced to one row per key before it is joined, so no join multiplies rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.functions.text import strip_complete
from recordflow.operators.codes import alert_form
from recordflow.operators.dedup import first_of, last_of
from recordflow.operators.joins import only_keys, same_key
from recordflow.operators.select import fields_with_suffix
from recordflow.schemas import EVENT, FIELD, RECORD, VALUE


def lookup(
    df: DataFrame, key: Column, value: Column, order_by: Sequence[str] | None = None, keep: str = "last"
) -> DataFrame:
    """Map with one ``value`` per ``key``; of several the last (or first) in order wins."""
    pick = last_of if keep == "last" else first_of
    order = [f"_o{i}" for i in range(len(order_by or ()))]
    pairs = df.select(
        key.alias("key"),
        value.alias("value"),
        *[F.col(f"`{c}`").alias(o) for c, o in zip(order_by or (), order)],
    )
    return pairs.where(F.col("key").isNotNull()).groupBy("key").agg(pick("value", order).alias("value"))


def remap_to_field(
    eav: DataFrame, field: str = "mrn", order_by: Sequence[str] | None = None
) -> DataFrame:
    """Replace record IDs by the record's value of `field`; records without one keep theirs."""
    ids = lookup(eav.where(F.col(FIELD) == field), F.col(RECORD), F.col(VALUE), order_by)
    ids = ids.withColumnsRenamed({"key": "_key", "value": "_id"})
    joined = eav.join(ids, same_key(F.col(RECORD), F.col("_key")), "left")
    moved = joined.withColumn(RECORD, F.coalesce("_id", RECORD)).drop("_key", "_id")
    return moved.withColumn(VALUE, F.when(F.col(FIELD) == "record_id", F.col(RECORD)).otherwise(F.col(VALUE)))


def id_map(context: DataFrame, field: str = "mrn", order_by: Sequence[str] | None = None) -> DataFrame:
    """Map from the (trimmed) value of `field` to its record."""
    return lookup(
        context.where(F.col(FIELD) == field), F.trim(VALUE), F.trim(RECORD), order_by
    ).withColumnsRenamed({"key": "_id", "value": "_target"})


def map_ids_inner(
    df: DataFrame, ids: DataFrame, column: str = RECORD
) -> tuple[DataFrame, DataFrame]:
    """Rows with their mapped ID, and the rows whose ID is unknown."""
    on = same_key(F.trim(F.col(column).cast("string")), ids["_id"])
    mapped = df.join(ids, on).withColumn(column, F.col("_target")).drop("_id", "_target")
    return mapped, df.join(ids, on, "left_anti")


def map_ids_keep(df: DataFrame, ids: DataFrame, column: str = "record_id") -> DataFrame:
    """Rows with their ID mapped where it is known; without any match nothing changes."""
    joined = df.join(ids, same_key(F.col(column).cast("string"), ids["_id"]), "left")
    return joined.withColumn(column, F.coalesce("_target", F.col(column).cast("string"))).drop(
        "_id", "_target"
    )


# ---------------------------------------------------------------- events


def enrich_events(
    df: DataFrame, context: DataFrame, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Set the event of each field from existing data.

    A field without one gets the event of the alphabetically first field that has one.
    """
    events = lookup(
        context.where(F.col(EVENT).isNotNull()), F.col(FIELD), F.col(EVENT), order_by, keep="first"
    ).withColumnsRenamed({"key": "_field", "value": "_event"})
    default = events.agg(F.min_by("_event", "_field")).scalar()
    joined = df.drop(EVENT).join(events, same_key(F.col(FIELD), F.col("_field")), "left")
    return joined.withColumn(EVENT, F.coalesce("_event", default)).drop("_field", "_event")


def event_of_field(eav: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """``field_name, redcap_event_name``; the last event of a field wins."""
    return lookup(eav, F.col(FIELD), F.col(EVENT), order_by).select(
        F.col("key").alias(FIELD), F.col("value").alias(EVENT)
    )


def event_of_form(
    form_events: DataFrame, keep: str = "first", order_by: Sequence[str] | None = None
) -> DataFrame:
    """``form, unique_event_name`` with one event per form, the first or last in order."""
    return lookup(
        form_events.where(F.col("unique_event_name").isNotNull()),
        F.col("form"),
        F.col("unique_event_name"),
        order_by,
        keep,
    ).select(F.col("key").alias("form"), F.col("value").alias("unique_event_name"))


def alert_events(
    instruments: DataFrame, form_events: DataFrame, default: str = "admin_arm_1"
) -> DataFrame:
    """Event of each instrument's alert flag: that of its alert form, else the default.

    `form_events` has one event per form (see `event_of_form`).
    """
    forms = form_events.select(F.col("form").alias("_form"), F.col("unique_event_name").alias("_event"))
    on = same_key(alert_form(F.col("instrument")), F.col("_form"))
    joined = instruments.join(forms, on, "left")
    return joined.withColumn(EVENT, F.coalesce("_event", F.lit(default))).drop("_form", "_event")


# ---------------------------------------------------------------- splits


def split_updates(
    incoming: DataFrame,
    target: DataFrame,
    key: str = "mrn",
    target_id: str = "record_id",
    order_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows to update (with the target's ID), rows to insert, and keys the target has twice."""
    known = lookup(target, F.col(key), F.col(target_id), order_by)
    on = same_key(incoming[key], known["key"])
    update = (
        incoming.drop(target_id)
        .join(known, same_key(F.col(key), known["key"]))
        .withColumn(target_id, F.col("value"))
        .select(*incoming.columns)
    )
    insert = incoming.join(known, on, "left_anti")
    repeated = target.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")
    return update, insert, repeated


def normal_email(column: Column | str) -> Column:
    """Trimmed lower-case e-mail address."""
    return F.lower(F.trim(column))


def split_by_email(
    responders: DataFrame,
    existing: DataFrame,
    email: str = "resp_email",
    order_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Responders to create, and those to update with their existing record."""
    known = lookup(existing, normal_email(email), F.col(RECORD), order_by)
    on = same_key(normal_email(email), F.col("key"))
    create = responders.join(known, on, "left_anti")
    update = responders.drop(RECORD).join(known, on)
    return create, update.withColumn(RECORD, F.col("value")).drop("key", "value")


def link_by_email(
    participants: DataFrame,
    existing: DataFrame,
    email: str = "resp_email",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Participants with an e-mail address, their responder's record added where known."""
    known = lookup(existing, normal_email(email), F.col(RECORD), order_by)
    addressed = participants.where(F.trim(email) != "").drop(RECORD)
    return (
        addressed.join(known, same_key(normal_email(email), known["key"]), "left")
        .withColumn(RECORD, F.col("value"))
        .drop("key", "value")
    )


# ---------------------------------------------------------------- semi- and anti-joins


def anti_all_columns(new: DataFrame, existing: DataFrame) -> DataFrame:
    """New rows without an equal row in `existing`, over all common columns, null equal null."""
    common = [c for c in new.columns if c in existing.columns]
    seen = existing.select([F.col(c).alias(f"_{c}") for c in common]).distinct()
    on = [new[c].eqNullSafe(seen[f"_{c}"]) for c in common]
    return new.join(seen, on, "left_anti")


def exclude_completed(df: DataFrame, completed: DataFrame, key: str = "record_id") -> DataFrame:
    """Rows of records not completed yet, without any null cell."""
    done = completed.select(F.col(key).cast("string"))
    return only_keys(df, df[key].cast("string"), done, "left_anti").dropna("any")


def lookup_by_secondary(
    df: DataFrame,
    context: DataFrame,
    secondary: str,
    primary: str,
    column: str,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add the primary ID of a secondary one as `column`; unmatched rows are dropped."""
    ids = lookup(
        context, F.col(secondary).cast("string"), F.col(primary).cast("string"), order_by, keep="first"
    )
    return (
        df.join(ids, same_key(df[secondary].cast("string"), ids["key"]))
        .withColumn(column, F.col("value"))
        .drop("key", "value")
    )


def write_back(
    eav: DataFrame,
    sent: DataFrame,
    failed: DataFrame,
    status_field: str,
    status: str,
    id_field: str = "mrn",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Status rows for the records whose ID was sent and did not fail.

    `sent` and `failed` have one column of IDs. The event is the one the status field has in
    the source; without any there is nothing to write.
    """
    ids = only_keys(sent.toDF("_id"), F.col("_id"), failed, "left_anti")
    done = only_keys(eav.where(F.col(FIELD) == id_field), F.col(VALUE), ids)
    event = (
        eav.where((F.col(FIELD) == status_field) & F.col(EVENT).isNotNull())
        .agg(last_of(EVENT, order_by))
        .scalar()
    )
    return (
        done.select(
            RECORD,
            F.lit(status_field).alias(FIELD),
            F.lit(status).alias(VALUE),
            event.alias(EVENT),
        )
        .where(F.col(EVENT).isNotNull())
        .distinct()
    )


def back_map(
    pushed: DataFrame, source: DataFrame, id_field: str = "mrn", order_by: Sequence[str] | None = None
) -> DataFrame:
    """Source record of every pushed key: ``key, source_record`` (null where none is known)."""
    keys = pushed.select(F.col(RECORD).alias("pushed_key")).distinct()
    ids = lookup(source.where(F.col(FIELD) == id_field), F.col(VALUE), F.col(RECORD), order_by)
    return keys.join(ids, keys["pushed_key"] == ids["key"], "left").select(
        "pushed_key", F.col("value").alias("source_record")
    )


def back_map_check(mapped: DataFrame) -> DataFrame:
    """One row: keys pushed, keys found again in the source, and whether they agree."""
    counts = mapped.agg(
        F.count("*").alias("pushed"), F.count("source_record").alias("found")
    )
    return counts.withColumn("consistent", F.col("pushed") == F.col("found"))


def tracked_rename(
    eav: DataFrame, dictionary: DataFrame, suffix: str = "_received"
) -> tuple[DataFrame, DataFrame]:
    """Rename ``…_complete`` fields to the tracked ``…_received`` ones; the rest is returned apart."""
    tracked = fields_with_suffix(dictionary, suffix, strip=True)
    named = eav.withColumn("_instrument", strip_complete(F.col(FIELD)))
    instrument = F.col("_instrument")
    matched = only_keys(named, instrument, tracked).withColumn(
        FIELD, F.concat(instrument, F.lit(suffix))
    )
    unmatched = only_keys(named, instrument, tracked, "left_anti")
    return matched.drop("_instrument"), unmatched.drop("_instrument")


def answered_only(
    invitations: DataFrame, answers: DataFrame, key: str = "respondent_id", keep_unanswered: bool = False
) -> DataFrame:
    """Invitations joined with their answers; unanswered ones stay only if nobody answered.

    With `keep_unanswered` they always stay.
    """
    if keep_unanswered:
        return invitations.join(answers, key, "left")
    nobody = ~only_keys(answers, F.col(key), invitations.select(key)).limit(1).exists()
    joined = invitations.join(answers, key)
    return joined.unionByName(invitations.where(nobody), allowMissingColumns=True)

