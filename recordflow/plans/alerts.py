"""Alerts: messages become coded rows with a summary flag; batch and stream share this."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from recordflow.functions.text import alert_answer, alert_field, short_md5
from recordflow.operators.codes import choice_rows, label_to_code
from recordflow.operators.dedup import summary_flags
from recordflow.operators.joins import only_keys
from recordflow.operators.keys import enrich_events, id_map, map_ids_inner
from recordflow.operators.ledger import unprocessed
from recordflow.operators.quality import known_fields
from recordflow.schemas import EVENT, FIELD, RECORD, VALUE


def parsed_alerts(alerts: DataFrame) -> DataFrame:
    """Long rows of the answer alerts: the item's answer and the respondent's ID.

    Messages of another type or shape give none.
    """
    secret, message = F.col("secretId"), F.col("message")
    pairs = F.array(
        F.struct(F.lit("mrn").alias(FIELD), secret.alias(VALUE)),
        F.struct(alert_field(message).alias(FIELD), alert_answer(message).alias(VALUE)),
    )
    good = alerts.where(
        (F.col("type") == "answer") & secret.isNotNull() & alert_field(message).isNotNull()
    )
    return good.select(secret.alias(RECORD), F.explode(pairs).alias("p")).select(
        RECORD, "p.*", F.lit(None).cast("string").alias(EVENT)
    )


def rejected_alerts(alerts: DataFrame) -> DataFrame:
    """Answer alerts that cannot be read."""
    bad = F.col("secretId").isNull() | alert_field(F.col("message")).isNull()
    return alerts.where((F.col("type") == "answer") & F.coalesce(bad, F.lit(True)))


def coded_alerts(
    eav: DataFrame, dictionary: DataFrame, context: DataFrame, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Known fields, under their record, with codes, events and summary flags.

    `context` holds the target's ``mrn`` rows and its rows of alert fields.
    """
    return split_alerts(eav, dictionary, context, order_by)[0]


def split_alerts(
    eav: DataFrame, dictionary: DataFrame, context: DataFrame, order_by: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Coded rows, and the rows of fields the dictionary lacks or of records the target lacks.

    The latter have ``record, field_name, value, reason``: no row of `eav` but the ``mrn`` rows is
    in neither.
    """
    items = eav.where(F.col(FIELD) != "mrn")
    known, _ = known_fields(items, dictionary)
    unknown = only_keys(items, F.col(FIELD), dictionary.select(FIELD), "left_anti")
    mapped, unmapped = map_ids_inner(enrich_events(known, context, order_by), id_map(context, order_by=order_by))
    rejected = [
        df.select(RECORD, FIELD, VALUE, F.lit(reason).alias("reason"))
        for df, reason in ((unknown, "unknown field"), (unmapped, "unknown record"))
    ]
    return summary_flags(label_to_code(mapped, choice_rows(dictionary))), rejected[0].unionByName(rejected[1])


def new_alerts(
    alerts: DataFrame, log: DataFrame, ledger: str, as_of: datetime | str, ttl_minutes: int = 2
) -> DataFrame:
    """Alerts whose ID and message are not in the ledger; their key is added."""
    key = F.concat_ws(":", F.coalesce("id", F.lit("")), short_md5(F.coalesce("message", F.lit("")), 8))
    return unprocessed(alerts.withColumn("cache_key", key), log, ledger, as_of, ttl_minutes)
