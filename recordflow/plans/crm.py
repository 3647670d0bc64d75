"""CRM → intake: contacts marked for transfer become new or updated records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from recordflow.functions.dates import iso_date_part
from recordflow.functions.text import short_md5
from recordflow.operators.joins import only_keys
from recordflow.operators.keys import split_updates
from recordflow.operators.ledger import unprocessed
from recordflow.operators.reshape import first_contact
from recordflow.operators.select import column_or, has_status
from recordflow.sources.scan import union_exports

# Names of the time of change, in the order tried, and the two status values.
MODIFIED = ("lastModified", "updatedAt", "modifiedDate", "updated_at")
SEND = "Send to RedCap"
SENT = "consent_form_created_in_redcap"


def marked_contacts(*exports: DataFrame, status_column: str = "cv.consent_form", status: str = SEND) -> DataFrame:
    """Rows of all studies with the status that asks for a transfer."""
    return has_status(union_exports(*exports), status_column, status)


def intake_rows(
    contacts: DataFrame, as_of: datetime | str, id_column: str = "customId"
) -> DataFrame:
    """``record_id, mrn, email_consent, cache_key``, each row once."""
    modified = column_or(contacts, MODIFIED, F.lit(str(as_of))).cast("string")
    number = F.col(f"`{id_column}`").cast("bigint")
    rows = contacts.select(
        number.alias("record_id"),
        number.alias("mrn"),
        first_contact(contacts).alias("email_consent"),
        modified.alias("_modified"),
    )
    email = short_md5(F.coalesce("email_consent", F.lit("nan")), 8)
    key = F.concat_ws(
        ":", F.col("mrn").cast("string"), email, F.coalesce(iso_date_part(F.col("_modified")), F.lit(""))
    )
    return rows.withColumn("cache_key", key).drop("_modified").distinct()


def split_intake(
    rows: DataFrame,
    target: DataFrame,
    log: DataFrame,
    ledger: str,
    as_of: datetime | str,
    ttl_minutes: int = 2,
    order_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Updates, new records, the ledger keys of the rows handled, and ``mrn, copies`` of their keys
    that several records of the target hold (the last one is updated)."""
    fresh = unprocessed(rows, log, ledger, as_of, ttl_minutes)
    update, insert, repeated = split_updates(fresh.drop("cache_key").distinct(), target, order_by=order_by)
    return update, insert, fresh.select("cache_key"), only_keys(repeated, F.col("mrn"), fresh.select("mrn"))


def study_status(contacts: DataFrame, group: str = "importType") -> DataFrame:
    """Status rows for the CRM, to be written once per study."""
    return contacts.select("globalId", F.lit(SENT).alias("cv.consent_form"), group)
