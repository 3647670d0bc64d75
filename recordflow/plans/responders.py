"""Responder tracking: responders to create or update, participants linked to them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from recordflow.functions.text import responder_id
from recordflow.operators.dedup import keep_one, next_instance
from recordflow.operators.keys import link_by_email, split_by_email
from recordflow.operators.reshape import Pairing, eav_to_wide, role_pairs
from recordflow.operators.select import CodeList, flagged_records
from recordflow.plans import fixed_values as fixed

CONTACT = ["resp_email", "resp_fname", "resp_lname", "resp_phone"]


def stacked_roles(
    eav: DataFrame,
    pairings: Iterable[Pairing] = fixed.RESPONDER_PAIRINGS,
    order_by: Sequence[str] | None = None,
    ready: CodeList | None = fixed.INTAKE_READY,
) -> DataFrame:
    """One row per responder of a ready record, with the participant they answer for.

    Without `ready`, all records count.
    """
    if ready is not None:
        eav = flagged_records(eav, ready, "Ready to Send")
    pairings = list(pairings)
    fields = list(dict.fromkeys(f for p in pairings for f in (*p.responder, *p.participant)))
    return role_pairs(eav_to_wide(eav, fields, order_by=order_by), pairings)


def responders(roles: DataFrame) -> DataFrame:
    """Responders with an e-mail address, the most complete row of each address."""
    addressed = roles.where(F.trim("resp_email") != "")
    return keep_one(addressed.select(*CONTACT, "source_record"), ["resp_email"], [*CONTACT, "source_record"])


def responder_changes(roles: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Responders to create and responders to update, against ``record, resp_email``."""
    return split_by_email(responders(roles), existing, order_by=["record"])


def track(
    roles: DataFrame,
    existing: DataFrame,
    existing_participants: DataFrame | None = None,
    order_by: Sequence[str] = ("source_record", "pairing"),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Responders to create, responders to update, and participants with their instance.

    `existing` has ``record, resp_email``; `existing_participants` has ``record,
    redcap_repeat_instance``.
    """
    create, update = responder_changes(roles, existing)
    linked = link_by_email(roles, existing, order_by=["record"])
    numbered = next_instance(linked, existing_participants, list(order_by))
    return create, update, numbered.select(
        "record",
        "resp_email",
        "redcap_repeat_instance",
        "child_dob",
        "child_fname",
        "mrn",
        "participant_type",
        "source_record",
    )


def responder_ids(existing: DataFrame) -> DataFrame:
    """``record, resp_email`` with the responder number written as an ID."""
    return existing.select(responder_id(F.col("record")).alias("record"), "resp_email")
