"""Operations → app accounts: the accounts to create, and the write-back for those that worked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from recordflow.functions.nested import account_route, in_set_or_null, outbound_body
from recordflow.functions.text import strip_zeros, zero_pad
from recordflow.operators.keys import write_back
from recordflow.operators.quality import outcome_class
from recordflow.operators.reshape import individual_frame
from recordflow.operators.select import CodeList, drop_present, expand_variants, flagged_records
from recordflow.plans import fixed_values as fixed

# Columns used to select children; they are not part of an account.
SELECTION_COLUMNS = ("parent_involvement", "adult_enrollment_form_complete")


def individuals(
    eav: DataFrame,
    child_renames: Mapping[str, str],
    parent_renames: Mapping[str, str] = fixed.PARENT_RENAMES,
    child: Mapping[str, str | None] = fixed.CHILD_ACCOUNT,
    parent: Mapping[str, str | None] = fixed.PARENT_ACCOUNT,
    order_by: Sequence[str] | None = None,
    ready: CodeList | None = fixed.ENROLLMENT_COMPLETE,
) -> tuple[DataFrame, DataFrame]:
    """Child and parent frames; children only where a parent takes part (or it is unknown).

    Only records whose `ready` field says so get accounts; without one, all do.
    """
    if ready is not None:
        eav = flagged_records(eav, ready, "Ready to Send")
    children = individual_frame(eav, child_renames, child, order_by)
    if "parent_involvement" in children.columns:
        involved = F.when(
            F.col("parent_involvement").isNotNull(), F.split("parent_involvement", ",")
        )
        children = children.where(in_set_or_null(involved))
    children = drop_present(children, SELECTION_COLUMNS).withColumn(
        "secretUserId", zero_pad(F.col("secretUserId"), 5)
    )
    return children, individual_frame(eav, parent_renames, parent, order_by)


def account_requests(children: DataFrame, parents: DataFrame) -> DataFrame:
    """One request per account: ``target, secretUserId, route, body``.

    A child gets a full account in the child application and a limited one in the parent's;
    a parent a full one in the parent's.
    """

    def requests(people: DataFrame, variants: Sequence[str], target) -> DataFrame:
        accounts = expand_variants(people.drop("record"), "accountType", variants)
        return accounts.select(
            target.alias("target"),
            "secretUserId",
            account_route(F.col("accountType")).alias("route"),
            outbound_body(accounts).alias("body"),
        )

    child_target = F.when(F.col("accountType") == "full", "child").otherwise("parent")
    return requests(children, ["full", "limited"], child_target).unionByName(
        requests(parents, ["full"], F.lit("parent"))
    )


def sent_accounts(
    eav: DataFrame,
    children: DataFrame,
    outcomes: DataFrame,
    status_field: str = fixed.ENROLLMENT_COMPLETE.field,
    status: str = fixed.ENROLLMENT_COMPLETE["Parent and Participant information already sent"],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Status rows for children none of whose pushes failed.

    `outcomes` is the landed table of pushes: ``secretUserId, status, message``.
    """
    failed = outcomes.where(outcome_class(F.col("status"), F.col("message")) == "error")
    plain = strip_zeros(F.col("secretUserId"))
    return write_back(
        eav, children.select(plain), failed.select(plain), status_field, status, order_by=order_by
    )
