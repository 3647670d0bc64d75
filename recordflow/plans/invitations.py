"""Invitations: respondents and their answers become account rows of the target forms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.functions.dates import is_recent, iso_timestamp
from recordflow.functions.nested import entry_by_id, normalize_options, pair_items, response_value
from recordflow.functions.text import strip_zeros, with_composite_key
from recordflow.operators.codes import completion_status
from recordflow.operators.dedup import changed_rows, keep_one
from recordflow.operators.keys import answered_only, exclude_completed, lookup_by_secondary
from recordflow.operators.ledger import unprocessed
from recordflow.operators.select import add_suffix, strip_infix
from recordflow.plans import fixed_values as fixed
from recordflow.schemas import EVENT


@dataclass(frozen=True)
class Account:
    """Field naming of one kind of account: ``<prefix><base><suffix>``."""

    prefix: str = "account_created_"
    kind: str = "responder"
    event: str = "admin_arm_1"

    @property
    def suffix(self) -> str:
        return "_c" if self.kind == "child" else ""

    @property
    def instrument(self) -> str:
        return f"{self.prefix}{self.kind}"

    @property
    def complete(self) -> str:
        return f"{self.instrument}_complete"

    def field(self, base: str) -> str:
        return f"{self.prefix}{base}{self.suffix}"


def invitation_rows(
    respondents: DataFrame,
    application: str,
    account: Account,
    as_of: date | str,
    id_context: DataFrame | None = None,
) -> DataFrame:
    """One row per recently seen respondent of the application.

    For responders the record is looked up by responder ID in `id_context`
    (``r_id, record_id``); respondents without one are dropped.
    """
    recent = respondents.where(is_recent(F.col("lastSeen"), as_of))
    detail = entry_by_id(F.col("details"), "appletId", F.lit(application), last=True)
    seen = recent.select(
        "status", detail["respondentSecretId"].alias("_secret"), detail["subjectId"].alias("respondent_id")
    ).where(F.col("_secret").isNotNull())
    status = fixed.INVITATION_STATUS.encode(F.col("status"))
    rows = seen.select(
        strip_zeros(F.col("_secret")).alias(account.field("source_secret_id")),
        status.alias(account.field("invite_status")),
        F.lit(account.event).alias(EVENT),
        F.lit(fixed.COMPLETE["Incomplete"]).alias(account.complete),
        "respondent_id",
    )
    secret = account.field("source_secret_id")
    if account.kind == "responder" and id_context is not None:
        ids = id_context.select(F.col("r_id").alias(secret), "record_id")
        return lookup_by_secondary(rows, ids, secret, "record_id", "record_id")
    return rows.withColumn("record_id", F.col(secret))


def answer_rows(answers: DataFrame, instrument: str) -> DataFrame:
    """Nested frame of answers: one row per item, with activity, item, response and user structs."""
    label = instrument.replace("_", " ").title()
    none = F.lit(None).cast("string")

    def user(secret: Column) -> Column:
        return F.struct(
            secret.alias("secret_id"),
            none.alias("id"),
            none.alias("nickname"),
            none.alias("relation"),
            none.alias("tag"),
        )

    rest = [c for c in answers.columns if c not in ("items", "answer")]
    pairs = answers.select(*rest, F.explode(pair_items(F.col("items"), F.col("answer"))).alias("p"))
    item, answer = F.col("p.item"), F.col("p.answer")
    submission = F.coalesce("submitId", F.lit(instrument))
    start, end = iso_timestamp(F.col("startDatetime")), iso_timestamp(F.col("endDatetime"))
    keys = [c for c in ("record_id", EVENT, "respondent_id") if c in answers.columns]
    return pairs.select(
        *keys,
        F.col("p.position").alias("position"),
        F.make_dt_interval().alias("utc_timezone_offset"),
        F.coalesce("version", F.lit("")).alias("applet_version"),
        F.struct(F.lit(instrument).alias("id"), F.lit(label).alias("name")).alias("activity"),
        F.struct(
            F.lit(instrument).alias("id"),
            F.lit(label).alias("name"),
            submission.alias("submission_id"),
        ).alias("activity_flow"),
        F.struct(submission.alias("id"), none.alias("review_id")).alias("activity_submission"),
        F.struct(
            none.alias("id"),
            none.alias("history_id"),
            F.lit(None).cast("timestamp").alias("start_time"),
        ).alias("activity_schedule"),
        F.struct(
            item["id"].alias("id"),
            item["name"].alias("name"),
            F.coalesce(item["question"]["en"], F.lit("")).alias("prompt"),
            item["responseType"].alias("type"),
            none.alias("raw_options"),
            normalize_options(item["responseValues"]["options"]).alias("response_options"),
        ).alias("item"),
        F.struct(
            F.lit("completed").alias("status"),
            none.alias("raw_score"),
            none.alias("raw_response"),
            response_value(item["responseType"], answer["value"]).alias("value"),
        ).alias("response"),
        user(F.coalesce("respondentSecretId", F.lit(""))).alias("target_user"),
        user(F.coalesce("sourceSecretId", F.lit(""))).alias("source_user"),
        user(none).alias("input_user"),
        user(none).alias("account_user"),
        F.struct(start.alias("start_time"), end.alias("end_time")).alias("activity_time"),
    )


def target_columns(formatted: DataFrame, account: Account) -> DataFrame:
    """Rename the wide columns of an answer to those of the target form."""
    named = strip_infix(formatted, account.prefix, f"{account.kind}_")
    return add_suffix(named, account.prefix, account.suffix) if account.suffix else named


def load_rows(
    invitations: DataFrame,
    completed: DataFrame,
    responses: DataFrame,
    existing: DataFrame,
    log: DataFrame,
    ledger: str,
    as_of: datetime | str,
    account: Account,
    ttl_minutes: int = 2,
    order_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows to push and the ledger keys of all rows handled.

    `responses` has ``respondent_id`` and the response field; `completed` has ``record_id``.
    """
    status, response = account.field("invite_status"), account.field("account_created_response")
    open_rows = exclude_completed(invitations, completed)
    keyed = with_composite_key(
        open_rows.withColumn("_answered", F.lit(False)), ["record_id", status, "_answered"]
    ).drop("_answered")
    fresh = unprocessed(keyed, log, ledger, as_of, ttl_minutes).drop("cache_key")
    answered = answered_only(fresh, responses)
    has_response = response in answered.columns
    replied = F.col(response).isNotNull() if has_response else F.lit(False)
    by_invite = completion_status(None, F.col(status))
    by_response = completion_status(F.col(response), F.col(status)) if has_response else by_invite
    answered = answered.withColumn(
        account.complete, F.when(replied, by_response).otherwise(by_invite)
    ).withColumn("_answered", replied)
    final = with_composite_key(answered, ["record_id", status, "_answered"]).drop("_answered")
    last = keep_one(final, ["record_id"], order_by, keep="last")
    columns = [c for c in last.columns if c not in ("cache_key", "respondent_id")]
    push = changed_rows(last.select(*columns), existing, ["record_id", EVENT], order_by=None)
    return push, last.select("cache_key")
