"""Intake → operations: format the records that are ready, report back what was sent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from recordflow.operators.codes import (
    RecordRule,
    age_rule,
    apply_facts,
    decrement_code,
    fact_fields,
    mapped_rule,
    record_facts,
)
from recordflow.operators.dedup import latest_instance
from recordflow.operators.keys import back_map, back_map_check, lookup
from recordflow.operators.select import CodeList, flagged_records, keep_prefixes, rename_fields
from recordflow.operators.upsert import status_rows
from recordflow.plans import fixed_values as fixed
from recordflow.schemas import EVENT, FIELD, RECORD
from recordflow.session import stored


def standard_rules(as_of: date | str) -> list[RecordRule]:
    """Second-guardian and audio/video rules of the intake job."""
    guardian, form = fixed.GUARDIAN2_CONSENT, fixed.SECOND_GUARDIAN_COMPLETE
    adult = "Not Applicable (Adult Participant)"
    return [
        mapped_rule(
            form.field,
            guardian.field,
            {guardian["No"]: form["Not Required"], guardian[adult]: form[adult]},
        ),
        age_rule(
            fixed.AUDIOVIDEO.field, fixed.ASSENT_AGE, fixed.AUDIOVIDEO["Not Applicable: no assent required"], as_of
        ),
    ]


def format_records(
    eav: DataFrame,
    rules: Sequence[RecordRule],
    renames: Mapping[str, str] = fixed.INTAKE_RENAMES,
    prefixes: Sequence[str] = fixed.INTAKE_PREFIXES,
    id_field: str = "mrn",
    decremented: str = "permission_collab",
    ready: CodeList | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rename, apply the rules, keep wanted fields, move to the record's ID, latest instance.

    Flag, rules and ID are read from the table in one aggregate and applied in one join,
    rather than in a join each, which would scan the table again for every one of them. What
    several later steps start from is written once to the shared folder: the facts, and the rows
    they were applied to.
    """
    flag = (ready.field, ready["Ready to Send"]) if ready else None
    fields = fact_fields(rules, id_field, flag)
    facts = record_facts(
        rename_fields(eav.where(F.col(FIELD).isin(*before_rename(fields, renames))), renames),
        rules,
        order_by,
        id_field,
        flag,
    )
    facts = stored(facts, "facts")
    wanted = keep_prefixes(rename_fields(eav, renames), prefixes)
    targets = [r for r in rules if r.target.startswith(tuple(prefixes))]
    if len(targets) != len(rules):
        raise ValueError("a rule sets a field that is not taken over")
    moved = stored(apply_facts(wanted, facts, rules, "inner" if flag else "left"), "moved")
    return decrement_code(latest_instance(moved, order_by), decremented)


def before_rename(fields: Sequence[str], renames: Mapping[str, str]) -> list[str]:
    """The fields and all names that are renamed to one of them."""
    return sorted({*fields, *(old for old, new in renames.items() if new in fields)})


def ready_records(eav: DataFrame, flag: CodeList = fixed.INTAKE_READY) -> DataFrame:
    """Rows of the records marked ready."""
    return flagged_records(eav, flag, "Ready to Send")


def sent_status(
    formatted: DataFrame,
    source: DataFrame,
    flag: CodeList = fixed.INTAKE_READY,
    id_field: str = "mrn",
    order_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Status rows for the pushed source records, and the one-row consistency check."""
    mapped = back_map(formatted, source, id_field, order_by)
    events = lookup(
        source.where(F.col(FIELD) == flag.field), F.col(RECORD), F.col(EVENT), order_by
    ).select(F.col("key").alias(RECORD), F.col("value").alias(EVENT))
    found = mapped.where(F.col("source_record").isNotNull())
    rows = status_rows(found, events, flag.field, flag["Participant information already sent"], record="source_record")
    return rows, back_map_check(mapped)
