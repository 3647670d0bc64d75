"""Jobs to their end: targets upserted, outputs written, keys marked, the run reported and committed.

Every query runs its job three times on one journal: a first run with part of the rows; a second
with all, which dies after its first target and is repeated; and the second once more, which finds
itself committed. What readers see must be the job's whole result, once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog import jobs, landing  # noqa: F401  (their queries are looked up by name)
from catalog.base import ENTRIES, query, table, text
from recordflow.plans import data_load, finish
from recordflow.session import shared_dir, stored
from recordflow.sources.journal import BucketedTable, Journal, Output

EAV = ("record", "redcap_event_name", "field_name", "value")


class Died(RuntimeError):
    """A run that ended between two targets."""


def _died(run: str) -> int:
    raise Died(run)


def _lines(target: str, df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    cells = [F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    return df.select(F.lit(target).alias("target"), F.concat_ws("|", *cells).alias("line"))


def _finished(
    spark: SparkSession,
    sf: str,
    pushes: dict[str, tuple[str, ...]],
    outputs: dict[str, tuple[str, ...]],
    keys: str | None = None,
    flat: tuple[str, ...] = (),
    failed: dict[str, str] | None = None,
) -> DataFrame:
    """`pushes`, `outputs`: columns of the results of other queries; `flat`: the key of wide targets."""
    journal = Journal(spark, shared_dir(spark, "job"))
    # All runs are given the same rows, so the job's are computed once.
    frames = {name: stored(ENTRIES[name].run(spark, sf).select(*[f"`{c}`" for c in columns]), "given") for name, columns in (pushes | outputs).items()}
    schemas = {name: df.schema for name, df in frames.items()}
    make = (lambda n: BucketedTable.flat(journal, n, schemas[n], flat, 8)) if flat else (lambda n: BucketedTable.long(journal, n, schemas[n], buckets=8))
    tables = {name: make(name) for name in pushes}

    def steps(rows: Callable[[str], DataFrame], as_of: str) -> dict:
        marked = ENTRIES[keys].run(spark, sf) if keys else None
        return finish.writes(journal, as_of, {t: rows(n) for n, t in tables.items()}, {n: rows(n) for n in outputs}, marked, failed)

    # As if an earlier run had seen only some records.
    some = {n: frames[n].where(F.crc32(F.coalesce(F.col(f"`{c[0]}`").cast("string"), F.lit("")).cast("binary")) % 2 == 0) for n, c in pushes.items()}
    if some:
        journal.run("run-1", {tables[n].name: tables[n].push(df) for n, df in some.items()}, "2024-02-01T00:00:00")
    whole = steps(frames.__getitem__, "2024-02-01T01:00:00")
    first, *rest = whole
    try:
        journal.run("run-2", {first: whole[first], "crash": _died, **{n: whole[n] for n in rest}}, "2024-02-01T01:00:00")
    except Died:
        journal.run("run-2", whole, "2024-02-01T01:05:00")
    journal.run("run-2", {first: _died}, "2024-02-01T01:10:00")

    parts = [_lines(n, t.read(), pushes[n]) for n, t in tables.items()]
    parts += [_lines(n, Output(journal, n).read(schemas[n]), c) for n, c in outputs.items()]
    if keys:
        parts.append(_lines("ledger", Output(journal, "ledger").read("key string"), ("key",)))
    parts.append(_lines("report", Output(journal, "report").read(finish.REPORT_SCHEMA), ("status", "successes", "failures", "failed")))
    parts.append(_lines("journal", journal.lines(), ("number", "run", "target", "row_count")))
    return reduce(DataFrame.unionByName, parts)


def _sql(
    pushes: dict[str, tuple[str, ...]],
    outputs: dict[str, tuple[str, ...]],
    keys: str | None = None,
    flat: tuple[str, ...] = (),
    failed: dict[str, str] | None = None,
) -> str:
    with_, parts, counts, lines = [], [], [], []

    def text(columns: tuple[str, ...]) -> str:
        return "concat_ws('|', " + ", ".join(f"nullif(CAST(\"{c}\" AS VARCHAR), '')" for c in columns) + ")"

    for name, columns in (pushes | outputs).items():
        picked = ", ".join(f'"{c}"' for c in columns)
        rows = f"SELECT {picked} FROM ({ENTRIES[name].sql})"
        if name in pushes and not flat:
            rows = f"SELECT DISTINCT {picked} FROM ({ENTRIES[name].sql}) WHERE value IS NOT NULL AND value <> ''"
        with_.append(f"{name} AS MATERIALIZED ({rows})")
        parts.append(f"SELECT '{name}' AS target, {text(columns)} AS line FROM {name}")
        given = f"(SELECT count(*) FROM ({ENTRIES[name].sql}))"
        lines.append(f"SELECT 'journal', '2|run-2|{name}|' || {given}")
        counts.append(given)
        if name in pushes:
            # The first run pushes records by a checksum; how many is for its own line, compared apart.
            lines.append(f"SELECT 'journal', '1|run-1|{name}'")
    if keys:
        with_.append(f"ledger_keys AS MATERIALIZED (SELECT DISTINCT cache_key FROM ({ENTRIES[keys].sql}))")
        parts.append("SELECT 'ledger', CAST(cache_key AS VARCHAR) FROM ledger_keys")
        lines.append("SELECT 'journal', '2|run-2|ledger|' || (SELECT count(*) FROM ledger_keys)")
    total = " + ".join(counts)
    state = "'failure'" if failed else f"CASE WHEN {total} = 0 THEN 'no data' ELSE 'success' END"
    names = ",".join(sorted(failed or {}))
    parts.append(f"SELECT 'report', concat_ws('|', {state}, {total}, {len(failed or {})}, nullif('{names}', ''))")
    lines.append("SELECT 'journal', '2|run-2|report|1'")
    return f"WITH {', '.join(with_)} " + " UNION ALL ".join(parts + lines)


def finished(name: str, **job) -> None:
    """Register a job's end."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = _finished(spark, sf, **job)
        return out.withColumn("line", F.regexp_replace("line", r"^(1\|run-1\|\w+)\|\d+$", "$1"))

    run.__name__ = name
    query(_sql(**job))(run)


finished(
    "finished_intake",
    pushes={"job_intake": EAV},
    outputs={"job_intake_status": EAV},
)
finished(
    "finished_accounts",
    pushes={"job_accounts_sent": EAV},
    outputs={"job_accounts": ("target", "secretUserId", "route", "body")},
)
finished(
    "finished_responders",
    pushes={"job_responders_known": ("record", "resp_email", "resp_fname", "resp_lname", "resp_phone", "source_record")},
    outputs={
        "job_responders": ("resp_email", "resp_fname", "resp_lname", "resp_phone", "source_record"),
        "job_participants": ("record", "resp_email", "redcap_repeat_instance", "child_dob", "child_fname", "mrn", "participant_type", "source_record"),
    },
    flat=("record", "resp_email", "source_record"),
)
finished(
    "finished_tracking",
    pushes={"job_tracking": EAV},
    outputs={"job_tracking_unknown": EAV, "job_tracking_report": ("names", "instruments", "records")},
)
finished(
    "finished_data_load",
    pushes={"job_data_target": ("record_id", "redcap_event_name", "status", "price", "day", "priority")},
    outputs={"job_data_route": ("instrument", "target", "row_count"), "job_data_rejected": ("instrument", "reason", "row_count")},
    flat=("record_id", "redcap_event_name"),
    failed={"customers": "no key column", "orders_without_answers": "no data columns"},
)
finished(
    "finished_invitations",
    pushes={
        "job_invitations": (
            "record_id", "redcap_event_name", "account_created_source_secret_id", "account_created_invite_status",
            "account_created_responder_complete", "account_created_account_created_response",
        )
    },
    outputs={},
    keys="job_invitation_keys",
    flat=("record_id", "redcap_event_name"),
)
finished(
    "finished_alerts",
    pushes={"job_alerts": EAV},
    outputs={},
)
finished(
    "finished_crm",
    pushes={"job_crm": ("record_id", "mrn", "email_consent")},
    outputs={
        "job_crm_new": ("record_id", "mrn", "email_consent"),
        "job_crm_repeated": ("mrn", "copies"),
        "job_crm_status": ("globalId", "cv.consent_form", "importType"),
    },
    keys="job_crm_keys",
    flat=("record_id",),
)


# ---------------------------------------------------------------- a wide push in slices

_ANSWERS = range(30)


def _answer(i: int) -> str:
    return f"nullif((o_orderkey * {2 * i + 1} + o_custkey) % {i + 7}, 0)"


def _cell(i: int) -> str:
    # The target holds a value for every second order; a blank answer leaves it.
    return f"coalesce({_answer(i)}, CASE WHEN o_orderkey % 2 = 0 THEN -1 END)"


@query(
    "SELECT CAST(o_orderkey AS VARCHAR) AS record_id, "
    + ", ".join(f"CAST({_cell(i)} AS VARCHAR) AS a{i}" for i in _ANSWERS)
    + " FROM orders"
)
def finished_slices(spark: SparkSession, sf: str) -> DataFrame:
    """30 answers of every order in slices of 12: the push dies before the third slice and is resumed, then repeated."""
    orders = table(spark, sf, "orders")
    wide = orders.select(text("o_orderkey").alias("record_id"), *[F.expr(f"CAST({_answer(i)} AS STRING)").alias(f"a{i}") for i in _ANSWERS])
    held = orders.where("o_orderkey % 2 = 0").select(text("o_orderkey").alias("record_id"), *[F.lit("-1").alias(f"a{i}") for i in _ANSWERS])
    journal = Journal(spark, shared_dir(spark, "job"))
    target = BucketedTable.flat(journal, "answers", wide.schema, ["record_id"], 8)
    journal.run("before", {"answers": target.push(held)}, "2024-02-01T00:00:00")
    parts = data_load.slices(wide, threshold=20, width=12)
    finish.push_slices(journal, "wide", target, parts[:2], "2024-02-01T01:00:00")
    try:
        journal.run(finish.slice_run("wide", parts[2]), {"answers": target.push(parts[2]), "crash": _died}, "2024-02-01T01:00:00")
    except Died:
        finish.push_slices(journal, "wide", target, parts, "2024-02-01T01:05:00")
    finish.push_slices(journal, "wide", target, parts, "2024-02-01T01:10:00")
    return target.read()
