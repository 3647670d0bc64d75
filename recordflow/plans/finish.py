"""The end of every job: targets are pushed, outputs written, keys marked and the run reported, as one commit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import md5
from datetime import datetime

from pyspark.sql import DataFrame

from recordflow.operators.dedup import run_results
from recordflow.operators.ledger import entries
from recordflow.sources.journal import BucketedTable, Journal, Output, Write

REPORT, LEDGER = "report", "ledger"
REPORT_SCHEMA = "status string, successes long, failures long, failed string, exit_line string"


def writes(
    journal: Journal,
    as_of: datetime | str,
    pushes: Mapping[BucketedTable, DataFrame] | None = None,
    outputs: Mapping[str, DataFrame] | None = None,
    keys: DataFrame | None = None,
    failed: Mapping[str, str] | None = None,
) -> dict[str, Write]:
    """What a run writes, in order: upserts, outputs, ledger entries of the one-column `keys`, the report.

    `failed`: instruments that could not be pushed, with the reason; the report names them. The
    report counts the rows given to each target.
    """
    counts: dict[str, int] = {}

    def counted(name: str, write: Write) -> Write:
        def count(run: str) -> int:
            counts[name] = write(run)
            return counts[name]

        return count

    def report(run: str) -> int:
        spark = journal.spark
        outcomes = [(name, n, True) for name, n in counts.items()] + [(name, 0, False) for name in failed or {}]
        rows = run_results(spark.createDataFrame(outcomes, "instrument string, rows long, ok boolean"))
        return Output(journal, REPORT).write(rows)(run)

    steps = {table.name: counted(table.name, table.push(rows)) for table, rows in (pushes or {}).items()}
    steps |= {name: counted(name, Output(journal, name).write(rows)) for name, rows in (outputs or {}).items()}
    if keys is not None:
        steps[LEDGER] = Output(journal, LEDGER).write(entries(keys, LEDGER, as_of))
    return steps | {REPORT: report}


def finish(journal: Journal, run: str, as_of: datetime | str, **targets) -> bool:
    """Run a job's writes and commit them; see `writes`. False if the run is committed already."""
    return not journal.committed(run) and journal.run(run, writes(journal, as_of, **targets), as_of)


def slice_run(run: str, part: DataFrame) -> str:
    """The run of one column slice, named by its columns."""
    return f"{run}-{md5(','.join(part.columns).encode()).hexdigest()[:12]}"


def push_slices(journal: Journal, run: str, table: BucketedTable, slices: Sequence[DataFrame], as_of: datetime | str) -> int:
    """Push the column slices of a wide frame one by one; how many were pushed.

    Each slice is a run of its own, so one that has landed is neither computed nor sent again when a
    push that ended in between is resumed under the same name. Readers see the slices landed so far;
    cells of the others keep their values.
    """
    return sum(journal.run(slice_run(run, part), {table.name: table.push(part)}, as_of) for part in slices)
