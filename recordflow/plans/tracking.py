"""Completion tracking: completed questionnaires become `received` marks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recordflow.operators.codes import complete_to_received
from recordflow.operators.dedup import tracking_report
from recordflow.operators.keys import anti_all_columns, tracked_rename


def new_marks(
    source: DataFrame, target: DataFrame, dictionary: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Marks the target lacks, completed fields it does not track, and the run report.

    Fields are renamed before the comparison, so that equal marks are found.
    """
    done = complete_to_received(source)
    marks, untracked = tracked_rename(done, dictionary)
    new = anti_all_columns(marks.distinct(), target)
    return new, untracked, tracking_report(new)
