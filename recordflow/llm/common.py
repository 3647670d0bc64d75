"""Words, document keys and shared folders for the text operators.

A document is told apart by its ID and its text: rows that repeat both are the same document and
get the same result, each in its own row. IDs may be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.operators.joins import same_key
from recordflow.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# A word of lower-cased text: digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# What lies between such words. Java matches a class of listed ASCII much faster than its complement.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words in text whose upper case is kept, and what lies between them.
CASED_PIECE = (
    r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
)
CASED_WORD = r"^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text; of a null, none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def keyed(docs: DataFrame, id_column: str, text_column: str, *others: str) -> DataFrame:
    """``_id, _print`` (a fingerprint of the text) and ``_text`` of every row, and `others`."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(
        F.col(id_column).alias("_id"),
        F.md5(text.cast("binary")).alias("_print"),
        text.alias("_text"),
        *others,
    )


def attach(docs: DataFrame, found: DataFrame, id_column: str, text_column: str, print_chars: int = 32) -> DataFrame:
    """`docs` with the columns of `found`, which has one row per ``_id, _print``.

    Rows without a match get nulls. Columns of `found` take the place of columns of the same name.
    `print_chars`: how much of the fingerprints `found` has.
    """
    new = [c for c in found.columns if c not in ("_id", "_print")]
    print_of = F.md5(F.coalesce(F.col(text_column), F.lit("")).cast("binary"))
    print_of = print_of if print_chars == 32 else F.substring(print_of, 1, print_chars)
    kept = [c for c in docs.columns if c not in new]
    left = docs.select(*kept, print_of.alias("_doc_print"))
    right = found.withColumnsRenamed({"_id": "_found_id", "_print": "_found_print"})
    on = same_key(left["_doc_print"], right["_found_print"]) & same_key(
        left[id_column], right["_found_id"]
    )
    return left.join(right, on, "left").select(*kept, *new)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df`, written to the shared folder and read again: its lineage ends there."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined_text(values: Column) -> Column:
    """Distinct values, as text, sorted and joined with commas."""
    return F.array_join(F.array_sort(F.array_distinct(values)), ",")


def without(columns: Sequence[str], *gone: str) -> list[str]:
    return [c for c in columns if c not in gone]


def bounded_sample(labels: DataFrame, id_column: str, rows: int) -> DataFrame:
    """About `rows` rows (a few standard deviations of that share more or less), the same each time.

    Which rows are taken depends on a hash of their ID only, so nothing is sorted or gathered.
    """
    there = labels.count()
    if there <= rows:
        return labels
    part = F.pmod(F.xxhash64(id_column, F.lit("sample")), F.lit(1 << 30))
    return labels.filter(part < int((1 << 30) * rows / there))
