"""Projections, filters, predicates and renames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.operators.joins import only_keys
from recordflow.schemas import FIELD, RECORD, VALUE
from recordflow.session import literal_table


def _name(name: str) -> Column:
    return F.col(f"`{name}`")


# ---------------------------------------------------------------- field names (long layout)


def rename_fields(eav: DataFrame, names: Mapping[str, str] | DataFrame) -> DataFrame:
    """Rename field names; names without an entry are kept.

    A DataFrame of names has columns ``old, new``, one row per ``old``.
    """
    if not isinstance(names, DataFrame):
        names = literal_table(eav.sparkSession, ["old", "new"], names.items())
    joined = eav.join(names, eav[FIELD] == names["old"], "left")
    return joined.withColumn(FIELD, F.coalesce("new", FIELD)).drop("old", "new")


def fan_out_fields(eav: DataFrame, copies: Mapping[str, Sequence[str]] | DataFrame) -> DataFrame:
    """Copy a field under several names: one output row per ``(old, new)`` pair."""
    if not isinstance(copies, DataFrame):
        pairs = [(old, new) for old, many in copies.items() for new in many]
        copies = literal_table(eav.sparkSession, ["old", "new"], pairs)
    return rename_fields(eav, copies)


def keep_prefixes(eav: DataFrame, prefixes: Iterable[str]) -> DataFrame:
    """Keep rows whose field name starts with any prefix."""
    shortest: list[str] = []
    for prefix in sorted(set(prefixes)):
        if not shortest or not prefix.startswith(shortest[-1]):
            shortest.append(prefix)
    if not shortest:
        return eav.where(F.lit(False))
    return eav.where(reduce(Column.__or__, [F.col(FIELD).startswith(p) for p in shortest]))


def keep_fields(eav: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Keep rows of exactly these fields."""
    return eav.where(F.col(FIELD).isin(*fields))


def fields_with_suffix(fields: DataFrame, suffix: str, strip: bool = False) -> DataFrame:
    """Distinct field names with a suffix, optionally without it."""
    column = F.col(FIELD)
    if strip:
        column = F.substring(column, F.lit(1), F.length(FIELD) - len(suffix))
    return fields.where(F.col(FIELD).endswith(suffix)).select(column.alias(FIELD)).distinct()


# ---------------------------------------------------------------- code lists and predicates


@dataclass(frozen=True)
class CodeList:
    """Label-to-code list of one field."""

    field: str
    codes: Mapping[str, str]

    def __getitem__(self, label: str) -> str:
        return self.codes[label]

    def encode(self, label: Column) -> Column:
        """Codes of a label column; unknown labels give null."""
        return self._lookup(label, self.codes.items())

    def decode(self, code: Column) -> Column:
        """Labels of a code column; unknown codes give null."""
        return self._lookup(code, ((c, label) for label, c in self.codes.items()))

    @staticmethod
    def _lookup(key: Column, pairs: Iterable[tuple[str, str]]) -> Column:
        literals = [F.lit(part) for pair in pairs for part in pair]
        return F.try_element_at(F.create_map(*literals), key)

    def matches(self, label: str) -> Column:
        """Wide layout: the field holds the code of `label`."""
        return _name(self.field) == F.lit(self.codes[label])


def flagged_records(eav: DataFrame, code_list: CodeList, label: str) -> DataFrame:
    """All rows of the records whose code-list field holds the code of `label`."""
    flagged = eav.where((F.col(FIELD) == code_list.field) & (F.col(VALUE) == code_list[label]))
    return only_keys(eav, F.col(RECORD), flagged.select(RECORD))


@dataclass(frozen=True)
class Range:
    """Numeric range; each side may include its bound."""

    minimum: float
    maximum: float
    left_inclusive: bool = True
    right_inclusive: bool = True

    def contains(self, value: Column) -> Column:
        lower = value >= self.minimum if self.left_inclusive else value > self.minimum
        upper = value <= self.maximum if self.right_inclusive else value < self.maximum
        return lower & upper

    def __str__(self) -> str:
        left = "[" if self.left_inclusive else "("
        right = "]" if self.right_inclusive else ")"
        return f"{left}{self.minimum}, {self.maximum}{right}"


def has_status(df: DataFrame, column: str, status: str) -> DataFrame:
    """Rows with a literal status."""
    return df.where(_name(column) == status)


def drop_parent_ids(
    df: DataFrame,
    instrument: str,
    id_columns: Sequence[str] = ("target_user_secret_id", "record_id"),
    suffix: str = "_P",
    exempt_prefix: str | None = None,
) -> DataFrame:
    """Drop rows whose ID ends in `suffix`; the first ID column present is looked at."""
    id_column = first_present(df, id_columns)
    if id_column is None or (exempt_prefix and instrument.startswith(exempt_prefix)):
        return df
    return df.where(~F.coalesce(_name(id_column).cast("string").endswith(suffix), F.lit(False)))


# ---------------------------------------------------------------- columns (wide layout)


def first_present(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """Name of the first candidate column the frame has."""
    return next((c for c in candidates if c in df.columns), None)


def column_or(df: DataFrame, candidates: Sequence[str], fallback: Column) -> Column:
    """The first candidate column, or `fallback` where the frame has none."""
    found = first_present(df, candidates)
    return fallback if found is None else _name(found)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename those columns that are present."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def drop_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop those columns that are present."""
    return df.drop(*columns)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop columns without any value (one aggregate over the frame decides)."""
    counts = df.agg(*[F.count(_name(c)).alias(c) for c in df.columns]).first()
    return df.select([_name(c) for c, n in zip(df.columns, counts) if n])


def drop_nulls(df: DataFrame, how: str = "any", subset: list[str] | None = None) -> DataFrame:
    """Drop rows where any (or all) of the columns are null."""
    return df.dropna(how=how, subset=subset)


def with_defaults(df: DataFrame, defaults: Mapping[str, str | None]) -> DataFrame:
    """Add the columns the frame lacks, filled with their default."""
    absent = {c: F.lit(d).cast("string") for c, d in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def strip_infix(df: DataFrame, prefix: str, infix: str) -> DataFrame:
    """Rename ``<prefix><infix>x`` to ``<prefix>x``, except ``…_complete`` columns."""
    long = prefix + infix
    return rename_columns(
        df,
        {
            c: prefix + c[len(long):]
            for c in df.columns
            if c.startswith(long) and not c.endswith("_complete")
        },
    )


def add_suffix(df: DataFrame, prefix: str, suffix: str) -> DataFrame:
    """Append a suffix to the ``<prefix>…`` columns, except ``…_complete`` ones."""
    return rename_columns(
        df,
        {
            c: c + suffix
            for c in df.columns
            if c.startswith(prefix) and not c.endswith("_complete")
        },
    )


def target_of(instrument: Column, prefixes: Sequence[str], matched: str, other: str) -> Column:
    """Target chosen by the (lower-cased, marker-free) start of an instrument name."""
    name = F.lower(F.replace(instrument, F.lit("_redcap"), F.lit("")))
    hit = reduce(Column.__or__, [name.startswith(p) for p in prefixes])
    return F.when(hit, matched).otherwise(other)


def expand_variants(df: DataFrame, column: str, variants: Sequence[str]) -> DataFrame:
    """One copy of every row per variant, the variant in `column`; the input is read once."""
    others = [c for c in df.columns if c != column]
    return df.select(*[_name(c) for c in others], F.explode(F.array(*map(F.lit, variants))).alias(column))
