"""Types of text cells, found while the cells are read for other ends.

Every cell has a kind, a bit; a column's kinds are the bits of its cells put together. That holds for
tasks, files and runs alike: kinds of parts give those of the whole, and a part counted twice changes
nothing. A column's type is the narrowest that holds all its kinds without losing a character that
matters; where none does, it stays text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

INT, LONG, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(7))
NUMBERS, TIMES = (INT, LONG, DOUBLE), (DATE, TIMESTAMP)
TYPES = {
    INT: T.IntegerType(), LONG: T.LongType(), DOUBLE: T.DoubleType(), DATE: T.DateType(),
    TIMESTAMP: T.TimestampType(), BOOLEAN: T.BooleanType(), TEXT: T.StringType(),
}

_WHOLE = r"^[+-]?[0-9]+$"
_DECIMAL = r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+(?=[eE]))([eE][+-]?[0-9]+)?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"


def cell_kind(cell: Column) -> Column:
    """The bit of one cell; null for a blank cell, which fits every type.

    A whole number beyond 64 bits is text, as a double would lose digits of it. So is a date that no
    calendar has.
    """

    def fits(pattern: str, kind: str) -> Column:
        return cell.rlike(pattern) & cell.try_cast(kind).isNotNull()

    return (
        F.when(F.coalesce(cell, F.lit("")) == "", F.lit(None).cast("int"))
        .when(fits(_WHOLE, "int"), INT)
        .when(fits(_WHOLE, "bigint"), LONG)
        .when(fits(_DECIMAL, "double"), DOUBLE)
        .when(fits(_DAY, "date"), DATE)
        .when(fits(_TIME, "timestamp"), TIMESTAMP)
        .when(F.lower(cell).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def kinds(columns: Sequence[str]) -> list[Column]:
    """Aggregates: the kinds of each column, under the column's place."""
    return [F.coalesce(F.bit_or(cell_kind(F.col(f"`{c}`"))), F.lit(0)).alias(f"k{i}") for i, c in enumerate(columns)]


def type_of(bits: int) -> T.DataType:
    """The type that holds all kinds; text where no cell was filled."""
    for chain in (NUMBERS, TIMES, (BOOLEAN,)):
        if bits and not bits & ~sum(chain):
            return TYPES[max(kind for kind in chain if bits & kind)]
    return TYPES[TEXT]


def schema_of(columns: Sequence[str], bits: Mapping[str, int], text_columns: Sequence[str] = ()) -> T.StructType:
    """A schema from the kinds of its columns; `text_columns` stay text whatever they hold."""
    return T.StructType([T.StructField(c, type_of(TEXT if c in text_columns else bits.get(c, 0))) for c in columns])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text cells as the types found for them; blank cells are null."""
    cells = [F.nullif(F.col(f"`{f.name}`"), F.lit("")).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(cells)
