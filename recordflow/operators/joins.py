"""Join conditions that let Spark split hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def same_key(left: Column, right: Column) -> Column:
    """Equality of a key with that of a side grouped by it.

    Adaptive execution splits a hot key only in a join that both sides enter straight from an
    exchange. A side grouped by the join key would enter without one, since it is partitioned
    that way already. Null-safe equality hashes differently, so that side, which grouping has
    made small, is exchanged once more and the join can be split.
    """
    return left.eqNullSafe(right)


def only_keys(df: DataFrame, column: Column, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose key is among the one-column `keys` (``left_anti``: is not); nulls match nothing."""
    known = keys.toDF("_only").dropna().distinct()
    return df.join(known, same_key(column, F.col("_only")), how)
