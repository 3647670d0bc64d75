"""Scans: delimited, JSON, directory, dictionary; record exports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from recordflow.operators.joins import only_keys
from recordflow.operators.reshape import wide_to_eav
from recordflow.operators.select import _name
from recordflow.schemas import FIELD, RECORD, VALUE
from recordflow.session import shared_dir
from recordflow.sources import cell_types

# Fixed value: identifier columns that must keep their leading zeros.
ID_COLUMNS = ("customId", "mrn")


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, infer: bool = False
) -> DataFrame:
    """Read CSV files with a header, by a schema or as text.

    `infer` reads the files once more to find the types; it is for small or unknown files.
    """
    reader = spark.read.option("header", True)
    paths = path if isinstance(path, str) else list(path)
    return reader.schema(schema).csv(paths) if schema else reader.option("inferSchema", infer).csv(paths)


def read_csv_pinned(
    spark: SparkSession, path: str, text_columns: Sequence[str] = ID_COLUMNS
) -> DataFrame:
    """Read CSV files with the types their cells allow, except identifier columns, which stay text.

    The files are parsed once: their text cells are written to the shared folder, and the kinds of the
    cells (`cell_types`) are gathered by the tasks that write them. A column without a filled cell is
    text. The frame reads what was written. `CsvFolder` keeps the types of a folder that grows.
    """
    text = read_csv(spark, path)
    names, parsed = text.columns, shared_dir(spark, "cells")
    if not names:
        return text
    # Columns are written by place, as a header may hold names that Parquet or another column clashes with.
    cells = text.toDF(*[f"c{i}" for i in range(len(names))])
    seen = Observation("kinds")
    cells.observe(seen, *cell_types.kinds(cells.columns)).write.parquet(parsed)
    bits = {f"c{i}": seen.get[f"k{i}"] for i in range(len(names))}
    pinned = [c for c, name in zip(cells.columns, names) if name in text_columns]
    schema = cell_types.schema_of(cells.columns, bits, pinned)
    return cell_types.typed(spark.read.schema(cells.schema).parquet(parsed), schema).toDF(*names)


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read JSON responses and unwrap the array under ``result``."""
    wrapped = spark.read.schema(f"result array<struct<{schema}>>").json(path)
    return wrapped.select(F.inline("result"))


def read_instruments(
    spark: SparkSession, path: str, schema: T.StructType | str, instruments: DataFrame
) -> DataFrame:
    """Read a folder of ``<instrument>.csv`` files, only those of known instruments.

    `instruments` has the column ``instrument_name``, case ignored, a few rows as in a dictionary;
    ``instrument`` is added to the rows. Files of other names are not opened.
    """
    known = {r[0] for r in instruments.select(F.lower("instrument_name")).distinct().collect()}
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    paths = [f.getPath() for f in files if f.getPath().getName().endswith(".csv")]
    wanted = [p.toString() for p in paths if p.getName().removesuffix(".csv").lower() in known]
    if not wanted:
        return spark.createDataFrame([], schema).withColumn("instrument", F.lit(None).cast("string"))
    name = F.regexp_replace("_metadata.file_name", r"\.csv$", "").alias("instrument")
    return read_csv(spark, wanted, schema).select("*", name)


def export_flat(
    df: DataFrame,
    fields: Sequence[str],
    where: Column | None = None,
    match: str = "all",
    keys: Sequence[str] = ("record_id",),
) -> DataFrame:
    """Choose fields and rows of a wide table; ``match="any"`` asks for a non-blank field."""
    present = [c for c in fields if c in df.columns and c not in keys]
    if match == "any" and present:
        filled = [F.coalesce(_name(c).cast("string"), F.lit("")) != "" for c in present]
        any_filled = reduce(Column.__or__, filled)
        where = any_filled if where is None else where & any_filled
    rows = df if where is None else df.where(where)
    return rows.select(*[_name(k) for k in keys], *[_name(c) for c in present])


def export_eav(
    eav: DataFrame, fields: Sequence[str], match: str = "all", records: DataFrame | None = None
) -> DataFrame:
    """Choose fields (and records) of a long table.

    ``match="any"`` keeps records where one of the fields is not blank.
    """
    rows = eav.where(F.col(FIELD).isin(*fields))
    if match == "any":
        filled = rows.where(F.coalesce(VALUE, F.lit("")) != "").select(RECORD)
        rows = only_keys(rows, F.col(RECORD), filled)
    return rows if records is None else only_keys(rows, F.col(RECORD), records.select(RECORD))


def flat_to_long_export(df: DataFrame, fields: Sequence[str], key: str = "record_id") -> DataFrame:
    """Long layout of a wide export."""
    return wide_to_eav(export_flat(df, fields, keys=(key,)), [key]).withColumnRenamed(key, RECORD)


def tolerant_select(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The wanted columns the frame has, and the names it lacks."""
    return df.select([_name(c) for c in wanted if c in df.columns]), [
        c for c in wanted if c not in df.columns
    ]


def union_exports(*exports: DataFrame) -> DataFrame:
    """Stack exports of several studies; columns one study lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), exports)


def dictionary_of(
    dictionary: DataFrame, forms: Sequence[str] | None = None, fields: Sequence[str] | None = None
) -> DataFrame:
    """Dictionary rows of some forms or fields; all rows if neither is given."""
    if forms:
        dictionary = dictionary.where(F.col("form_name").isin(*forms))
    if fields:
        dictionary = dictionary.where(F.col(FIELD).isin(*fields))
    return dictionary


def preview(df: DataFrame, rows: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """A few rows of a table, the first in order if one is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
