"""A growing folder of CSV files whose column types are kept, so that each file is parsed once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from recordflow.sources import cell_types
from recordflow.sources.folder_hash import FILE
from recordflow.sources.journal import Journal, Output, Write

KINDS_SCHEMA = "file string, size long, modified timestamp, place int, kinds int"


@dataclass(frozen=True)
class CsvFolder:
    """The rows of the CSV files under a folder, with the types that all their cells allow.

    New files are parsed as text and written as Parquet once, with a short line of kinds per file and
    column. The schema comes from those lines alone, so it follows files that land, change (by size or
    time of change) or go, and a column widens without any file being parsed again. All files have the
    header `columns`; one with another header is an error. `text_columns` stay text.
    """

    journal: Journal
    name: str
    path: str
    columns: Sequence[str]
    text_columns: Sequence[str] = ()

    @property
    def _cells(self) -> Output:
        return Output(self.journal, f"{self.name}_cells")

    @property
    def _kinds(self) -> Output:
        return Output(self.journal, f"{self.name}_kinds")

    def _text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def _cell_schema(self) -> T.StructType:
        found = [T.StructField(n, T.DataType.fromDDL(kind)) for n, kind in (("_file", "string"), ("_size", "long"), ("_modified", "timestamp"))]
        return T.StructType([*self._text_schema().fields, *found])

    def files(self) -> DataFrame:
        """The files there are now; they are listed, not read."""
        listed = self.journal.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
        found = F.col("_metadata")
        return listed.load(self.path).select(
            "path", found["file_path"].alias("file"), found["file_size"].alias("size"), found["file_modification_time"].alias("modified")
        )

    def run(self, run: str, as_of: datetime | str) -> bool:
        """Take in the files that are new since the last committed run, as a run of the journal."""
        if self.journal.committed(run):
            return False
        spark = self.journal.spark
        # As many as files landed since; Spark's own listing holds all names on the driver.
        known = self._kinds.read(KINDS_SCHEMA).select(*FILE).distinct()
        landed = self.files().join(known, FILE, "left_anti").collect()
        found = F.col("_metadata")
        cells = spark.createDataFrame([], self._cell_schema())
        if landed:
            text = spark.read.option("header", True).option("enforceSchema", False).schema(self._text_schema())
            cells = text.csv([f.path for f in landed]).select(
                *[F.col(f"`{c}`") for c in self.columns],
                found["file_path"].alias("_file"), found["file_size"].alias("_size"), found["file_modification_time"].alias("_modified"),
            )
        writes: dict[str, Write] = {self._cells.name: self._cells.write(cells), self._kinds.name: self._write_kinds(landed)}
        return self.journal.run(run, writes, as_of)

    def _write_kinds(self, landed: Sequence) -> Write:
        def write(run: str) -> int:
            spark = self.journal.spark
            cells = spark.read.schema(self._cell_schema()).parquet(self._cells._path(run))
            found = cells.groupBy("_file", "_size", "_modified").agg(*cell_types.kinds(self.columns))
            by_place = F.posexplode(F.array(*[F.col(f"k{i}") for i in range(len(self.columns))])).alias("place", "kinds")
            lines = found.toDF(*FILE, *found.columns[3:]).select(*FILE, by_place)
            # A file without rows keeps a line too, so that it isn't parsed again.
            files = spark.createDataFrame([(f.file, f.size, f.modified) for f in landed], "file string, size long, modified timestamp")
            kept = files.join(lines, FILE, "left").fillna(0, ["place", "kinds"])
            return self._kinds.write(kept)(run)

        return write

    def _present(self) -> DataFrame:
        return self.files().select(*FILE)

    def schema(self) -> T.StructType:
        """The schema of the files there are, as of the last committed run; one row per column is read."""
        lines = self._kinds.read(KINDS_SCHEMA).join(self._present(), FILE, "left_semi")
        bits = {self.columns[r.place]: r.kinds for r in lines.groupBy("place").agg(F.bit_or("kinds").alias("kinds")).collect()}
        return cell_types.schema_of(self.columns, bits, self.text_columns)

    def read(self) -> DataFrame:
        """The typed rows of the files there are, as of the last committed run."""
        present = self._present().toDF("_file", "_size", "_modified")
        rows = self._cells.read(self._cell_schema()).join(present, ["_file", "_size", "_modified"], "left_semi")
        return cell_types.typed(rows, self.schema())
