"""Content hash of a growing folder: sums are kept per file, so each file is read once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from recordflow.operators.dedup import hash_sums, merged_hash
from recordflow.sources.journal import Journal, Output, Write

FILE = ["file", "size", "modified"]


@dataclass(frozen=True)
class FolderHash:
    """The content hash (per group) of the Parquet files under a folder.

    A file is known by its name, size and time of change. A changed file is read again, and one
    that is gone counts no more.
    """

    journal: Journal
    name: str
    path: str
    schema: T.StructType
    by: Sequence[str] = ()

    def files(self) -> DataFrame:
        """The files there are now; they are listed, not read."""
        listed = self.journal.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        found = F.col("_metadata")
        return listed.load(self.path).select(
            "path", found["file_path"].alias("file"), found["file_size"].alias("size"), found["file_modification_time"].alias("modified")
        )

    def _sums(self) -> DataFrame:
        groups = [self.schema[c] for c in self.by]
        kinds = [("file", "string"), ("size", "long"), ("modified", "timestamp"), ("row_count", "long"), ("row_sum", "decimal(38,0)")]
        fields = [T.StructField(n, T.DataType.fromDDL(kind)) for n, kind in kinds]
        return Output(self.journal, self.name).read(T.StructType([*groups, *fields]))

    def update(self) -> Write:
        """A write of the sums of the files that are new since the last committed run; it counts them."""

        def write(run: str) -> int:
            spark = self.journal.spark
            new = self.files().join(self._sums().select(*FILE).distinct(), FILE, "left_anti")
            # As many as files landed since; Spark's own listing holds all names on the driver.
            landed = new.collect()
            # The listing as it was when the paths were taken.
            files = spark.createDataFrame(landed, new.schema).drop("path")
            rows = spark.read.schema(self.schema).option("basePath", self.path).parquet(*[f.path for f in landed]) if landed else None
            if rows is None:
                Output(self.journal, self.name).write(self._sums().limit(0))(run)
                return 0
            sums = hash_sums(rows.select("*", F.col("_metadata.file_path").alias("file")), self.by, ["file"])
            # A file without rows keeps a line, so that it isn't read again.
            kept = files.join(sums, "file", "left").fillna(0, ["row_count"]).select(*self.by, *FILE, "row_count", F.col("row_sum").cast("decimal(38,0)").alias("row_sum"))
            Output(self.journal, self.name).write(kept)(run)
            return len(landed)

        return write

    def run(self, run: str, as_of: datetime | str) -> bool:
        """Take in what is new, as a run of the journal."""
        return self.journal.run(run, {self.name: self.update()}, as_of)

    def read(self) -> DataFrame:
        """``row_count, content_hash`` (per group) of the files there are, as of the last committed run."""
        return merged_hash(self._sums().join(self.files().select(*FILE), FILE, "left_semi"), self.by)
