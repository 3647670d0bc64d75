"""Runs that count as a whole: a journal of commits, outputs by run, and tables kept in buckets.

A run writes every target under its own ID; readers take the targets of committed runs only, and
one line in the journal commits them all. A run that died anywhere before that line is repeated
under the same ID: it overwrites what it left, from the state of the last commit. A run that is
committed does nothing when it is repeated. One writer works on a journal at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recordflow.functions.dates import as_timestamp
from recordflow.operators.upsert import eav_upsert, flat_upsert

JOURNAL_SCHEMA = "number long, run string, target string, row_count long, committed_at timestamp"
BUCKET = "_bucket"
Write = Callable[[str], int]
Merge = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Journal:
    """The commits of the runs of one folder."""

    spark: SparkSession
    base: str

    @property
    def path(self) -> str:
        return f"{self.base.rstrip('/')}/journal"

    def lines(self) -> DataFrame:
        """One line per target of each committed run; `number` counts the runs."""
        try:
            return self.spark.read.schema(JOURNAL_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], JOURNAL_SCHEMA)

    def committed(self, run: str) -> bool:
        return not self.lines().where(F.col("run") == run).isEmpty()

    def runs(self, target: str) -> list[str]:
        """Committed runs of a target, in order: as many as there were commits."""
        mine = self.lines().where(F.col("target") == target).select("number", "run").distinct()
        return [r.run for r in mine.orderBy("number").collect()]

    def commit(self, run: str, row_counts: Mapping[str, int], as_of: datetime | str) -> None:
        """Write the run's lines, as one file: all of them are there or none."""
        last = self.lines().agg(F.coalesce(F.max("number"), F.lit(0)).alias("n")).first().n
        lines = self.spark.createDataFrame([(last + 1, run, t, n) for t, n in row_counts.items()], "number long, run string, target string, row_count long")
        lines.withColumn("committed_at", as_timestamp(as_of)).coalesce(1).write.mode("append").parquet(self.path)

    def run(self, run: str, writes: Mapping[str, Write], as_of: datetime | str) -> bool:
        """Write all targets and commit; False, and nothing done, if the run is committed."""
        if self.committed(run):
            return False
        self.commit(run, {name: write(run) for name, write in writes.items()}, as_of)
        return True


@dataclass(frozen=True)
class Output:
    """A target that gets rows added by each run, in a folder per run."""

    journal: Journal
    name: str

    def _path(self, run: str) -> str:
        return f"{self.journal.base.rstrip('/')}/{self.name}/run={run}"

    def write(self, rows: DataFrame) -> Write:
        def write(run: str) -> int:
            rows.write.mode("overwrite").parquet(self._path(run))
            return self.written(run, rows.schema).count()

        return write

    def written(self, run: str, schema: T.StructType | str) -> DataFrame:
        """Rows that a run wrote, committed or not."""
        return self.journal.spark.read.schema(schema).parquet(self._path(run))

    def read(self, schema: T.StructType | str) -> DataFrame:
        """Rows of the committed runs."""
        paths = [self._path(run) for run in self.journal.runs(self.name)]
        spark = self.journal.spark
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


@dataclass(frozen=True, eq=False)
class BucketedTable:
    """An upsert target in buckets by the hash of its key.

    A push reads and rewrites only the buckets of the keys it brings; all other files stay as they
    are. A manifest per run says which run holds the files of each bucket, so a push costs what it
    touches and one row per bucket. Choose as many buckets that one is a few files.
    """

    journal: Journal
    name: str
    schema: T.StructType
    keys: Sequence[str]
    merge: Merge
    buckets: int = 64

    @classmethod
    def long(cls, journal: Journal, name: str, schema: T.StructType, keys: Sequence[str] = ("record", "redcap_event_name", "field_name"), buckets: int = 64) -> BucketedTable:
        """A long target: a key's rows are replaced by those pushed."""
        keys = [k for k in keys if k in schema.fieldNames()]
        return cls(journal, name, schema, keys, partial(_long, keys), buckets)

    @classmethod
    def flat(cls, journal: Journal, name: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64) -> BucketedTable:
        """A wide target with one row per key: cells are overwritten unless blank, a blank key is null."""
        return cls(journal, name, schema, keys, partial(_flat, list(keys)), buckets)

    @property
    def _base(self) -> str:
        return f"{self.journal.base.rstrip('/')}/{self.name}"

    def bucketed(self, rows: DataFrame) -> DataFrame:
        key = [F.coalesce(F.col(f"`{k}`").cast(self.schema[k].dataType).cast("string"), F.lit("")) for k in self.keys]
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int"))

    def manifest(self) -> dict[int, str]:
        """The run that holds each bucket: one entry per bucket at most."""
        runs = self.journal.runs(self.name)
        if not runs:
            return {}
        rows = self.journal.spark.read.schema("bucket int, run string").parquet(f"{self._base}/manifest/run={runs[-1]}")
        return {r.bucket: r.run for r in rows.collect()}

    def read(self, only: set[int] | None = None) -> DataFrame:
        """The table as of the last commit, or some buckets of it."""
        spark = self.journal.spark
        paths = [f"{self._base}/rows/run={run}/{BUCKET}={b}" for b, run in sorted(self.manifest().items()) if only is None or b in only]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def push(self, source: DataFrame) -> Write:
        """A write that merges `source` and counts its rows."""

        def write(run: str) -> int:
            spark = self.journal.spark
            path, manifest = f"{self._base}/rows/run={run}", self.manifest()
            # Read twice (for its buckets and its rows), so it is computed once.
            given = f"{self._base}/pushed/run={run}"
            source.write.mode("overwrite").parquet(given)
            rows = spark.read.schema(source.schema).parquet(given)
            touched = {r[0] for r in self.bucketed(rows).select(BUCKET).distinct().collect()}
            merged = self.merge(self.read(touched), rows)
            cells = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields]
            # Large buckets are split, small ones put together.
            dealt = self.bucketed(merged.select(cells)).hint("rebalance", BUCKET)
            dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(path)
            # The files say which buckets hold rows; to ask the merge would compute it once more.
            written = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
            filled = [r[0] for r in spark.read.schema(written).parquet(path).select(BUCKET).distinct().collect()]
            now = {b: r for b, r in manifest.items() if b not in touched} | dict.fromkeys(filled, run)
            spark.createDataFrame(sorted(now.items()), "bucket int, run string").coalesce(1).write.mode("overwrite").parquet(f"{self._base}/manifest/run={run}")
            return rows.count()

        return write


def _long(keys: Sequence[str], target: DataFrame, source: DataFrame) -> DataFrame:
    return eav_upsert(target, source, keys)


def _flat(keys: Sequence[str], target: DataFrame, source: DataFrame) -> DataFrame:
    # Keys are compared as the target will hold them, so it never has two rows of one key.
    texts = {f.name for f in source.schema.fields if isinstance(f.dataType, T.StringType)}
    filled = {k: F.nullif(F.col(f"`{k}`"), F.lit("")) if k in texts else F.col(f"`{k}`") for k in keys}
    held = {k: cell.cast(target.schema[k].dataType) for k, cell in filled.items()}
    return flat_upsert(target, source.withColumns(held), keys, single=True)
