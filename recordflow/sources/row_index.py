"""Hashes of the rows that a target holds, by key and in buckets, so that changes are found without reading it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from hashlib import md5

from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordflow.operators.dedup import cells_text, last_of
from recordflow.operators.joins import same_key
from recordflow.sources.journal import Journal, Output, Write


@dataclass(frozen=True)
class RowHashIndex:
    """The last hash of every key of a target whose rows have this `schema`.

    Each run adds the hashes of the rows it pushed, as a partition of a table clustered by key. The
    hashes of all runs in use are then merged and joined bucket by bucket: what comes in is shuffled,
    the index is not. `compact` puts the runs together; do so every few dozen runs, as each adds a file
    per bucket. Keys and cells are cast to `schema` before they are compared, nulls equal nulls.
    """

    journal: Journal
    name: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = 64

    @property
    def _whole(self) -> str:
        return f"{self.name}_whole"

    def _hashed(self, df: DataFrame) -> list[Column]:
        def cell(c: str) -> Column:
            return F.col(f"`{c}`").cast(self.schema[c].dataType)

        rest = sorted(c for c in self.schema.fieldNames() if c not in self.keys)
        return [cells_text([cell(k) for k in self.keys]).alias("_key"), F.md5(cells_text([cell(c) for c in rest])).alias("_hash")]

    def _runs(self) -> dict[str, int]:
        """The committed runs in use with their numbers: the last that holds all, and those after it."""
        lines = self.journal.lines().where(F.col("target").isin(self.name, self._whole))
        whole = lines.where(F.col("target") == self._whole).agg(F.max("number")).first()[0] or 0
        return {r.run: r.number for r in lines.where(F.col("number") >= whole).select("run", "number").distinct().collect()}

    def _table(self, runs: Sequence[str] = ()) -> str:
        """The table's name in this session; the files are the index, the name is made anew where it is unknown."""
        spark, path = self.journal.spark, f"{self.journal.base.rstrip('/')}/{self.name}"
        table = f"row_hashes_{md5(path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (_key STRING, _hash STRING, run STRING) "
            "USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
            f"PARTITIONED BY (run) CLUSTERED BY (_key) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        if runs:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION (run = '{run}')" for run in runs))
        return table

    def state(self) -> DataFrame:
        """``_key, _hash``: the last hash of each key, as of the last commit."""
        spark, runs = self.journal.spark, self._runs()
        rows = spark.table(self._table(sorted(runs)))
        number = F.create_map(*[F.lit(x) for item in sorted(runs.items()) for x in item])[F.col("run")] if runs else F.lit(0)
        return rows.where(F.col("run").isin(*runs) & F.col("_key").isNotNull()).groupBy("_key").agg(F.max_by("_hash", number).alias("_hash"))

    def changed(self, incoming: DataFrame) -> DataFrame:
        """Incoming rows that are new or differ from what the target holds for their key.

        `incoming` is read twice. Its keys and hashes are made distinct before they meet the index, so
        a key with a third of all rows is one row there, and the join that picks the rows can be split.
        A run that pushes these rows and updates the index reads them twice; see `push`.
        """
        hashed = incoming.select("*", *self._hashed(incoming))
        pairs = hashed.select("_key", "_hash").distinct()
        known = self.state().toDF("_known_key", "_known")
        new = pairs.join(known, F.col("_key") == F.col("_known_key"), "left").where("_known IS NULL OR _known <> _hash")
        new = new.select(F.col("_key").alias("_new_key"), F.col("_hash").alias("_new_hash"))
        same = same_key(F.col("_key"), F.col("_new_key")) & same_key(F.col("_hash"), F.col("_new_hash"))
        return hashed.join(new, same, "left_semi").drop("_key", "_hash")

    def update(self, pushed: DataFrame, order_by: Sequence[str] = ()) -> Write:
        """A write of the hashes of the rows a run pushes; it counts the keys.

        Of several rows with one key the last in order counts (without an order, the one with the
        largest hash).
        """
        order = [f"_o{i}" for i in range(len(order_by))]
        rows = pushed.select(*self._hashed(pushed), *[F.col(f"`{c}`").alias(o) for c, o in zip(order_by, order)])
        last = rows.groupBy("_key").agg(last_of("_hash", order).alias("_hash"))

        return self._write(lambda: last.repartition(self.buckets, "_key"))

    def push(self, target: Output, incoming: DataFrame, order_by: Sequence[str] = ()) -> dict[str, Write]:
        """The writes of a run that adds the changed rows of `incoming` to `target` and their hashes here.

        The changed rows are found once: their hashes are made from what the run wrote.
        """

        def hashes(run: str) -> int:
            return self.update(target.written(run, incoming.schema), order_by)(run)

        return {target.name: target.write(self.changed(incoming)), self.name: hashes}

    def _write(self, hashes: Callable[[], DataFrame]) -> Write:
        """A write of a run's partition, in place of what an attempt that died left there."""

        def write(run: str) -> int:
            spark, table = self.journal.spark, self._table()
            # The table may be read for what is written, so only partitions that get rows are replaced:
            # a row without a key sees to it that this one does.
            mark = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in ("_key", "_hash")])
            rows = hashes().unionByName(mark).withColumn("run", F.lit(run))
            rows.write.mode("overwrite").insertInto(table)
            return spark.table(self._table([run])).where((F.col("run") == run) & F.col("_key").isNotNull()).count()

        return write

    def compact(self, run: str, as_of: datetime | str) -> bool:
        """Put all runs in use together as one; False if the run is committed already."""
        return self.journal.run(run, {self._whole: self._write(self.state)}, as_of)
