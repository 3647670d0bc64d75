from pathlib import Path

import pytest
from frame_rows import rows
from pyspark.sql import functions as F, types as T

from recordflow.operators.dedup import table_hash
from recordflow.session import shared_dir
from recordflow.sources.folder_hash import FolderHash
from recordflow.sources.journal import Journal

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])


@pytest.mark.parametrize("by", [(), ("k",)])
def test_each_file_is_read_once(spark, by):
    path = shared_dir(spark, "landed")
    state = FolderHash(Journal(spark, shared_dir(spark, "hashes")), "sums", path, SCHEMA, by)

    def land(*data):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)

    def taken():
        lines = state.journal.lines().orderBy("number").select("row_count").collect()
        return [r.row_count for r in lines]

    land(("a", 1), ("b", None), (None, 3))
    assert state.run("r1", "2024-01-01T00:00:00")
    first = {p.name for p in Path(path.removeprefix("file:")).glob("*.parquet")}
    land(("a", 1), ("a", 2))
    land()
    state.run("r2", "2024-01-01T00:01:00")
    state.run("r3", "2024-01-01T00:02:00")
    assert taken() == [1, 2, 0]
    assert rows(state.read()) == rows(table_hash(spark.read.parquet(path), by))
    # A file that is gone counts no more, one that is written anew is read again.
    (name,) = first
    Path(path.removeprefix("file:"), name).unlink()
    assert rows(state.read()) == rows(table_hash(spark.read.schema(SCHEMA).parquet(path).where(F.col("k") == "a"), by))
    assert not state.run("r3", "2024-01-01T00:03:00")
