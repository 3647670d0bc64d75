import pytest
from frame_rows import rows
from pyspark.sql import functions as F, types as T

from recordflow.operators import dedup
from recordflow.session import shared_dir
from recordflow.sources.journal import Journal
from recordflow.sources.row_index import RowHashIndex

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("record", "event", "a", "b")])
KEYS = ("record", "event")
AS_OF = "2024-01-01T00:00:00"


@pytest.fixture
def index(spark):
    return RowHashIndex(Journal(spark, shared_dir(spark, "index")), "hashes", SCHEMA, KEYS, 4)


def frame(spark, *data):
    return spark.createDataFrame(data, SCHEMA)


def push(index, run, df, order_by=()):
    return index.journal.run(run, {index.name: index.update(df, order_by)}, AS_OF)


def test_changes_against_the_last_state(spark, index):
    first = frame(spark, ("1", "e", "x", None), ("2", None, "x", "y"), (None, "e", "", "z"))
    assert rows(index.changed(first)) == rows(first)
    push(index, "r1", first)
    assert index.changed(first).isEmpty()
    second = frame(spark, ("1", "e", "x", ""), ("2", None, "x", "y"), (None, "e", None, "z"), ("1", None, "x", None))
    assert rows(index.changed(second)) == rows(dedup.changed_rows(second, first, KEYS))
    push(index, "r2", index.changed(second))
    assert index.changed(second).isEmpty()
    # What held before the second run is a change again.
    assert rows(index.changed(first)) == rows(dedup.changed_rows(first, second, KEYS))


def test_a_run_that_died_counts_for_nothing(spark, index):
    push(index, "r1", frame(spark, ("1", "e", "old", None)))
    update = index.update(frame(spark, ("1", "e", "new", None), ("9", "e", "new", None)))

    def died(run):
        raise RuntimeError(run)

    with pytest.raises(RuntimeError):
        index.journal.run("r2", {index.name: update, "other": died}, AS_OF)
    assert rows(index.changed(frame(spark, ("1", "e", "old", None), ("9", "e", "new", None)))) == [("9", "e", "new", None)]
    # Repeated with other rows, nothing of the first attempt is left.
    push(index, "r2", frame(spark, ("1", "e", "newer", None)))
    left = index.changed(frame(spark, ("1", "e", "newer", None), ("9", "e", "new", None)))
    assert rows(left) == [("9", "e", "new", None)]
    assert not push(index, "r2", frame(spark, ("1", "e", "again", None)))


def test_compaction_changes_nothing(spark, index):
    for n in range(3):
        push(index, f"r{n}", frame(spark, ("1", "e", f"v{n}", None), (f"only{n}", "e", "x", None)))
    before = rows(index.state())
    assert index.compact("c1", AS_OF) and not index.compact("c1", AS_OF)
    assert rows(index.state()) == before and len(before) == 4
    assert set(index._runs()) == {"c1"}
    push(index, "r9", frame(spark, ("1", "e", "v9", None)))
    assert set(index._runs()) == {"c1", "r9"}
    assert rows(index.changed(frame(spark, ("1", "e", "v2", None), ("1", "e", "v9", None))), "a") == [("v2",)]


def test_last_row_of_a_key_in_order(spark, index):
    both = frame(spark, ("1", "e", "a", "1"), ("1", "e", "a", "2"))
    push(index, "r1", both, ["b"])
    assert rows(index.changed(both), "b") == [("1",)]


def test_casts_and_extra_columns(spark, index):
    push(index, "r1", frame(spark, ("1", "e", "2", None)))
    other = spark.sql("SELECT 1 AS record, 'e' AS event, 2L AS a, CAST(NULL AS INT) AS b, 'more' AS _known")
    assert index.changed(other).columns == other.columns
    assert index.changed(other).isEmpty()


def test_empty(spark, index):
    none = frame(spark)
    assert index.changed(none).isEmpty()
    push(index, "r1", none)
    index.compact("c1", AS_OF)
    one = frame(spark, ("1", "e", "x", None))
    assert rows(index.changed(one)) == rows(one)


def test_another_session_finds_the_index(spark, index):
    push(index, "r1", frame(spark, ("1", "e", "x", None)))
    spark.sql(f"DROP TABLE {index._table()}")
    assert index.changed(frame(spark, ("1", "e", "x", None))).isEmpty()


def test_the_index_is_not_shuffled(spark, index):
    push(index, "r1", frame(spark, *[(str(i), "e", "x", None) for i in range(50)]))
    push(index, "r2", frame(spark, *[(str(i), "e", "y", None) for i in range(25, 75)]))
    incoming = frame(spark, *[(str(i), "e", "y", None) for i in range(100)])
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        out = index.changed(incoming)
        assert out.count() == 50
        plan = out._jdf.queryExecution().sparkPlan().toString()
        physical = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in names:
            spark.conf.unset(name)
    assert "Bucketed: true" in physical and "row_hashes_" in plan
    # Walk from the scan of the index to its join: no exchange in between.
    lines = physical.splitlines()
    scans = [i for i, line in enumerate(lines) if "Bucketed: true" in line]
    assert scans
    for at in scans:
        depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
        for line in reversed(lines[:at]):
            here = len(line) - len(line.lstrip(" :+-"))
            if here < depth:
                depth = here
                assert "Exchange" not in line
                if "SortMergeJoin" in line:
                    break
