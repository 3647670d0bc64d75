"""What a run uses several times is computed once."""

import pytest
from frame_rows import rows
from pyspark.sql import functions as F, types as T

from catalog import base, finishing
from recordflow.operators import dedup
from recordflow.plans import fixed_values as fixed, intake
from recordflow.session import shared_dir
from recordflow.sources.journal import BucketedTable, Journal, Output
from recordflow.sources.row_index import RowHashIndex

LONG = T.StructType([T.StructField(c, T.StringType()) for c in finishing.EAV])
AS_OF = "2024-01-01T00:00:00"


@pytest.fixture
def counted(spark):
    """Let a frame's rows pass and count how often they are computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(df):
        def passed(value):
            seen.add(1)
            return True

        return df.where(F.udf(passed, "boolean").asNondeterministic()(df.columns[0]))

    return count, seen


def test_a_push_merges_once(spark, counted):
    count, seen = counted
    rows_ = spark.createDataFrame([("1", "e", "f", "x"), ("2", "e", "f", "y")], LONG)
    journal = Journal(spark, shared_dir(spark, "once"))
    table = BucketedTable(journal, "facts", LONG, ["record"], lambda target, source: count(target.unionByName(source)), 2)
    journal.run("r1", {"facts": table.push(rows_)}, AS_OF)
    assert rows(table.read(), "record") == [("1",), ("2",)]
    assert seen.value == 2


def test_a_push_without_rows_holds_no_bucket(spark):
    journal = Journal(spark, shared_dir(spark, "once"))
    table = BucketedTable.long(journal, "facts", LONG, buckets=2)
    journal.run("r1", {"facts": table.push(spark.createDataFrame([("1", "e", "f", "")], LONG))}, AS_OF)
    assert table.manifest() == {} and table.read().isEmpty()


def test_a_flat_target_has_one_row_per_key(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    journal = Journal(spark, shared_dir(spark, "once"))
    table = BucketedTable.flat(journal, "people", schema, ["id"], 2)
    texts = spark.createDataFrame([("01", "x", "y"), ("1", "x", "z"), (None, "n", None)], "id string, a string, b string")
    journal.run("r1", {"people": table.push(texts)}, AS_OF)
    assert rows(table.read()) == [(1, "x", "z"), (None, "n", None)]
    journal.run("r2", {"people": table.push(spark.createDataFrame([(None, "m", "k"), ("001", "", "q")], texts.schema))}, AS_OF)
    assert rows(table.read()) == [(1, "x", "q"), (None, "m", "k")]


def test_a_finished_job_computes_its_rows_once(spark, counted, monkeypatch):
    count, seen = counted
    data = spark.createDataFrame([(str(i), "e", "f", "x") for i in range(10)], LONG)
    monkeypatch.setitem(base.ENTRIES, "counted", base.Entry(lambda spark, sf: count(data), None))
    out = finishing._finished(spark, "", {"counted": finishing.EAV}, {})
    assert out.where("target = 'counted'").count() == 10
    assert seen.value == 10


def test_a_run_finds_changed_rows_once(spark, counted):
    count, seen = counted
    journal = Journal(spark, shared_dir(spark, "once"))
    index, pushed = RowHashIndex(journal, "hashes", LONG, ["record"], 2), Output(journal, "pushed")
    data = spark.createDataFrame([(str(i), "e", "f", "x") for i in range(10)], LONG)
    assert journal.run("r1", index.push(pushed, count(data)), AS_OF)
    # Once for the hashes and once to pick the rows.
    assert seen.value == 20
    assert pushed.read(LONG).count() == 10 and index.changed(data).isEmpty()


def test_intake_reads_its_table_for_facts_and_rows_only(spark, tmp_path):
    fields = {"mrn": "7", "dob": "2001-01-01", fixed.INTAKE_READY.field: fixed.INTAKE_READY["Ready to Send"]}
    data = [("1", "e", None, None, f, v) for f, v in fields.items()]
    schema = "record string, redcap_event_name string, redcap_repeat_instrument string, redcap_repeat_instance int, field_name string, value string"
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/eav")
    out = intake.format_records(spark.read.parquet(f"{tmp_path}/eav"), intake.standard_rules("2024-06-15"), ready=fixed.INTAKE_READY, order_by=["value"])
    assert ("7", "dob") in rows(out, "record", "field_name")
    assert out.inputFiles() and not [f for f in out.inputFiles() if f"{tmp_path}/eav" in f]


def test_last_value_in_its_own_order_is_the_largest():
    assert "max_by" not in str(dedup.last_of("value", ["value", "event"]))
    assert "max_by" in str(dedup.last_of("value", ["event", "value"]))
