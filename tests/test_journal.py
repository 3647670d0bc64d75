from pathlib import Path

import pytest
from frame_rows import rows
from pyspark.sql import types as T

from recordflow.operators import ledger
from recordflow.plans import finish
from recordflow.schemas import LEDGER_SCHEMA
from recordflow.session import shared_dir
from recordflow.sources.journal import BucketedTable, Journal, Output
from recordflow.streaming import streams

LONG = T.StructType([T.StructField(c, T.StringType()) for c in ("record", "redcap_event_name", "field_name", "value")])
WIDE = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
T0, T1 = "2024-01-01T00:00:00", "2024-01-01T01:00:00"


class Died(RuntimeError):
    pass


def die(run):
    raise Died(run)


@pytest.fixture
def journal(spark):
    return Journal(spark, shared_dir(spark, "journal"))


def files(journal, name):
    return {f"{p.parent.name}/{p.name}": p.stat().st_mtime_ns for p in Path(journal.base.removeprefix("file:"), name, "rows").rglob("part-*.parquet")}


@pytest.mark.parametrize("step", range(5))
def test_a_run_that_dies_anywhere_is_as_if_it_had_not_been(spark, journal, step):
    table = BucketedTable.flat(journal, "people", WIDE, ["id"], buckets=4)
    journal.run("r1", {"people": table.push(spark.createDataFrame([(1, "x", "y"), (2, "x", None)], WIDE))}, T0)
    new = spark.createDataFrame([(2, "", "z"), (3, "q", None)], WIDE)
    sent, keys = spark.createDataFrame([("m",)], "message string"), spark.createDataFrame([("k",)], "key string")
    writes = finish.writes(journal, T1, {table: new}, {"sent": sent}, keys)
    names = list(writes)
    assert names == ["people", "sent", "ledger", "report"]
    dying = dict(zip(names[:step], map(writes.get, names[:step])))
    with pytest.raises(Died):
        journal.run("r2", {**dying, "crash": die}, T1)
    # Readers see the first run only.
    assert rows(table.read()) == [(1, "x", "y"), (2, "x", None)]
    assert Output(journal, "sent").read("message string").isEmpty()
    assert not journal.committed("r2")
    for expected in (True, False):
        assert journal.run("r2", writes, T1) is expected
        assert rows(table.read()) == [(1, "x", "y"), (2, "x", "z"), (3, "q", None)]
        assert rows(Output(journal, "sent").read("message string")) == [("m",)]
        assert [r.successes for r in Output(journal, "report").read(finish.REPORT_SCHEMA).collect()] == [3]
    log = Output(journal, "ledger").read(LEDGER_SCHEMA)
    assert ledger.unprocessed(keys.withColumnRenamed("key", "cache_key"), log, finish.LEDGER, T1, 2).isEmpty()
    assert rows(journal.lines(), "number", "run", "target", "row_count") == [
        (1, "r1", "people", 2), (2, "r2", "ledger", 1), (2, "r2", "people", 2), (2, "r2", "report", 1), (2, "r2", "sent", 1),
    ]


def test_a_push_rewrites_only_the_buckets_it_touches(spark, journal):
    table = BucketedTable.flat(journal, "people", WIDE, ["id"], buckets=16)
    journal.run("r1", {"people": table.push(spark.createDataFrame([(i, "x", "y") for i in range(200)], WIDE))}, T0)
    before = files(journal, "people")
    held = table.manifest()
    journal.run("r2", {"people": table.push(spark.createDataFrame([(7, "new", None)], WIDE))}, T1)
    after = files(journal, "people")
    assert {n: t for n, t in after.items() if n in before} == before
    changed = [b for b, run in table.manifest().items() if run != held[b]]
    assert len(changed) == 1 and len(table.read().inputFiles()) <= len(before)
    assert sum(f in before for f in ("/".join(Path(x).parts[-2:]) for x in table.read().inputFiles())) >= len(before) - 1
    assert rows(table.read().where("a = 'new'")) == [(7, "new", "y")] and table.read().count() == 200


def test_long_keys_with_nulls_and_several_rows(spark, journal):
    table = BucketedTable.long(journal, "facts", LONG, buckets=3)
    journal.run("r1", {"facts": table.push(spark.createDataFrame([("1", None, "f", "a"), ("1", None, "f", "b"), ("2", "e", "g", "c")], LONG))}, T0)
    journal.run("r2", {"facts": table.push(spark.createDataFrame([("1", None, "f", "z"), ("2", "e", "g", ""), (None, None, "h", "n")], LONG))}, T1)
    assert rows(table.read()) == sorted([("1", None, "f", "z"), ("2", "e", "g", "c"), (None, None, "h", "n")], key=repr)


def test_empty_pushes(spark, journal):
    table = BucketedTable.long(journal, "facts", LONG)
    assert table.read().isEmpty()
    journal.run("r1", {"facts": table.push(spark.createDataFrame([], LONG))}, T0)
    assert table.read().isEmpty() and journal.committed("r1")


def test_failed_instruments_are_reported(spark, journal):
    finish.finish(journal, "r1", T0, outputs={"sent": spark.createDataFrame([(1,)], "n long")}, failed={"forms": "no key column"})
    report = Output(journal, "report").read(finish.REPORT_SCHEMA).first()
    assert (report.status, report.successes, report.failures, report.failed) == ("failure", 1, 1, "forms")


def test_alert_batches_merge_once(spark, journal):
    from catalog.landing import alert_context, alert_messages, camel_case

    sf = "/root/testdata/sf0.001"
    dictionary, context = alert_context(spark, sf)
    table = BucketedTable.long(journal, "alerts", LONG, buckets=4)
    handle = streams.alert_merger(dictionary, context, table)
    messages = camel_case(alert_messages(spark, sf))
    handle(messages, 0)
    first = rows(table.read())
    handle(messages.limit(0), 0)
    assert rows(table.read()) == first and first
    handle(messages, 1)
    assert rows(table.read()) == first and len(journal.runs("alerts")) == 2


def test_a_wide_push_resumes_at_the_slice_that_failed(spark, journal):
    table = BucketedTable.flat(journal, "people", WIDE, ["id"], buckets=2)
    parts = [spark.createDataFrame([(1, "x")], "id long, a string"), spark.createDataFrame([(1, "y")], "id long, b string")]
    with pytest.raises(Died):
        journal.run(finish.slice_run("w", parts[1]), {"people": table.push(parts[1]), "crash": die}, T0)
    assert finish.push_slices(journal, "w", table, parts[:1], T0) == 1
    assert rows(table.read()) == [(1, "x", None)]
    assert finish.push_slices(journal, "w", table, parts, T1) == 1
    assert rows(table.read()) == [(1, "x", "y")]
    assert finish.push_slices(journal, "w", table, parts, T1) == 0
