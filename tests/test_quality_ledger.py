from datetime import datetime, timedelta

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from recordflow.operators import ledger, quality
from recordflow.session import shared_dir

NOW = datetime(2024, 5, 10, 12)


def test_known_fields(spark, eav):
    d = spark.createDataFrame([("a",), ("a",)], "field_name string")
    kept, unknown = quality.known_fields(eav(("1", "a", "x"), ("1", "mrn", "9"), ("1", "b", "y"), ("2", "b", "z")), d)
    assert rows(kept, "field_name") == [("a",), ("mrn",)]
    assert rows(unknown) == [("b",)]


def test_column_gate(spark):
    df = spark.createDataFrame([("1", "e", 1, 2, "2")], "record_id string, redcap_event_name string, good int, bad int, form_complete string")
    kept, unknown = quality.column_gate(df, spark.createDataFrame([("good",)], "field_name string"), "Form")
    assert (kept.columns, unknown) == (["record_id", "redcap_event_name", "good", "form_complete"], ["bad"])
    assert quality.data_columns(df) == ["good", "bad", "form_complete"]
    assert quality.data_columns(df.drop("record_id")) == []


def errors(spark, text):
    return spark.createDataFrame([(text,)], "error string")


@pytest.mark.parametrize(
    "tail, names",
    [("real data fields: field1 , field2  ,  field3", ["field1", "field2", "field3"]),
     ("real data fields: field1\nother, text", ["field1"]), ("something else", [])],
)
def test_error_fields(spark, tail, names):
    text = "The following fields were not found in the project as " + tail
    assert [r[0] for r in rows(quality.error_fields(errors(spark, text)), "field_name")] == names


def test_error_categories(spark):
    text = '"1","sex","9","The value is not a valid category for sex"\n"2","q","","The value is not a valid category for q"'
    assert rows(quality.error_categories(errors(spark, text))) == [
        ("1", "sex", "9", "The value is not a valid category for sex"), ("2", "q", "", "The value is not a valid category for q")
    ]


def test_new_today(spark):
    log = spark.sql("VALUES ('a', DATE '2024-05-10'), ('b', DATE '2024-05-09'), ('c', DATE '2024-05-01') AS t(field_name, day)")
    new, kept = quality.new_today(spark.createDataFrame([("a",), ("b",), ("b",)], "field_name string"), log, "2024-05-10")
    assert rows(new) == [("b",)]
    assert sorted((f, str(d)) for f, d in rows(kept)) == [("a", "2024-05-10"), ("b", "2024-05-09"), ("b", "2024-05-10")]


@pytest.mark.parametrize(
    "status, message, outcome",
    [(200, None, "created"), (422, None, "exists"), (400, "Non-unique value.", "exists"), (400, "x", "error"), (400, None, "error"), (500, None, "error")],
)
def test_outcome(spark, status, message, outcome):
    column = quality.outcome_class(F.lit(status), F.lit(message).cast("string"))
    assert spark.range(1).select(column).first()[0] == outcome


def book(spark, ttl=2):
    return ledger.Ledger(spark, shared_dir(spark, "ledger"), "test", ttl)


def keyed(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "cache_key string")


def test_ttl_and_remark(spark):
    b = book(spark)
    b.mark(keyed(spark, "a", "b", "a"), NOW, {"n": "1"})
    at = lambda minutes: NOW + timedelta(minutes=minutes)
    assert rows(b.unprocessed(keyed(spark, "a", "c"), at(2))) == [("c",)]
    assert rows(b.unprocessed(keyed(spark, "a", "c"), at(2.1))) == [("a",), ("c",)]
    b.mark(keyed(spark, "a"), at(2))
    assert rows(b.unprocessed(keyed(spark, "a", "b"), at(3))) == [("b",)]
    assert rows(b.live(at(1)), "key") == [("a",), ("b",)]


def test_remove_and_clear(spark):
    b = book(spark, 60)
    b.mark(keyed(spark, "a", "b", "c"), NOW)
    b.remove(keyed(spark, "b"), NOW + timedelta(seconds=1))
    assert rows(b.live(NOW + timedelta(minutes=1)), "key") == [("a",), ("c",)]
    stats = b.stats(NOW + timedelta(minutes=1)).first()
    assert (stats.ledger, stats.entries) == ("test", 2)
    b.clear(NOW + timedelta(seconds=2))
    assert b.live(NOW + timedelta(minutes=1)).count() == 0
    b.mark(keyed(spark, "b"), NOW + timedelta(seconds=3))
    assert rows(b.live(NOW + timedelta(minutes=1)), "key") == [("b",)]


def test_days_are_pruned_and_purged(spark):
    b = book(spark, 60)
    for day in (1, 2, 3):
        b.mark(keyed(spark, f"k{day}"), NOW + timedelta(days=day))
    plan = b.live(NOW + timedelta(days=3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert len(b.purge(NOW + timedelta(days=3))) == 2
    assert rows(b.log(), "key") == [("k3",)] and b.purge(NOW + timedelta(days=3)) == []


def test_ledgers_do_not_mix(spark):
    path = shared_dir(spark, "ledger")
    one, two = ledger.Ledger(spark, path, "one"), ledger.Ledger(spark, path, "two")
    one.mark(keyed(spark, "a"), NOW)
    assert two.unprocessed(keyed(spark, "a"), NOW).count() == 1


@pytest.mark.parametrize(
    "last_activity, options, minutes",
    [(NOW - timedelta(minutes=5), {}, 2), (NOW - timedelta(hours=3), {}, 1440), (NOW - timedelta(hours=2), {}, 2),
     (None, {}, 2), (None, {"recovery": True}, 1440), (NOW - timedelta(hours=3), {"full_day_fallback": False}, 2)],
)
def test_recent_window(spark, last_activity, options, minutes):
    b = book(spark)
    if last_activity:
        b.mark(keyed(spark, "a"), last_activity)
    window = ledger.recent_window(b.log(), NOW, **options)
    length = window.select(F.col("window_end").cast("long") - F.col("window_start").cast("long")).first()[0]
    assert length == minutes * 60


def test_built_key(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "x string, y int")
    out = ledger.with_built_key(df, ["x", "y"], lambda x, y: x + "-" + y.map(lambda v: "none" if v != v else str(int(v))))
    assert rows(out, "cache_key") == [("a-1",), ("b-none",)]


def test_unchanged_groups(spark):
    df = spark.createDataFrame([("i", 1), ("i", 2), ("j", 1)], "instrument string, v int")
    empty = book(spark).log()
    load, _ = ledger.unchanged_groups(df, empty, "test", NOW)
    log = ledger.entries(load.where("instrument = 'i'").select("cache_key"), "test", NOW)
    load, skip = ledger.unchanged_groups(df, log, "test", NOW + timedelta(minutes=1))
    assert (rows(load, "instrument"), rows(skip, "instrument", "row_count")) == ([("j",)], [("i", 2)])
    changed = df.unionByName(df.where("v = 2"))
    assert ledger.unchanged_groups(changed, log, "test", NOW)[1].count() == 0
