import time
from datetime import timedelta

import pytest
from frame_rows import rows

from recordflow.schemas import TRIGGER_SCHEMA
from recordflow.session import shared_dir
from recordflow.streaming import streams


def land(path, name, *lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def test_bad_messages_do_not_stop_the_stream(spark, tmp_path):
    land(tmp_path / "in", "a.json", '{"record": "1", "flag": "1"}', "{broken", '{"record": "2", "flag": "0"}', '{"flag": "1"}')
    out, checkpoint = shared_dir(spark, "out"), shared_dir(spark, "checkpoint")
    messages = streams.read_messages(spark, str(tmp_path / "in"), TRIGGER_SCHEMA)
    writer = streams.dead_letters(messages, ["record"]).writeStream.format("parquet").option("path", out)
    streams.run_available(writer.option("checkpointLocation", checkpoint))
    assert rows(spark.read.parquet(out), "reason", "raw") == [("malformed", "{broken"), ("missing record", None)]


def test_triggers_process_each_landing_once(spark, tmp_path, eav):
    source = eav(("1", "a", "x"), ("2", "a", "y"), ("3", "a", "z"))
    out, checkpoint = shared_dir(spark, "out"), shared_dir(spark, "checkpoint")
    landing = tmp_path / "in"

    def run():
        handle = streams.trigger_handler(source, lambda df: df, out)
        stream = streams.trigger_stream(spark, str(landing))
        streams.run_available(streams.per_batch(stream, handle, checkpoint))

    land(landing, "a.json", '{"record": "1", "flag": "1"}', '{"record": "2", "flag": "0"}', '{"record": "1", "flag": "1"}')
    run()
    assert rows(spark.read.parquet(out), "record", "value") == [("1", "x")]
    run()
    land(landing, "b.json", '{"record": "3", "flag": "1"}')
    run()
    assert rows(spark.read.parquet(out), "record", "batch") == [("1", 0), ("3", 1)]


def test_repeated_batch_replaces_itself(spark):
    out = shared_dir(spark, "out")
    for _ in range(2):
        streams.write_batch(spark.range(3), out, 0)
    assert spark.read.parquet(out).count() == 3


def test_schedule(spark, tmp_path):
    land(tmp_path / "in", "a.json", '{"record": "1", "flag": "1"}')
    seen = []
    stream = streams.trigger_stream(spark, str(tmp_path / "in"))
    writer = streams.per_batch(stream, lambda df, n: seen.append(df.count()), shared_dir(spark, "checkpoint"))
    query = streams.run_every(writer, "1 second")
    for _ in range(60):
        if seen:
            break
        time.sleep(0.5)
    query.stop()
    assert seen == [1]


def test_repeated_batch_ignores_its_own_marks(spark, eav):
    from datetime import datetime

    from recordflow.operators.ledger import Ledger
    from recordflow.schemas import DICT_SCHEMA

    dictionary = spark.createDataFrame([("alerts_asr_1", "f", "radio", "0, No | 1, Yes")], DICT_SCHEMA)
    context = eav(("1", "mrn", "5", "arm"))
    batch = spark.createDataFrame(
        [("a", "answer", "5", 'Red: "Yes" to Sad asr_1', "a:1")],
        "id string, type string, secretId string, message string, cache_key string",
    )
    out, book = shared_dir(spark, "out"), Ledger(spark, shared_dir(spark, "ledger"), "alerts", 2)
    handle = streams.alert_handler(dictionary, context, out, book, lambda: datetime(2024, 1, 1))
    expected = [("1", "alerts_asr_1", 0), ("1", "asr_alerts", 0)]
    handle(batch, 0)
    handle(batch, 0)
    assert rows(spark.read.parquet(out), "record", "field_name", "batch") == expected
    handle(batch, 1)
    assert rows(spark.read.parquet(out), "record", "field_name", "batch") == expected


def _messages(spark, rows, schema):
    path = shared_dir(spark, "landed")
    for part in rows:
        spark.createDataFrame(part, schema.replace("timestamp", "string")).coalesce(1).write.mode("append").json(path)
    return streams.read_messages(spark, path, schema).drop(streams.CORRUPT)


def test_each_row_waits_for_its_first_positive_once(spark):
    asked = [("a", "k1", "2024-01-01 00:00:00"), ("b", "k2", "2024-01-01 00:00:00"), ("c", "k3", "2024-01-01 00:00:10"), ("d", "k4", "2024-01-01 00:00:00"), (None, "k1", "2024-01-01 00:00:01"), ("z", "zz", "2024-01-02 00:00:00")]
    positive = [("k1", "2024-01-01 00:00:05"), ("k1", "2024-01-01 00:00:06"), ("k2", "2024-01-01 00:00:40"), ("k3", "2023-12-31 23:59:59"), ("zz", "2024-01-03 00:00:00")]
    rows_ = _messages(spark, [asked], "name string, k string, at timestamp")
    seen = _messages(spark, [positive], "k string, seen timestamp")
    earlier = spark.sql("select 'k4' k, timestamp'2023-01-01' t")
    joined = streams.wait_for_first_positive(rows_, seen, "k", "at", "seen", timedelta(seconds=15), "1 second", earlier)
    out = shared_dir(spark, "out")
    streams.run_available(joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared_dir(spark, "checkpoint")))
    got = rows(spark.read.parquet(out), "name", "k", "alert")
    # Two positives give one row, an earlier one and one of the target give yes, one after the wait gives no.
    assert got == sorted([("a", "k1", "yes"), (None, "k1", "yes"), ("b", "k2", "no"), ("c", "k3", "yes"), ("d", "k4", "yes")], key=repr)
    assert spark.read.parquet(out).schema["at"].dataType.simpleString() == "timestamp"


def test_intervals_take_what_lands_meanwhile(spark):
    path, out = shared_dir(spark, "landed"), shared_dir(spark, "out")
    land = lambda n: spark.range(n, n + 1).selectExpr("cast(id as string) as x").write.mode("append").json(path)
    land(1)
    stream = streams.read_messages(spark, path, "x string").drop(streams.CORRUPT)
    seen = []
    writer = streams.per_batch(stream, lambda batch, n: seen.append((n, [r.x for r in batch.collect()])), shared_dir(spark, "checkpoint"))
    streams.run_until_done(writer, "1 second", [lambda: land(2), lambda: land(3)])
    assert seen == [(0, ["1"]), (1, ["2"]), (2, ["3"])] and not spark.streams.active


def test_a_repeat_passes_after_the_time_to_live_only(spark):
    path, out, checkpoint = shared_dir(spark, "landed"), shared_dir(spark, "out"), shared_dir(spark, "checkpoint")

    def batch(*keys):
        spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, n int").coalesce(1).write.mode("append").json(path)
        stream = streams.read_messages(spark, path, "k string, n int").drop(streams.CORRUPT)
        handle = lambda df, n: streams.write_batch(df, out, n)
        streams.run_available(streams.per_batch(streams.once_within(stream, "k", timedelta(seconds=20)), handle, checkpoint), idle=False)
        return time.monotonic()

    def passed():
        return [(r.batch, r.k, r.n is not None) for r in spark.read.parquet(out).orderBy("batch", "k", "n").collect()]

    handled = batch("a", "a", "b", None, None)
    assert passed() == [(0, None, True), (0, None, True), (0, "a", True), (0, "b", True)]
    second = batch("b", "c")
    if second - handled > 19:
        pytest.skip("the second batch took longer than the time to live")
    assert passed()[4:] == [(1, "c", True)]
    time.sleep(max(0.0, handled + 21 - time.monotonic()))
    batch("a", "b", "c" if time.monotonic() - second < 5 else "a")
    assert [k for n, k, _ in passed() if n == 2][:2] == ["a", "b"]
