"""Queries: what is written and read back, and the streams over landed messages.

Everything is staged under the session's shared folder from the test tables.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalog.base import ENTRIES, ORDERS_FLAT, iso, orders_flat, query, table, text
from recordflow import schemas
from recordflow.functions.nested import camel_case
from recordflow.functions.text import with_composite_key
from recordflow.operators import ledger
from recordflow.plans import alerts
from recordflow.session import shared_dir
from recordflow.sources import scan, sink
from recordflow.sources.csv_folder import CsvFolder
from recordflow.sources.journal import BucketedTable, Journal
from recordflow.streaming import streams


# ---------------------------------------------------------------- files


@query("""
SELECT '0' || s_suppkey AS mrn, CASE WHEN s_nationkey < 10 THEN NULL ELSE s_name END AS name, CAST(s_nationkey AS INTEGER) AS nation
FROM supplier
""")
def typed_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "csv")
    table(spark, sf, "supplier").select(
        F.concat(F.lit("0"), text("s_suppkey")).alias("mrn"),
        F.when(F.col("s_nationkey") >= 10, F.col("s_name")).alias("name"), F.col("s_nationkey").alias("nation"),
    ).write.option("header", True).csv(path)
    return scan.read_csv(spark, path, "mrn string, name string, nation int")


@query("SELECT '0' || s_suppkey AS mrn, CAST(s_suppkey AS INTEGER) AS number FROM supplier")
def pinned_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "csv")
    number = F.concat(F.lit("0"), text("s_suppkey"))
    table(spark, sf, "supplier").select(number.alias("mrn"), number.alias("number")).write.option("header", True).csv(path)
    return scan.read_csv_pinned(spark, path)


@query("""
SELECT '0' || o_orderkey AS mrn, CAST(o_totalprice AS DOUBLE) AS amount, CAST(o_orderdate AS DATE) AS day,
       o_orderkey * 1000003 AS number, o_orderpriority AS priority FROM orders
""")
def csv_folder_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Orders land in two parts; the second widens a whole amount to a decimal one and an int to a long."""
    path, orders = shared_dir(spark, "csv"), table(spark, sf, "orders")
    rows = orders.select(
        F.concat(F.lit("0"), text("o_orderkey")).alias("mrn"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), (F.col("o_orderkey") * 1000003).alias("number"), F.col("o_orderpriority").alias("priority"),
    )
    folder = CsvFolder(Journal(spark, shared_dir(spark, "types")), "orders", path, rows.columns, scan.ID_COLUMNS)
    for number, part in enumerate((F.col("number") < 2**31, F.col("number") >= 2**31)):
        rows.where(part).write.mode("append").option("header", True).csv(path)
        folder.run(f"run-{number}", "2024-01-01T00:00:00")
    return folder.read()


@query("SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind FROM events")
def json_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "json")
    table(spark, sf, "events").select(
        F.concat(F.lit('{"status":"ok","result":[{"kind":"'), "event_type", F.lit('","props":'), "props", F.lit("}]}"))
    ).write.text(path)
    rows = scan.read_results(spark, path, "kind string, props struct<k: bigint>")
    return rows.select(F.col("props.k").alias("k"), "kind")


@query("SELECT o_orderkey, o_custkey, o_orderstatus AS instrument FROM orders WHERE o_orderstatus IN ('F', 'O')")
def instrument_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A file per status, read back for the instruments that are known in another case."""
    base, parts = shared_dir(spark, "instruments"), shared_dir(spark, "parts")
    orders = table(spark, sf, "orders")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    files = path(base).getFileSystem(conf)
    files.mkdirs(path(base))
    for status in ("F", "O", "P"):
        # An export has one file per instrument; Spark names its own files, so they are renamed.
        one = orders.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_custkey").coalesce(1)
        one.write.option("header", True).csv(f"{parts}/{status}")
        written = next(f.getPath() for f in files.listStatus(path(f"{parts}/{status}")) if f.getPath().getName().startswith("part"))
        files.rename(written, path(f"{base}/{status}.csv"))
    known = orders.where("o_orderstatus <> 'P'").select(F.lower("o_orderstatus").alias("instrument_name"))
    return scan.read_instruments(spark, base, "o_orderkey bigint, o_custkey bigint", known)


@query("SELECT o_orderstatus AS status, count(*) AS intake, count(*) AS app FROM orders GROUP BY o_orderstatus")
def fan_out(spark: SparkSession, sf: str) -> DataFrame:
    base = shared_dir(spark, "targets")
    targets = {"intake": f"{base}/intake", "app": f"{base}/app"}
    sink.fan_out(orders_flat(spark, sf).where("status <> 'P'"), targets)
    sink.fan_out(orders_flat(spark, sf).where("status = 'P'"), targets)
    counts = [
        spark.read.parquet(path).groupBy("status").agg(F.count("*").alias(name)) for name, path in targets.items()
    ]
    return counts[0].join(counts[1], "status")


@query("""
SELECT o_orderkey, o_orderstatus, 'consent_form_created_in_redcap' AS consent FROM orders
""")
def partitioned_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "studies")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    sink.per_group(orders, path, "o_orderstatus", {"consent": "consent_form_created_in_redcap"})
    return sink.read_back(spark, path)


@query("SELECT event_type AS instrument, count(*) AS row_count FROM events GROUP BY event_type")
def instrument_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "instruments")
    named = table(spark, sf, "events").select("event_id", F.concat("event_type", F.lit("_redcap")).alias("instrument"))
    sink.per_instrument(named, path)
    return sink.read_back(spark, path).groupBy("instrument").agg(F.count("*").alias("row_count"))


@query("""
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS datetime, CASE WHEN user_id < 50 THEN 'N/A' ELSE CAST(user_id AS VARCHAR) END AS mrn,
       'bad ' || chr(9) || ' "value"' AS error, '1' AS attempt FROM events WHERE event_type = 'error'
""")
def error_log(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "errors")
    errors = table(spark, sf, "events").where("event_type = 'error'").select(
        F.col("ts").alias("datetime"), F.when(F.col("user_id") >= 50, text("user_id")).alias("mrn"),
        F.lit('bad \t "value"').alias("error"), F.lit(None).cast("string").alias("attempt"),
    )
    sink.append_error_log(errors, path)
    reader = spark.read.option("sep", "\t").option("header", True)
    return reader.schema("datetime string, mrn string, error string, attempt string").csv(path)


@query(f"SELECT record_id, status, price FROM ({ORDERS_FLAT}) WHERE status <> 'P'")
def version_swap(spark: SparkSession, sf: str) -> DataFrame:
    base = shared_dir(spark, "versions")
    first = sink.write_version(orders_flat(spark, sf).select("record_id", "status", "price"), base)
    second = sink.write_version(sink.read_back(spark, first).where("status <> 'P'"), base)
    return sink.read_back(spark, second)


@query("""
SELECT CAST(user_id AS VARCHAR) AS key FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'purchase' AND value > 120) = 0
""")
def ledger_table(spark: SparkSession, sf: str) -> DataFrame:
    """Mark all users, take out those with a large purchase, list what is left."""
    book = ledger.Ledger(spark, shared_dir(spark, "ledger"), "users", 60)
    events = table(spark, sf, "events")
    book.mark(events.select(text("user_id")), "2024-02-01T00:00:00", {"from": "events"})
    book.remove(events.where("event_type = 'purchase' AND value > 120").select(text("user_id")), "2024-02-01T00:10:00")
    return book.live("2024-02-01T00:20:00").select("key")


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS key FROM events WHERE event_type <> 'purchase'")
def ledger_purged(spark: SparkSession, sf: str) -> DataFrame:
    """Buyers were marked two days before; their day is deleted, the others' is not."""
    book = ledger.Ledger(spark, shared_dir(spark, "ledger"), "users", 60)
    events = table(spark, sf, "events")
    book.mark(events.where("event_type = 'purchase'").select(text("user_id")), "2024-01-30T12:00:00")
    book.mark(events.where("event_type <> 'purchase'").select(text("user_id")), "2024-02-01T00:00:00")
    book.purge("2024-02-01T00:30:00")
    return book.log().select("key")


# ---------------------------------------------------------------- alerts


def band():
    """Which of three items an alert is about."""
    return F.when(F.col("value") > 100, "3").when(F.col("value") > 50, "2").otherwise("1")


def alert_messages(spark: SparkSession, sf: str) -> DataFrame:
    """One alert per event as it arrives on the wire; clicks are of another type."""
    level = F.when(F.col("value") > 75, "High").otherwise(" low ")
    message = F.concat(
        F.lit('Red: "'), level, F.lit('" to Feeling low Parent_'), "event_type", F.lit("_"), band()
    )
    return table(spark, sf, "events").select(
        text("event_id").alias("id"), text("user_id").alias("secret_id"), message.alias("message"),
        F.when(F.col("event_type") == "click", "note").otherwise("answer").alias("type"), iso("ts").alias("created_at"),
    )


def alert_context(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Dictionary of the alert fields (none for signups), and what the target holds already."""
    events = table(spark, sf, "events")
    field = F.concat(F.lit("alerts_parent_"), "event_type", F.lit("_"), band()).alias("field_name")
    dictionary = events.where("event_type <> 'signup'").select(field).distinct().withColumn(
        "select_choices_or_calculations", F.lit("0, Low | 01, HIGH | x")
    )
    held = events.where("event_type IN ('view', 'error')").select(
        text("user_id").alias("record"), field, F.lit("1").alias("value"),
        F.concat(F.lit("arm_"), "event_type").alias("redcap_event_name"),
    )
    ids = events.where("event_type = 'purchase' AND value > 100").select(
        F.concat(F.lit("R"), text("user_id")).alias("record"), F.lit("mrn").alias("field_name"),
        text("user_id").alias("value"), F.lit("arm_z").alias("redcap_event_name"),
    )
    return dictionary, ids.unionByName(held)


_BAND = "CASE WHEN value > 100 THEN '3' WHEN value > 50 THEN '2' ELSE '1' END"
CODED = f"""
WITH items AS (
  SELECT event_id, 'R' || user_id AS record, event_type, 'alerts_parent_' || event_type || '_' || {_BAND} AS field_name,
         CASE WHEN value > 75 THEN '1' ELSE '0' END AS value,
         CASE WHEN event_type = 'view' THEN 'arm_view' ELSE 'arm_error' END AS redcap_event_name
  FROM events WHERE event_type NOT IN ('click', 'signup') {{0}}
    AND user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 100))
SELECT record, field_name, value, redcap_event_name FROM items
UNION ALL SELECT DISTINCT record, 'parent_' || event_type || '_alerts', 'yes', redcap_event_name FROM items
"""


def _staged(df: DataFrame, purpose: str) -> str:
    path = shared_dir(df.sparkSession, purpose)
    df.write.json(path)
    return path


@query(CODED.format(""))
def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    dictionary, context = alert_context(spark, sf)
    source, out = _staged(alert_messages(spark, sf), "alerts"), shared_dir(spark, "coded")
    stream = streams.alert_stream(spark, source)
    handle = streams.alert_handler(dictionary, context, out)
    streams.run_available(streams.per_batch(stream, handle, shared_dir(spark, "checkpoint")))
    return sink.read_back(spark, out).drop("batch")


@query(CODED.format(""))
def stream_alerts_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The same messages land twice; within the time to live the second time adds nothing."""
    dictionary, context = alert_context(spark, sf)
    source, out = _staged(alert_messages(spark, sf), "alerts"), shared_dir(spark, "coded")
    book = ledger.Ledger(spark, shared_dir(spark, "ledger"), "alerts", 2)
    checkpoint = shared_dir(spark, "checkpoint")
    now = iter([datetime(2024, 2, 1), datetime(2024, 2, 1) + timedelta(minutes=1)])
    handle = streams.alert_handler(dictionary, context, out, book, lambda: next(now))
    for _ in range(2):
        stream = with_composite_key(streams.alert_stream(spark, source), ["id", "message"])
        streams.run_available(streams.per_batch(stream, handle, checkpoint))
        alert_messages(spark, sf).write.mode("append").json(source)
    return sink.read_back(spark, out).drop("batch")


@query(f"""
SELECT DISTINCT record, field_name, value, redcap_event_name FROM ({CODED.format("")})
""")
def stream_alerts_merged(spark: SparkSession, sf: str) -> DataFrame:
    """First every answer comes as High, then as it is; the second batch is given once more at the end, with the first's answers."""
    dictionary, context = alert_context(spark, sf)
    messages = alert_messages(spark, sf)
    early = messages.withColumn("message", F.replace("message", F.lit("\" low \""), F.lit("\"High\"")))
    source = _staged(early, "alerts")
    journal = Journal(spark, shared_dir(spark, "merged"))
    merged = BucketedTable.long(journal, "alerts", T.StructType.fromDDL("record string, field_name string, value string, redcap_event_name string"), buckets=8)
    handle = streams.alert_merger(dictionary, context, merged, clock=lambda: datetime(2024, 2, 1))
    checkpoint = shared_dir(spark, "checkpoint")
    for rows in (messages, None):
        streams.run_available(streams.per_batch(streams.alert_stream(spark, source), handle, checkpoint))
        if rows is not None:
            rows.write.mode("append").json(source)
    handle(camel_case(early), 1)
    return merged.read()


@query(CODED.format(""))
def alert_both_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """Every second message comes in camelCase."""
    dictionary, context = alert_context(spark, sf)
    source, out = shared_dir(spark, "alerts"), shared_dir(spark, "coded")
    messages = alert_messages(spark, sf)
    odd = F.col("id").cast("bigint") % 2 == 1
    messages.where(~odd).write.mode("append").json(source)
    camel_case(messages.where(odd)).write.mode("append").json(source)
    handle = streams.alert_handler(dictionary, context, out)
    streams.run_available(streams.per_batch(streams.alert_stream(spark, source), handle, shared_dir(spark, "checkpoint")))
    return sink.read_back(spark, out).drop("batch")


@query(f"""
WITH items AS (SELECT CAST(user_id AS VARCHAR) AS record, event_type, event_id, {_BAND} AS band, value FROM events WHERE event_type <> 'click')
SELECT record, 'alerts_parent_' || event_type || '_' || band AS field_name, CASE WHEN value > 75 THEN 'High' ELSE ' low ' END AS value,
       CASE WHEN event_type = 'signup' THEN 'unknown field' ELSE 'unknown record' END AS reason
FROM items WHERE event_id % 7 > 1 AND (event_type = 'signup'
  OR record NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase' AND value > 100))
UNION ALL SELECT record, NULL, 'no such shape', 'unreadable' FROM items WHERE event_id % 7 = 1
UNION ALL SELECT NULL, NULL, '{{"id": "' || event_id || '", ', 'malformed' FROM events WHERE event_id % 7 = 0
""")
def stream_alerts_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """What the stream can't push: broken and unreadable messages, unknown fields and records."""
    dictionary, context = alert_context(spark, sf)
    source, out, dead = shared_dir(spark, "alerts"), shared_dir(spark, "coded"), shared_dir(spark, "dead")
    part = F.col("id").cast("bigint") % 7
    shape = F.when(part == 1, "no such shape").otherwise(F.col("message"))
    messages = alert_messages(spark, sf)
    messages.where(part > 0).withColumn("message", shape).write.mode("append").json(source)
    broken = F.concat(F.lit('{"id": "'), "id", F.lit('", '))
    messages.where(part == 0).select(broken).write.mode("append").text(source)
    handle = streams.alert_handler(dictionary, context, out, dead=dead)
    streams.run_available(streams.per_batch(streams.alert_stream(spark, source), handle, shared_dir(spark, "checkpoint")))
    return sink.read_back(spark, dead).drop("batch")


@query(CODED.format("AND event_type <> 'purchase'"))
def job_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The batch twin; purchases are in the ledger already."""
    dictionary, context = alert_context(spark, sf)
    messages = camel_case(alert_messages(spark, sf))
    seen = messages.where(F.col("message").contains("_purchase_"))
    key = F.concat_ws(":", "id", F.substring(F.md5("message"), 1, 8))
    log = ledger.entries(seen.select(key), "alerts", "2024-02-01T00:00:00")
    fresh = alerts.new_alerts(messages, log, "alerts", "2024-02-01T00:01:00")
    return alerts.coded_alerts(alerts.parsed_alerts(fresh), dictionary, context)


# ---------------------------------------------------------------- triggers and bad messages


def _triggers(spark: SparkSession, sf: str) -> DataFrame:
    """A trigger per order; the flag is set for open ones."""
    return table(spark, sf, "orders").select(
        F.lit(247).alias("project_id"), F.lit("intake").alias("instrument"), text("o_orderkey").alias("record"),
        F.when(F.col("o_orderstatus") == "O", "1").otherwise("0").alias("flag"),
    )


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS record, CAST(l_linenumber AS VARCHAR) AS line FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
""")
def stream_triggers(spark: SparkSession, sf: str) -> DataFrame:
    path, out = _staged(_triggers(spark, sf), "triggers"), shared_dir(spark, "triggered")
    source = table(spark, sf, "lineitem").select(text("l_orderkey").alias("record"), text("l_linenumber").alias("line"))
    handle = streams.trigger_handler(source, lambda rows: rows, out)
    writer = streams.per_batch(streams.trigger_stream(spark, path), handle, shared_dir(spark, "checkpoint"))
    streams.run_available(writer)
    return sink.read_back(spark, out).drop("batch")


@query("""
SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'click' THEN 'missing message' ELSE 'missing id,message' END AS reason,
       CASE WHEN event_type = 'error' THEN '{"id": "' || event_id || '", ' END AS raw,
       CASE WHEN event_type = 'click' THEN CAST(event_id AS VARCHAR) END AS id, CAST(NULL AS VARCHAR) AS message
FROM events WHERE event_type IN ('error', 'click', 'view')
""")
def stream_dead_letter(spark: SparkSession, sf: str) -> DataFrame:
    kind, number = F.col("event_type"), text("event_id")
    line = (
        F.when(kind == "error", F.concat(F.lit('{"id": "'), number, F.lit('", \x1b[0m')))
        .when(kind == "click", F.concat(F.lit('{"id": "'), number, F.lit('", "type": "answer"}')))
        .when(kind == "view", F.lit('{"type": "answer"}'))
        .otherwise(F.concat(F.lit('{"id": "'), number, F.lit('", "message": "fine"}')))
    )
    path, out = shared_dir(spark, "messages"), shared_dir(spark, "dead")
    table(spark, sf, "events").select(line).write.text(path)
    letters = streams.dead_letters(streams.read_messages(spark, path, schemas.ALERT_SCHEMA), ["id", "message"])
    writer = letters.writeStream.format("parquet").option("path", out)
    streams.run_available(writer.option("checkpointLocation", shared_dir(spark, "checkpoint")))
    return spark.read.parquet(out)


def _waiting_sides(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Streams of views and errors, each with a last message that closes all waits."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", iso("ts").alias("at"))
    closing = events.agg(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit(-1).cast("bigint").alias("user_id"),
        F.date_format(F.max("at").cast("timestamp") + F.expr("interval 5 days"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"),
    )
    sides = {}
    for kind in ("view", "error"):
        rows = events.where(F.col("event_type") == kind).drop("event_type").unionByName(closing)
        stream = streams.read_messages(spark, _staged(rows, kind), "event_id bigint, user_id bigint, at timestamp")
        sides[kind] = stream.drop(streams.CORRUPT)
    return sides


@query("""
SELECT DISTINCT v.event_id, CASE WHEN e.event_id IS NULL THEN 'no' ELSE 'yes' END AS alert
FROM events v LEFT JOIN events e ON e.event_type = 'error' AND v.user_id = e.user_id
  AND e.ts BETWEEN v.ts AND v.ts + INTERVAL 6 HOUR
WHERE v.event_type = 'view'
""")
def stream_wait_default(spark: SparkSession, sf: str) -> DataFrame:
    """Views wait six hours for an error of the same user; a last message on each side closes the wait."""
    sides = _waiting_sides(spark, sf)
    joined = streams.wait_for_positives(
        sides["view"], sides["error"].withColumnRenamed("at", "error_at"), "user_id", "at", "error_at", "6 hours", "1 minute"
    )
    out = shared_dir(spark, "waited")
    # The closing rows are filtered afterwards: a filter in the stream would move below the watermark.
    writer = joined.select("event_id", "alert").writeStream.format("parquet").option("path", out)
    streams.run_available(writer.option("checkpointLocation", shared_dir(spark, "checkpoint")))
    return spark.read.parquet(out).where("event_id >= 0").distinct()


@query("""
SELECT v.event_id, CASE WHEN v.ts + INTERVAL 6 HOUR >= (SELECT min(e.ts) FROM events e WHERE e.event_type = 'error' AND e.user_id = v.user_id)
  THEN 'yes' ELSE 'no' END AS alert
FROM events v WHERE v.event_type = 'view'
""")
def wait_default(spark: SparkSession, sf: str) -> DataFrame:
    """The batch twin."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    views = events.where("event_type = 'view'")
    errors = events.where("event_type = 'error'").select("user_id", F.col("ts").alias("error_at"))
    joined = streams.wait_for_positives(views, errors, "user_id", "ts", "error_at", "6 hours")
    return joined.select("event_id", "alert")


@query("SELECT DISTINCT user_id || ':' || event_type AS cache_key FROM events")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """All messages land at once, so every repeat falls into the time kept."""
    rows = with_composite_key(table(spark, sf, "events"), ["user_id", "event_type"]).select("cache_key", iso("ts").alias("at"))
    stream = streams.read_messages(spark, _staged(rows, "repeats"), "cache_key string, at timestamp")
    out = shared_dir(spark, "once")
    once = streams.suppress_repeats(stream.drop(streams.CORRUPT), "cache_key", "at").select("cache_key")
    writer = once.writeStream.format("parquet").option("path", out)
    streams.run_available(writer.option("checkpointLocation", shared_dir(spark, "checkpoint")))
    return spark.read.parquet(out)


@query("SELECT DISTINCT user_id || ':' || event_type AS cache_key FROM events")
def stream_once_within(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the people's messages land first, then all of them once more, within the time kept."""
    rows = with_composite_key(table(spark, sf, "events"), ["user_id", "event_type"]).select("cache_key")
    path, out, checkpoint = _staged(rows.where(F.crc32(F.col("cache_key").cast("binary")) % 2 == 0), "again"), shared_dir(spark, "once"), shared_dir(spark, "checkpoint")
    for more in (rows, None):
        stream = streams.read_messages(spark, path, "cache_key string").drop(streams.CORRUPT)
        once = streams.once_within(stream, "cache_key", timedelta(days=1))
        writer = once.writeStream.format("parquet").option("path", out)
        streams.run_available(writer.option("checkpointLocation", checkpoint), idle=False)
        if more is not None:
            more.write.mode("append").json(path)
    return spark.read.parquet(out)


@query(ENTRIES["wait_default"].sql)
def stream_wait_first(spark: SparkSession, sf: str) -> DataFrame:
    """As on tables: each view comes out once, and errors before it count; the first day's are in the target."""
    sides = _waiting_sides(spark, sf)
    errors = table(spark, sf, "events").where("event_type = 'error'")
    start = errors.agg(F.min("ts").alias("t"))
    before = errors.join(F.broadcast(start), F.col("ts") < F.col("t") + F.expr("interval 1 day")).select("user_id", "ts")
    out = shared_dir(spark, "waited")
    joined = streams.wait_for_first_positive(
        sides["view"], sides["error"].withColumnRenamed("at", "error_at"), "user_id", "at", "error_at", timedelta(hours=6), "1 minute", before
    )
    writer = joined.select("event_id", "alert").writeStream.format("parquet").option("path", out)
    streams.run_available(writer.option("checkpointLocation", shared_dir(spark, "checkpoint")))
    return spark.read.parquet(out).where("event_id >= 0")


@query(CODED.format(""))
def stream_alerts_interval(spark: SparkSession, sf: str) -> DataFrame:
    """A micro-batch each second: those of half of the people are there at first, the rest land later."""
    dictionary, context = alert_context(spark, sf)
    messages = alert_messages(spark, sf)
    odd = F.crc32(F.col("secret_id").cast("binary")) % 2 == 1
    source, out = _staged(messages.where(odd), "alerts"), shared_dir(spark, "coded")
    handle = streams.alert_handler(dictionary, context, out)
    writer = streams.per_batch(streams.alert_stream(spark, source), handle, shared_dir(spark, "checkpoint"))
    streams.run_until_done(writer, "1 second", [lambda: messages.where(~odd).write.mode("append").json(source)])
    return sink.read_back(spark, out).drop("batch")
