"""Alert and trigger streams: reading, isolation of bad messages, upsert, late defaults."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import UTC, datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from recordflow.functions.nested import both_spellings, either_spelling
from recordflow.functions.text import sanitize
from recordflow.operators.joins import only_keys, same_key
from recordflow.operators.ledger import BATCH, Ledger, entries
from recordflow.plans.alerts import parsed_alerts, rejected_alerts, split_alerts
from recordflow.schemas import ALERT_SCHEMA, RECORD, TRIGGER_SCHEMA
from recordflow.sources.journal import BucketedTable, Output

CORRUPT = "_corrupt_record"
IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def read_messages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Stream of JSON messages; a malformed one fills ``_corrupt_record`` and nothing else."""
    return (
        spark.readStream.schema(f"{schema}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def alert_stream(spark: SparkSession, path: str) -> DataFrame:
    """Stream of alerts, written in either spelling, in that of the batch interface.

    A malformed message keeps its text in ``_corrupt_record`` and has nothing else.
    """
    schema = T.StructType.fromDDL(ALERT_SCHEMA)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in both_spellings(schema).fields)
    messages = read_messages(spark, path, columns)
    return either_spelling(messages, schema, CORRUPT)


def dead_letters(messages: DataFrame, required: list[str]) -> DataFrame:
    """Messages that are malformed or lack a required key, safe to log."""
    lacking = F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    )
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").when(
        F.size(lacking) > 0, F.concat(F.lit("missing "), F.array_join(lacking, ","))
    )
    return messages.select(
        reason.alias("reason"), sanitize(F.col(CORRUPT)).alias("raw"), *required
    ).where(F.col("reason").isNotNull())


def trigger_stream(spark: SparkSession, path: str) -> DataFrame:
    """Stream of data-entry triggers whose flag is set."""
    triggers = read_messages(spark, path, TRIGGER_SCHEMA)
    return triggers.where(F.col(CORRUPT).isNull() & (F.col("flag") == "1")).drop(CORRUPT)


def triggered_rows(source: DataFrame, triggers: DataFrame) -> DataFrame:
    """Source rows of the triggered records."""
    return only_keys(source, F.col(RECORD), triggers.select(RECORD))


def per_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    """Writer that gives every micro-batch to `handle`."""
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)


def run_available(writer: DataStreamWriter, idle: bool = True) -> None:
    """Process what has landed and stop.

    `idle`: also run batches without new rows, which timers and watermarks wait for. State that
    expires by the clock (`once_within`) would ask for them without end.
    """
    conf = SparkSession.active().conf
    before = conf.get(IDLE_BATCHES)
    conf.set(IDLE_BATCHES, str(idle).lower())
    try:
        query = writer.trigger(availableNow=True).start()
    finally:
        conf.set(IDLE_BATCHES, before)
    query.awaitTermination()


def run_every(writer: DataStreamWriter, interval: str = "1 minute") -> StreamingQuery:
    """Process continuously, one micro-batch per interval."""
    return writer.trigger(processingTime=interval).start()


def run_until_done(writer: DataStreamWriter, interval: str = "1 minute", land: Sequence[Callable[[], None]] = ()) -> None:
    """Run by intervals until all that landed is processed, then stop.

    `land`: what lands next, each once the query has caught up with what was there before.
    """
    query = run_every(writer, interval)
    try:
        query.processAllAvailable()
        for more in land:
            more()
            query.processAllAvailable()
    finally:
        query.stop()


def write_batch(rows: DataFrame, path: str, batch: int) -> None:
    """Write a micro-batch to its own folder, so that a repeated batch replaces itself."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def coded_batch(alerts: DataFrame, dictionary: DataFrame, context: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Coded rows of a batch of alerts, and ``record, field_name, value, reason`` of what can't be pushed."""
    coded, rejected = split_alerts(parsed_alerts(alerts), dictionary, context)
    malformed = alerts.where(F.col(CORRUPT).isNotNull()) if CORRUPT in alerts.columns else alerts.limit(0)
    raw = sanitize(F.col(CORRUPT)) if CORRUPT in alerts.columns else F.lit(None).cast("string")
    nothing = F.lit(None).cast("string")
    unreadable = rejected_alerts(alerts).select(
        F.col("secretId").alias("record"), nothing.alias("field_name"), sanitize(F.col("message")).alias("value"), F.lit("unreadable").alias("reason")
    )
    broken = malformed.select(nothing.alias("record"), nothing.alias("field_name"), raw.alias("value"), F.lit("malformed").alias("reason"))
    return coded, rejected.unionByName(unreadable).unionByName(broken)


def alert_merger(
    dictionary: DataFrame,
    context: DataFrame,
    table: BucketedTable,
    keys: bool = True,
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
) -> Callable[[DataFrame, int], None]:
    """Handler that merges the coded alerts of a batch into a long table.

    The batch is a run of the table's journal, under its number: a later answer for a key takes
    the place of an earlier one, and a batch that is repeated after its commit changes nothing,
    whenever the failure came. Rejected messages (``rejected``) and the keys of what was handled
    (``ledger``, from ``cache_key``) are outputs of the same run.
    """
    journal = table.journal

    def handle(batch: DataFrame, number: int) -> None:
        run, now = f"batch-{number}", clock()
        if journal.committed(run):
            return
        held = batch.persist()
        try:
            coded, rejected = coded_batch(held, dictionary, context)
            writes = {table.name: table.push(coded), "rejected": Output(journal, "rejected").write(rejected)}
            if keys and "cache_key" in held.columns:
                handled = entries(held.select("cache_key").dropna(), table.name, now, {BATCH: run})
                writes["ledger"] = Output(journal, "ledger").write(handled)
            journal.run(run, writes, now)
        finally:
            held.unpersist()

    return handle


def alert_handler(
    dictionary: DataFrame,
    context: DataFrame,
    out: str,
    ledger: Ledger | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
    dead: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Handler that codes the alerts of a batch and writes the rows to push.

    What cannot be pushed goes to `dead` (by default a folder beside `out`) with its reason:
    malformed messages, unreadable answers, unknown fields and unknown records. With a ledger, alerts seen within its time to live are left out. Entries name the batch
    that made them, so a batch repeated after a failure does not take its own for another's.
    """

    letters = dead or f"{out.rstrip('/')}-dead"

    def push(alerts: DataFrame, number: int) -> None:
        coded, rejected = coded_batch(alerts, dictionary, context)
        write_batch(coded, out, number)
        write_batch(rejected, letters, number)

    def handle(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            if ledger is None:
                push(held, number)
                return
            now, name = clock(), f"{out}#{number}"
            push(ledger.unprocessed(held, now, batch=name), number)
            ledger.mark(held.select("cache_key").dropna(), now, {BATCH: name})
        finally:
            held.unpersist()

    return handle


def trigger_handler(
    source: DataFrame, process: Callable[[DataFrame], DataFrame], out: str
) -> Callable[[DataFrame, int], None]:
    """Handler that processes the source rows of the records triggered in a batch."""

    def handle(batch: DataFrame, number: int) -> None:
        write_batch(process(triggered_rows(source, batch)), out, number)

    return handle


def wait_for_positives(
    rows: DataFrame,
    positives: DataFrame,
    key: str,
    rows_time: str,
    positives_time: str,
    wait: str = "15 seconds",
    delay: str = "15 seconds",
) -> DataFrame:
    """Rows, each once, with ``alert``: ``yes`` if their key is positive by the end of `wait`.

    On tables any earlier positive counts, so the first positive of a key decides: one aggregate,
    and one row of it for each row. A stream keeps state for the wait only (both sides get a
    watermark): rows come out ``no`` once the watermark shows that no positive can follow, and
    once for each positive within the wait. Earlier positives are in the target table by then;
    ``default_no`` reads them there.
    """
    if not rows.isStreaming:
        first = positives.groupBy(F.col(key).alias("_key")).agg(F.min(positives_time).alias("_positive"))
        known = rows.join(first, same_key(rows[key], first["_key"]), "left")
        in_time = F.col("_positive") <= F.col(rows_time) + F.expr(f"interval {wait}")
        return known.withColumn("alert", F.when(in_time, "yes").otherwise("no")).drop("_key", "_positive")
    rows, positives = rows.withWatermark(rows_time, delay), positives.withWatermark(positives_time, delay)
    flagged = positives.select(F.col(key).alias("_key"), F.col(positives_time).alias("_positive"))
    on = (
        (rows[key] == flagged["_key"])
        & (flagged["_positive"] >= rows[rows_time])
        & (flagged["_positive"] <= rows[rows_time] + F.expr(f"interval {wait}"))
    )
    joined = rows.join(flagged, on, "left_outer")
    return joined.withColumn("alert", F.when(F.col("_positive").isNotNull(), "yes").otherwise("no")).drop("_key", "_positive")


def wait_for_first_positive(
    rows: DataFrame,
    positives: DataFrame,
    key: str,
    rows_time: str,
    positives_time: str,
    wait: timedelta = timedelta(seconds=15),
    delay: str = "15 seconds",
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Streamed rows, each once, with ``alert``: ``yes`` if their key is positive by the end of `wait`.

    As on tables, any earlier positive counts. `earlier` (key and time) holds the positives of the
    target before the stream began. A row comes out ``yes`` as soon as that is known, else ``no``
    once the watermark has passed its wait. The state of a key is the time of its first positive
    and the rows that still wait.
    """
    span = int(wait.total_seconds() * 1_000_000)
    first = F.lit(None).cast("timestamp")
    if earlier is not None:
        known = earlier.toDF("_key", "_known").groupBy("_key").agg(F.min("_known").alias("_known"))
        rows, first = rows.join(known, rows[key] == known["_key"], "left"), F.col("_known")
    kind = rows.schema[key].dataType
    columns = [f for f in rows.schema.fields if f.name not in ("_key", "_known")]
    whole = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in columns]), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"})
    waiting = rows.withWatermark(rows_time, delay).select(
        F.col(key).alias("_key"), F.col(rows_time).alias("_time"), whole.alias("_row"), F.unix_micros(first).alias("_first")
    )
    seen = positives.withWatermark(positives_time, delay).select(
        F.col(key).cast(kind).alias("_key"), F.col(positives_time).alias("_time"), F.lit(None).cast("string").alias("_row"), F.unix_micros(F.col(positives_time)).alias("_first")
    )
    both = waiting.unionByName(seen).withColumn("_at", F.unix_micros("_time"))

    def decide(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        least, times, texts = state.get if state.exists else (None, [], [])
        times, texts = list(times), list(texts)
        for batch in batches:
            found = batch["_first"].min()
            if found == found and (least is None or found < least):
                least = int(found)
            there = batch[batch["_row"].notna()]
            times += there["_at"].tolist()
            texts += there["_row"].tolist()
        done, left = {"_row": [], "alert": []}, ([], [])
        passed = state.getCurrentWatermarkMs() * 1000
        for at, text in zip(times, texts):
            if least is not None and least <= at + span:
                done["_row"].append(text)
                done["alert"].append("yes")
            elif at + span < passed:
                done["_row"].append(text)
                done["alert"].append("no")
            else:
                left[0].append(at)
                left[1].append(text)
        if left[0] or least is not None:
            state.update((least, *left))
            if left[0]:
                state.setTimeoutTimestamp(max((min(left[0]) + span) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(done)

    decided = both.groupBy("_key").applyInPandasWithState(
        decide, "_row string, alert string", "first long, times array<long>, texts array<string>", "append", GroupStateTimeout.EventTimeTimeout
    )
    schema = T.StructType(columns)
    fields = F.from_json("_row", schema, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return decided.select(fields.alias("_fields"), "alert").select("_fields.*", "alert")


def once_within(stream: DataFrame, key: str, within: timedelta = timedelta(minutes=2)) -> DataFrame:
    """One row of a key, and none more until `within` has passed since that one was handled.

    This is the rule of the ledger (processing time, marked when first handled), with the marks in
    the stream's own state: they are committed with the batch, so a batch that is repeated after a
    failure gives its rows again, and expire there without a purge. Of several rows of a key in a
    batch the first to arrive is taken. Rows without a key all pass. Needs the state store on disk
    that `configure` sets; `run_available` takes it with ``idle=False``.
    """
    schema = stream.schema

    class Seen(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("seen", "seen boolean", ttlDurationMs=int(within.total_seconds() * 1000))

        def handleInputRows(self, _: tuple, rows: Iterator[pd.DataFrame], __) -> Iterator[pd.DataFrame]:  # noqa: N802
            first = None
            for batch in rows:
                if first is None and len(batch):
                    first = batch.head(1)
            if first is not None and not self.seen.exists():
                self.seen.update((True,))
                yield first

        def close(self) -> None:
            pass

    keyed = stream.where(F.col(key).isNotNull())
    once = keyed.groupBy(key).transformWithStateInPandas(Seen(), schema, "append", "ProcessingTime")
    return once.unionByName(stream.where(F.col(key).isNull()))


def suppress_repeats(stream: DataFrame, key: str, time: str, within: str = "2 minutes") -> DataFrame:
    """Drop repeats of a key by event time (`once_within` and the ledger go by processing time)."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark([key])
