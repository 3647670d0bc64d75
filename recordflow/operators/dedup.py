"""First/last choices, content hashes, instances, numbering, set operations.

A table has no row order, so whatever picks a first or last row takes ``order_by``. Without it
the smallest value is the first and the largest the last, which needs no sort columns in the
shuffle; `keep_one`, which picks whole rows, orders by all columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordflow.operators.joins import same_key
from recordflow.schemas import EVENT, FIELD, INSTANCE, INSTRUMENT, RECORD, VALUE
from recordflow.session import shared_dir


def row_order(columns: Sequence[str]) -> Column:
    """Sort key of a row."""
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def first_of(value: str | Column, order_by: Sequence[str] | None, among: Column | None = None) -> Column:
    """Aggregate: the first value in order, of all rows or of those where `among` holds."""
    return _pick(F.min, F.min_by, value, order_by, among)


def last_of(value: str | Column, order_by: Sequence[str] | None, among: Column | None = None) -> Column:
    """Aggregate: the last value in order, of all rows or of those where `among` holds."""
    if order_by and isinstance(value, str) and value == order_by[0]:
        order_by = None  # ordered by itself first, the last value is the largest
    return _pick(F.max, F.max_by, value, order_by, among)


def _pick(plain, by, value, order_by, among) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    if not order_by:
        return plain(value if among is None else F.when(among, value))
    order = row_order(order_by)
    return by(value, order if among is None else F.when(among, order))


def keep_one(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str] | None = None,
    keep: str = "first",
) -> DataFrame:
    """One row per key, the first or last in order; nulls sort last.

    Ranking to the first row lets Spark cut every task to one row per key before the shuffle
    (``WindowGroupLimit``), so a key with a third of all rows costs no more than another.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in (order_by or df.columns)]
    ordering = [c.asc_nulls_last() if keep == "first" else c.desc_nulls_first() for c in columns]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_value(eav: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """First non-null value per record and field."""
    held = eav.where(F.col(VALUE).isNotNull())
    return held.groupBy(RECORD, FIELD).agg(first_of(VALUE, order_by).alias(VALUE))


# ---------------------------------------------------------------- content hashes


def cells_text(cells: Sequence[Column]) -> Column:
    """Cells as one text for hashing, each with its length, so that no two rows read alike."""
    texts = [cell.cast("string") for cell in cells]
    return F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts])


def row_text(columns: Sequence[str]) -> Column:
    """Rows as text for hashing; a null differs from every text."""
    return cells_text([F.col(f"`{c}`") for c in columns])


def changed_rows(
    incoming: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Incoming rows that are new or differ from the existing row of the same key.

    The existing side is cast to the incoming types first; of several existing rows with one
    key the last in order counts (without an order, one of them).
    """
    columns = sorted(columns or [c for c in incoming.columns if c not in keys])
    types = {f.name: f.dataType for f in incoming.schema.fields}
    known = existing.select(
        *[F.col(f"`{k}`").cast(types[k]).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.md5(cells_text([F.col(f"`{c}`").cast(types[c]) for c in columns])).alias("_known"),
        *[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order_by or ())],
    )
    known = known.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(
        last_of("_known", [f"_o{i}" for i in range(len(order_by or ()))]).alias("_known")
    )
    hashed = incoming.withColumn("_hash", F.md5(row_text(columns)))
    same = hashed["_hash"] == known["_known"]
    for i, key in enumerate(keys):
        same = same & hashed[key].eqNullSafe(known[f"_k{i}"])
    return hashed.join(known, same, "left_anti").drop("_hash")


def table_hash(df: DataFrame, by: Sequence[str] = (), length: int = 12) -> DataFrame:
    """Content hash of a table (per group), independent of row order.

    Row hashes are added up, so every task reduces its rows to one number and nothing is
    collected; the row count takes part, and a repeated row counts twice.
    """
    return _hash_of(hash_sums(df, by), by, length)


def hash_sums(df: DataFrame, by: Sequence[str] = (), apart: Sequence[str] = ()) -> DataFrame:
    """What a content hash is made of: ``row_count, row_sum`` (per group, and per value of `apart`).

    Sums of parts of a table add up to those of the whole (`merged_hash`).
    """
    columns = sorted(c for c in df.columns if c not in (*by, *apart))
    digits = F.conv(F.substring(F.md5(row_text(columns)), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.groupBy(*by, *apart).agg(F.count("*").alias("row_count"), F.sum(digits).alias("row_sum"))


def merged_hash(sums: DataFrame, by: Sequence[str] = (), length: int = 12) -> DataFrame:
    """Content hash of the table whose parts have these sums; the same as `table_hash` of the whole."""
    whole = sums.where("row_count > 0").groupBy(*by).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), F.sum("row_sum").alias("row_sum")
    )
    return _hash_of(whole, by, length)


def _hash_of(sums: DataFrame, by: Sequence[str], length: int) -> DataFrame:
    text = F.concat_ws(":", F.col("row_count").cast("string"), F.col("row_sum").cast("string"))
    return sums.select(*by, "row_count", F.substring(F.md5(text), 1, length).alias("content_hash"))


# ---------------------------------------------------------------- summaries

# Fixed value: which part of an alert field names the instrument (one or two words).
ALERT_INSTRUMENT = r"alerts_([^_]+(?:_[^_]+)?)_\d+"


def summary_flags(eav: DataFrame) -> DataFrame:
    """The rows plus one ``<instrument>_alerts = yes`` row per record, instrument and event."""
    instrument = F.nullif(F.regexp_extract(FIELD, ALERT_INSTRUMENT, 1), F.lit(""))
    flags = (
        eav.select(RECORD, instrument.alias("_instrument"), EVENT)
        .where(F.col("_instrument").isNotNull())
        .select(
            RECORD,
            F.concat("_instrument", F.lit("_alerts")).alias(FIELD),
            F.lit("yes").alias(VALUE),
            EVENT,
        )
        .distinct()
    )
    return eav.unionByName(flags, allowMissingColumns=True)


def run_results(outcomes: DataFrame) -> DataFrame:
    """Run report from ``instrument, rows, ok``: successes, failures, status, JSON line."""
    counts = outcomes.agg(
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("rows"))), F.lit(0)).cast("long").alias("successes"),
        F.count_if(~F.col("ok")).alias("failures"),
        # Instruments are as many as the data dictionary has forms.
        F.array_sort(F.collect_set(F.when(~F.col("ok"), F.col("instrument")))).alias("failed"),
    )
    status = (
        F.when(F.col("failures") > 0, "failure")
        .when(F.col("successes") == 0, "no data")
        .otherwise("success")
    )
    return counts.select(
        status.alias("status"),
        "successes",
        "failures",
        F.array_join("failed", ",").alias("failed"),
    ).withColumn("exit_line", F.to_json(F.struct("status", "successes", "failures")))


def tracking_report(eav: DataFrame, suffix: str = "_received") -> DataFrame:
    """Instruments marked (as many as the dictionary has forms) and distinct records."""
    name = F.substring(F.col(FIELD), F.lit(1), F.length(FIELD) - len(suffix))
    instrument = F.when(F.col(FIELD).endswith(suffix), name)
    return eav.agg(
        F.array_join(F.array_sort(F.collect_set(instrument)), ",").alias("names"),
        F.count_distinct(instrument).alias("instruments"),
        F.count_distinct(RECORD).alias("records"),
    )


def rows_per(df: DataFrame, key: str) -> DataFrame:
    """Row count per value of a column."""
    return df.groupBy(key).agg(F.count("*").alias("row_count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values as text."""
    return df.select(F.col(f"`{column}`").cast("string").alias("raw_value")).dropna().distinct()


# ---------------------------------------------------------------- repeat instances


def latest_instance(eav: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """All rows of the latest instance per record and instrument; other rows once per field.

    The maximum comes from a map-side-combined aggregate joined back, not from a window over
    the whole group: a group may hold a large part of the table, and a join on it can be split.
    """
    repeated = eav.where(F.col(INSTANCE).isNotNull())
    latest = (
        repeated.groupBy(RECORD, INSTRUMENT)
        .agg(F.max(INSTANCE).alias("_latest"))
        .select(F.col(RECORD).alias("_record"), F.col(INSTRUMENT).alias("_instrument"), "_latest")
    )
    newest = repeated.join(
        latest,
        repeated[RECORD].eqNullSafe(latest["_record"])
        & repeated[INSTRUMENT].eqNullSafe(latest["_instrument"])
        & (repeated[INSTANCE] == latest["_latest"]),
        "left_semi",
    )
    single = keep_one(eav.where(F.col(INSTANCE).isNull()), [RECORD, FIELD], order_by)
    return single.unionByName(newest).drop(INSTRUMENT, INSTANCE)


PLACE_BITS = 33  # of the number that monotonically_increasing_id gives, those for the place in a partition


def running_number(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str = "number"
) -> DataFrame:
    """Number the rows of every key from 1 in order, also where one key holds most rows.

    The rows are cut into ordered chunks by key and order (range partitions, as many as the
    session shuffles into) and written once to the shared folder with their chunk and place. The
    input is computed twice, for Spark to sample the cuts and to write. A chunk is numbered on
    its own, and what a key has in later chunks is shifted by its rows in the earlier ones.
    """
    spark = df.sparkSession
    ordered = [F.col(f"`{c}`").asc() for c in (*keys, *order_by)]
    placed = df.repartitionByRange(*ordered).sortWithinPartitions(*ordered).withColumn("_place", F.monotonically_increasing_id())
    path = shared_dir(spark, "numbered")
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path).withColumn("_chunk", F.shiftright("_place", PLACE_BITS))
    sizes = rows.groupBy(*keys, "_chunk").agg(F.count("*").alias("_size"))
    # One row per chunk, or per chunk and key that continues from the chunk before: as few as chunks.
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.sum("_size").over(earlier)).where("_offset IS NOT NULL").select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_chunk").alias("_c"), "_offset"
    )
    if keys:
        order = [F.col(f"`{c}`").asc() for c in order_by]
        numbered = rows.withColumn("_local", F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(*order)))
    else:
        numbered = rows.withColumn("_local", F.col("_place").bitwiseAND((1 << PLACE_BITS) - 1) + 1)
    on = numbered["_chunk"] == offsets["_c"]
    for i, key in enumerate(keys):
        on = on & numbered[f"`{key}`"].eqNullSafe(offsets[f"_k{i}"])
    shifted = F.col("_local") + F.coalesce("_offset", F.lit(0))
    return numbered.join(F.broadcast(offsets), on, "left").select(
        *[F.col(f"`{c}`") for c in df.columns], shifted.cast("long").alias(name)
    )


def next_instance(
    participants: DataFrame,
    existing: DataFrame | None,
    order_by: Sequence[str],
    key: str = RECORD,
    fallback_key: str = "resp_email",
) -> DataFrame:
    """Assign repeat instances: the existing maximum of the record plus a running count.

    Rows without a record are new people, who get a record each: they are counted by their e-mail
    address, upper and lower case and outer spaces aside.
    """
    if existing is None:
        numbered = running_number(participants, [fallback_key], order_by, "_n")
        return numbered.withColumn(INSTANCE, F.col("_n").cast("int")).drop("_n")
    highest = existing.groupBy(F.col(key).alias("_key")).agg(F.max(INSTANCE).alias("_highest"))
    person = F.coalesce(
        F.concat(F.lit("record "), F.col(key).cast("string")),
        F.concat(F.lit("address "), F.lower(F.trim(fallback_key))),
    )
    numbered = running_number(participants.withColumn("_person", person), ["_person"], order_by, "_n").drop("_person")
    return (
        numbered.join(highest, same_key(numbered[key], highest["_key"]), "left")
        .withColumn(INSTANCE, (F.col("_n") + F.coalesce("_highest", F.lit(0))).cast("int"))
        .drop("_key", "_highest", "_n")
    )


# ---------------------------------------------------------------- order and sets


def sort_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Global sort, nulls last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def union_rows(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; missing columns become null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def key_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct keys of two one-column frames, labelled ``both`` or ``left_only``."""
    return left.intersect(right).withColumn("side", F.lit("both")).unionByName(
        left.subtract(right).withColumn("side", F.lit("left_only"))
    )
