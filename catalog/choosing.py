"""Queries: first/last choices, hashes, summaries, repeat instances, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.base import (
    EVENT_EAV, INTAKE_EAV, MONEY, ORDERS_FLAT, SNAPSHOT, event_eav, hash_sql, intake_eav, money, orders_flat,
    query, snapshot, table, text,
)
from recordflow.operators import dedup, ledger, upsert
from recordflow.operators.reshape import wide_to_eav
from recordflow.session import shared_dir
from recordflow.sources.folder_hash import FolderHash
from recordflow.sources.journal import Journal, Output
from recordflow.sources.row_index import RowHashIndex


@query(f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY record ORDER BY value, event_id) AS rn
  FROM (SELECT record, nullif(value, '50.00') AS value, event_id FROM ({EVENT_EAV}))) WHERE rn = 1
""")
def keep_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_eav(spark, sf).select("record", F.nullif(F.col("value"), F.lit("50.00")).alias("value"), "event_id")
    return dedup.keep_one(rows, ["record"], ["value", "event_id"])


@query("""
SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id
""")
def keep_last(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return dedup.keep_one(events, ["user_id"], ["ts"], keep="last").drop("ts")


@query("SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus").distinct()


CHANGED_ROWS = f"""
WITH new AS ({ORDERS_FLAT}), old AS ({SNAPSHOT})
SELECT new.* FROM new LEFT JOIN old USING (record_id, redcap_event_name)
WHERE old.price IS NULL OR md5(concat_ws('|', new.day, new.price, new.priority, new.status))
                        <> md5(concat_ws('|', old.day, old.price, old.priority, old.status))
"""


@query(CHANGED_ROWS)
def changed_rows(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.changed_rows(
        orders_flat(spark, sf), snapshot(spark, sf), ["record_id", "redcap_event_name"]
    )


@query(CHANGED_ROWS)
def changed_rows_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot's hashes are kept in an index; orders come in two parts and once more as a whole.

    Each run writes the rows that changed and adds their hashes; the index is compacted in between.
    """
    orders, old, keys = orders_flat(spark, sf), snapshot(spark, sf), ["record_id", "redcap_event_name"]
    journal, as_of = Journal(spark, shared_dir(spark, "index")), "2024-01-01T00:00:00"
    index, pushed = RowHashIndex(journal, "hashes", orders.schema, keys, 8), Output(journal, "pushed")
    journal.run("before", {index.name: index.update(old)}, as_of)
    first = F.crc32(F.col("record_id").cast("binary")) % 2 == 0
    for number, part in enumerate((orders.where(first), orders.where(~first), orders)):
        journal.run(f"run-{number}", index.push(pushed, part), as_of)
        if number == 0:
            index.compact("compact", as_of)
    return pushed.read(orders.schema)


_FLAT = ["record_id", "redcap_event_name", "status", "price", "day", "priority"]


@query(f"SELECT count(*) AS row_count, {hash_sql(_FLAT)} AS content_hash FROM ({ORDERS_FLAT})")
def table_hash(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.table_hash(orders_flat(spark, sf))


def _growing(spark: SparkSession, sf: str, by: tuple[str, ...] = ()) -> FolderHash:
    """The hash of orders that land in two parts, taken in after each."""
    orders, path = orders_flat(spark, sf), shared_dir(spark, "landed")
    state = FolderHash(Journal(spark, shared_dir(spark, "hashes")), "sums", path, orders.schema, by)
    first = F.crc32(F.col("record_id").cast("binary")) % 2 == 0
    for number, part in enumerate((first, ~first)):
        orders.where(part).write.mode("append").parquet(path)
        state.run(f"run-{number}", "2024-01-01T00:00:00")
    return state


@query(f"SELECT count(*) AS row_count, {hash_sql(_FLAT)} AS content_hash FROM ({ORDERS_FLAT})")
def table_hash_by_file(spark: SparkSession, sf: str) -> DataFrame:
    return _growing(spark, sf).read()


_REST = [c for c in _FLAT if c != "status"]
_GROUP_HASHES = f"SELECT status, count(*) AS row_count, {hash_sql(_REST)} AS content_hash FROM ({{}}) GROUP BY status"


def _groups(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders by status against a ledger that holds the state of the snapshot."""
    known = dedup.table_hash(snapshot(spark, sf), ["status"]).select(
        F.concat_ws(":", "status", "content_hash", text("row_count"))
    )
    log = ledger.entries(known, "load", "2024-01-01T00:00:00")
    return ledger.unchanged_groups(orders_flat(spark, sf), log, "load", "2024-01-01T00:00:30", "status", 2)


_KEYED = "SELECT *, status || ':' || content_hash || ':' || row_count AS cache_key FROM ({})"
_NEW, _OLD = _KEYED.format(_GROUP_HASHES.format(ORDERS_FLAT)), _KEYED.format(_GROUP_HASHES.format(SNAPSHOT))


@query(f"SELECT * FROM ({_NEW}) WHERE cache_key NOT IN (SELECT cache_key FROM ({_OLD}))")
def changed_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _groups(spark, sf)[0]


@query(f"SELECT * FROM ({_NEW}) WHERE cache_key IN (SELECT cache_key FROM ({_OLD}))")
def unchanged_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _groups(spark, sf)[1]


@query(f"SELECT * FROM ({_NEW}) WHERE cache_key NOT IN (SELECT cache_key FROM ({_OLD}))")
def changed_groups_by_file(spark: SparkSession, sf: str) -> DataFrame:
    """The new hashes come from sums kept per file."""
    known = dedup.table_hash(snapshot(spark, sf), ["status"]).select(F.concat_ws(":", "status", "content_hash", text("row_count")))
    log = ledger.entries(known, "load", "2024-01-01T00:00:00")
    return ledger.known_groups(_growing(spark, sf, ("status",)).read(), log, "load", "2024-01-01T00:00:30", "status", 2)[0]


def _alert_items(spark: SparkSession, sf: str) -> DataFrame:
    name = (
        F.when(F.col("event_type") == "view", F.lit("alerts_parent_base_line_1"))
        .when(F.col("event_type") == "signup", F.lit("mrn"))
        .when(F.col("event_type") == "click", F.lit("alerts_parent_click_2"))
        .otherwise(F.concat(F.lit("alerts_"), "event_type", F.lit("_"), text("event_id")))
    )
    return table(spark, sf, "events").select(
        text("user_id").alias("record"), name.alias("field_name"), money("value").alias("value"),
        F.concat(F.lit("day_"), F.date_format("ts", "dd")).alias("redcap_event_name"),
    )


ALERT_ITEMS = f"""
  SELECT CAST(user_id AS VARCHAR) AS record,
         CASE event_type WHEN 'view' THEN 'alerts_parent_base_line_1' WHEN 'signup' THEN 'mrn'
              WHEN 'click' THEN 'alerts_parent_click_2' ELSE 'alerts_' || event_type || '_' || event_id END AS field_name,
         {MONEY.format('value')} AS value, 'day_' || strftime(ts, '%d') AS redcap_event_name FROM events
"""


@query(f"""
WITH items AS ({ALERT_ITEMS}),
     flags AS (SELECT DISTINCT record, nullif(regexp_extract(field_name, 'alerts_([^_]+(?:_[^_]+)?)_\\d+', 1), '') AS i,
                      redcap_event_name FROM items)
SELECT * FROM items UNION ALL SELECT record, i || '_alerts', 'yes', redcap_event_name FROM flags WHERE i IS NOT NULL
""")
def summary_flags(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.summary_flags(_alert_items(spark, sf))


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("instrument"))
        .agg(F.count("*").alias("rows"))
        .withColumn("ok", F.col("instrument").endswith("HIGH") | F.col("instrument").endswith("LOW"))
    )


@query("""
WITH o AS (SELECT o_orderpriority AS i, count(*) AS n, suffix(o_orderpriority, 'HIGH') OR suffix(o_orderpriority, 'LOW')
           AS ok FROM orders GROUP BY o_orderpriority),
     s AS (SELECT CAST(sum(n) FILTER (ok) AS BIGINT) AS a, count(*) FILTER (NOT ok) AS b,
                  string_agg(i, ',' ORDER BY i) FILTER (NOT ok) AS failed FROM o)
SELECT 'failure' AS status, a AS successes, b AS failures, failed,
       '{"status":"failure","successes":' || a || ',"failures":' || b || '}' AS exit_line FROM s
""")
def run_results(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.run_results(_outcomes(spark, sf))


@query("""
SELECT string_agg(DISTINCT event_type, ',' ORDER BY event_type) FILTER (event_type IN ('view', 'click')) AS names,
       count(DISTINCT CASE WHEN event_type IN ('view', 'click') THEN event_type END) AS instruments,
       count(DISTINCT user_id) AS records FROM events
""")
def tracking_report(spark: SparkSession, sf: str) -> DataFrame:
    marked = F.when(F.col("event_type").isin("view", "click"), "_received").otherwise("_complete")
    return dedup.tracking_report(
        table(spark, sf, "events").select(
            F.col("user_id").alias("record"), F.concat("event_type", marked).alias("field_name")
        )
    )


@query("SELECT l_returnflag, count(*) AS row_count FROM lineitem GROUP BY l_returnflag")
def rows_per_instrument(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.rows_per(table(spark, sf, "lineitem"), "l_returnflag")


@query("SELECT DISTINCT CAST(nullif(p_size, 7) AS VARCHAR) AS raw_value FROM part WHERE p_size <> 7")
def raw_values(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").withColumn("p_size", F.nullif(F.col("p_size"), F.lit(7)))
    return dedup.distinct_values(part, "p_size")


# ---------------------------------------------------------------- repeat instances


LATEST = """
  SELECT record, field_name, value, redcap_event_name FROM (
    SELECT *, max(redcap_repeat_instance) OVER (PARTITION BY record, redcap_repeat_instrument) AS newest FROM {0})
  WHERE redcap_repeat_instance = newest
  UNION ALL
  SELECT record, field_name, value, redcap_event_name FROM (
    SELECT *, row_number() OVER (PARTITION BY record, field_name ORDER BY value, redcap_event_name) AS rn
    FROM {0} WHERE redcap_repeat_instance IS NULL)
  WHERE rn = 1
"""


@query(f"WITH eav AS ({INTAKE_EAV}) {LATEST.format('eav')}")
def latest_instance(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest_instance(intake_eav(spark, sf), ["value", "redcap_event_name"])


def _participants(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("record"), "o_orderkey", F.col("c_mktsegment").alias("resp_email")
    )


@query("""
WITH old AS (SELECT o_custkey AS record, max(date_part('month', o_orderdate)) AS highest FROM orders
             WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT o_custkey AS record, o_orderkey, c_mktsegment AS resp_email, CAST(coalesce(highest, 0)
       + row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS redcap_repeat_instance
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN old ON old.record = o_custkey
""")
def next_instance(spark: SparkSession, sf: str) -> DataFrame:
    existing = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("record"), F.month("o_orderdate").alias("redcap_repeat_instance")
    )
    return dedup.next_instance(_participants(spark, sf), existing, ["o_orderkey"])


@query("""
SELECT o_custkey AS record, o_orderkey, c_mktsegment AS resp_email, CAST(
       row_number() OVER (PARTITION BY c_mktsegment ORDER BY o_orderkey) AS INTEGER) AS redcap_repeat_instance
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def next_instance_by_email(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.next_instance(_participants(spark, sf), None, ["o_orderkey"])


# ---------------------------------------------------------------- upserts


def _facts(flat: DataFrame) -> DataFrame:
    return wide_to_eav(flat.withColumnRenamed("record_id", "record"), ["record", "redcap_event_name"])


def _facts_sql(flat: str) -> str:
    return " UNION ALL ".join(
        f"SELECT record_id AS record, redcap_event_name, '{c}' AS field_name, {c} AS value FROM ({flat})"
        for c in ("status", "price", "day", "priority")
    )


@query(f"""
WITH old AS ({_facts_sql(SNAPSHOT)}),
     new AS (SELECT record, redcap_event_name, field_name, CASE WHEN value = '5-LOW' THEN '' ELSE value END AS value
             FROM ({_facts_sql(ORDERS_FLAT)}) WHERE field_name <> 'day'),
     filled AS (SELECT * FROM new WHERE value <> '')
SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM filled f WHERE f.record = old.record AND f.field_name = old.field_name
                                    AND f.redcap_event_name = old.redcap_event_name)
UNION ALL SELECT * FROM filled
""")
def eav_upsert(spark: SparkSession, sf: str) -> DataFrame:
    blank = F.when(F.col("value") == "5-LOW", "").otherwise(F.col("value"))
    new = _facts(orders_flat(spark, sf)).where("field_name <> 'day'").withColumn("value", blank)
    return upsert.eav_upsert(_facts(snapshot(spark, sf)), new)


@query(f"""
WITH old AS (SELECT * EXCLUDE (priority) FROM ({SNAPSHOT})),
     new AS (SELECT record_id, redcap_event_name, CASE WHEN status = 'F' THEN '' ELSE price END AS price, priority
             FROM ({ORDERS_FLAT}) WHERE status <> 'O' OR priority <> '1-URGENT')
SELECT record_id, redcap_event_name, old.status, coalesce(nullif(new.price, ''), old.price) AS price, old.day, new.priority
FROM old FULL JOIN new USING (record_id, redcap_event_name)
""")
def flat_upsert(spark: SparkSession, sf: str) -> DataFrame:
    new = orders_flat(spark, sf).where("status <> 'O' OR priority <> '1-URGENT'").select(
        "record_id", "redcap_event_name",
        F.when(F.col("status") == "F", "").otherwise(F.col("price")).alias("price"), "priority",
    )
    return upsert.flat_upsert(snapshot(spark, sf).drop("priority"), new, ["record_id", "redcap_event_name"])


@query("""
SELECT c_name, c_custkey, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY c_name, c_custkey) AS record_id
FROM customer
""")
def autonumber(spark: SparkSession, sf: str) -> DataFrame:
    target = table(spark, sf, "orders").select(text("o_orderkey").alias("record_id"))
    return upsert.auto_number(table(spark, sf, "customer").select("c_name", "c_custkey"), target, ["c_name", "c_custkey"])


@query("""
WITH top AS (SELECT max(c_custkey) AS n FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT c_custkey AS record_id, c_custkey AS mrn, upper(c_name) AS name FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL
SELECT n + row_number() OVER (ORDER BY c_custkey), c_custkey, upper(c_name) FROM customer, top WHERE c_mktsegment = 'BUILDING'
""")
def insert_or_update(spark: SparkSession, sf: str) -> DataFrame:
    known = F.col("c_mktsegment") != "BUILDING"
    customer = table(spark, sf, "customer")
    named = customer.select(
        F.col("c_custkey").alias("record_id"), F.col("c_custkey").alias("mrn"), F.upper("c_name").alias("name"), "c_mktsegment"
    )
    target = customer.where(known).select(
        F.col("c_custkey").alias("record_id"), F.col("c_custkey").alias("mrn"), F.col("c_name").alias("name")
    )
    return upsert.insert_or_update(
        target, named.where(known).drop("c_mktsegment"), named.where(~known).drop("c_mktsegment"), ["mrn"]
    )
