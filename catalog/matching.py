"""Queries: identifier maps, events, splits, anti-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.base import (
    EVENT_EAV, ORDERS_FLAT, SNAPSHOT, day, event_eav, orders_flat, query, snapshot, table, text,
)
from recordflow.operators import dedup, keys, upsert
from recordflow.operators.reshape import wide_to_eav
from recordflow.schemas import RECORD


def _order_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Long orders; pending ones have no `mrn`."""
    wide = table(spark, sf, "orders").select(
        text("o_orderkey").alias("record"),
        text("o_orderkey").alias("record_id"),
        F.when(F.col("o_orderstatus") != "P", text("o_custkey")).alias("mrn"),
        F.col("o_orderstatus").alias("status"),
    )
    return wide_to_eav(wide, ["record"])


ORDER_FACTS = """
  SELECT CAST(o_orderkey AS VARCHAR) AS record, 'record_id' AS field_name, CAST(o_orderkey AS VARCHAR) AS value FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'mrn', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'status', o_orderstatus FROM orders
"""


@query(f"""
WITH eav AS ({ORDER_FACTS}), ids AS (SELECT record, value AS id FROM eav WHERE field_name = 'mrn')
SELECT coalesce(id, eav.record) AS record, field_name,
       CASE WHEN field_name = 'record_id' THEN coalesce(id, eav.record) ELSE value END AS value
FROM eav LEFT JOIN ids ON ids.record = eav.record
""")
def key_remap_keep(spark: SparkSession, sf: str) -> DataFrame:
    return keys.remap_to_field(_order_facts(spark, sf), "mrn", ["value"])


def _id_context(spark: SparkSession, sf: str) -> DataFrame:
    """Known IDs: customers outside one segment, their number with blanks around it."""
    return table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_name").alias("record"),
        F.lit("mrn").alias("field_name"),
        F.concat(F.lit(" "), text("c_custkey"), F.lit(" ")).alias("value"),
    )


def _order_owner(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", text("o_custkey").alias("record"))


@query("""
SELECT o_orderkey, c_name AS record FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment <> 'BUILDING'
""")
def key_remap_drop(spark: SparkSession, sf: str) -> DataFrame:
    return keys.map_ids_inner(_order_owner(spark, sf), keys.id_map(_id_context(spark, sf)))[0]


@query("""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS record FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
""")
def key_remap_unknown(spark: SparkSession, sf: str) -> DataFrame:
    return keys.map_ids_inner(_order_owner(spark, sf), keys.id_map(_id_context(spark, sf)))[1]


@query("""
SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS record
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment <> 'BUILDING'
""")
def key_remap_gate(spark: SparkSession, sf: str) -> DataFrame:
    return keys.map_ids_keep(_order_owner(spark, sf), keys.id_map(_id_context(spark, sf)), RECORD)


@query(f"""
WITH eav AS ({EVENT_EAV}),
     known AS (SELECT field_name, arg_min(redcap_event_name, event_id) AS event FROM eav
               WHERE field_name <> 'error' GROUP BY field_name)
SELECT record, field_name, value, event_id,
       coalesce(event, (SELECT arg_min(event, field_name) FROM known)) AS redcap_event_name
FROM eav LEFT JOIN known USING (field_name)
""")
def event_enrich(spark: SparkSession, sf: str) -> DataFrame:
    eav = event_eav(spark, sf)
    return keys.enrich_events(eav, eav.where("field_name <> 'error'"), ["event_id"])


@query(f"""
WITH eav AS ({EVENT_EAV})
SELECT field_name, arg_max(redcap_event_name, event_id) AS redcap_event_name FROM eav GROUP BY field_name
""")
def field_event(spark: SparkSession, sf: str) -> DataFrame:
    return keys.event_of_field(event_eav(spark, sf), ["event_id"])


def _form_events(spark: SparkSession, sf: str) -> DataFrame:
    return event_eav(spark, sf).select(
        F.concat("field_name", F.lit("_"), "record").alias("form"),
        F.col("redcap_event_name").alias("unique_event_name"),
        "event_id",
    )


FORM_EVENTS = f"""
  SELECT field_name || '_' || record AS form, redcap_event_name AS unique_event_name, event_id FROM ({EVENT_EAV})
"""


@query(f"SELECT form, arg_min(unique_event_name, event_id) AS unique_event_name FROM ({FORM_EVENTS}) GROUP BY form")
def form_event_first(spark: SparkSession, sf: str) -> DataFrame:
    return keys.event_of_form(_form_events(spark, sf), "first", ["event_id"])


@query(f"SELECT form, arg_max(unique_event_name, event_id) AS unique_event_name FROM ({FORM_EVENTS}) GROUP BY form")
def form_event_last(spark: SparkSession, sf: str) -> DataFrame:
    return keys.event_of_form(_form_events(spark, sf), "last", ["event_id"])


@query(f"""
WITH forms AS (SELECT CASE field_name WHEN 'view' THEN 'ra_alerts_parent' WHEN 'click' THEN 'other' ELSE field_name END AS form,
                      redcap_event_name, event_id FROM ({EVENT_EAV})),
     f AS (SELECT arg_min(redcap_event_name, event_id) AS e FROM forms WHERE form = 'ra_alerts_parent')
SELECT p_partkey, CASE WHEN p_size < 20 THEN 'scale_p' ELSE p_type END AS instrument,
       CASE WHEN p_size < 20 THEN (SELECT e FROM f) ELSE 'admin_arm_1' END AS redcap_event_name FROM part
""")
def alert_events(spark: SparkSession, sf: str) -> DataFrame:
    """Parent forms have an event, child forms fall back to the default."""
    form = (
        F.when(F.col("field_name") == "view", "ra_alerts_parent").when(F.col("field_name") == "click", "other")
        .otherwise(F.col("field_name"))
    )
    forms = event_eav(spark, sf).select(form.alias("form"), F.col("redcap_event_name").alias("unique_event_name"), "event_id")
    instruments = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") < 20, "scale_p").otherwise(F.col("p_type")).alias("instrument")
    )
    return keys.alert_events(instruments, keys.event_of_form(forms, "first", ["event_id"]))


def _splits(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers against the customers that have orders, under the number of their last order."""
    incoming = table(spark, sf, "customer").select(
        text("c_custkey").alias("record_id"), text("c_custkey").alias("mrn"), F.col("c_name").alias("email_consent")
    )
    target = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("record_id"), text("o_custkey").alias("mrn")
    )
    return keys.split_updates(incoming, target, order_by=["record_id"])


@query("""
SELECT max(o_orderkey) AS record_id, CAST(c_custkey AS VARCHAR) AS mrn, c_name AS email_consent
FROM customer JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' GROUP BY c_custkey, c_name
""")
def upsert_split_update(spark: SparkSession, sf: str) -> DataFrame:
    return _splits(spark, sf)[0]


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS record_id, CAST(c_custkey AS VARCHAR) AS mrn, c_name AS email_consent
FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE c_custkey = o_custkey AND o_orderstatus = 'F')
""")
def upsert_split_insert(spark: SparkSession, sf: str) -> DataFrame:
    return _splits(spark, sf)[1]


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS mrn, count(*) AS copies FROM orders WHERE o_orderstatus = 'F'
GROUP BY o_custkey HAVING count(*) > 1
""")
def upsert_split_repeated(spark: SparkSession, sf: str) -> DataFrame:
    return _splits(spark, sf)[2]


def _people(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All customers with addresses in mixed case, and the known ones of two segments."""
    customer = table(spark, sf, "customer")
    people = customer.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "MACHINERY", F.upper("c_name"))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit(" "))
        .otherwise(F.concat(F.lit(" "), "c_name"))
        .alias("resp_email"),
    )
    known = customer.where("c_mktsegment IN ('MACHINERY', 'BUILDING', 'FURNITURE')").select(
        F.col("c_custkey").alias("record"), F.lower("c_name").alias("resp_email")
    )
    return people, known


PEOPLE = """
  SELECT c_custkey, c_mktsegment, CASE c_mktsegment WHEN 'MACHINERY' THEN upper(c_name) WHEN 'BUILDING' THEN ' '
         ELSE ' ' || c_name END AS resp_email FROM customer
"""


@query(f"SELECT c_custkey, resp_email FROM ({PEOPLE}) WHERE c_mktsegment NOT IN ('MACHINERY', 'FURNITURE')")
def email_split_create(spark: SparkSession, sf: str) -> DataFrame:
    return keys.split_by_email(*_people(spark, sf), order_by=["record"])[0]


@query(f"""
SELECT c_custkey, resp_email, c_custkey AS record FROM ({PEOPLE}) WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE')
""")
def email_split_update(spark: SparkSession, sf: str) -> DataFrame:
    return keys.split_by_email(*_people(spark, sf), order_by=["record"])[1]


@query(f"""
SELECT c_custkey, resp_email, CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN CAST(c_custkey AS VARCHAR) END
  AS record FROM ({PEOPLE}) WHERE trim(resp_email) <> ''
""")
def email_link(spark: SparkSession, sf: str) -> DataFrame:
    people, known = _people(spark, sf)
    return keys.link_by_email(people, known.withColumn("record", text("record")), order_by=["record"])


@query(f"""
WITH new AS (SELECT record_id, status, price, day, priority, nullif(status, 'O') AS note FROM ({ORDERS_FLAT})),
     old AS (SELECT record_id, status, price, day, nullif(status, 'O') AS note FROM ({SNAPSHOT}))
SELECT * FROM new WHERE NOT EXISTS (
  SELECT 1 FROM old WHERE old.record_id = new.record_id AND old.status = new.status AND old.price = new.price
    AND old.day = new.day AND old.note IS NOT DISTINCT FROM new.note)
""")
def anti_all_columns(spark: SparkSession, sf: str) -> DataFrame:
    note = F.nullif(F.col("status"), F.lit("O"))
    new = orders_flat(spark, sf).drop("redcap_event_name").withColumn("note", note)
    old = snapshot(spark, sf).drop("redcap_event_name", "priority").withColumn("note", note)
    return keys.anti_all_columns(new, old)


@query(f"""
SELECT record_id, priority, CAST(day AS VARCHAR) AS day FROM ({ORDERS_FLAT})
WHERE status = 'O' AND priority <> '5-LOW'
""")
def exclude_completed(spark: SparkSession, sf: str) -> DataFrame:
    orders = orders_flat(spark, sf)
    rows = orders.where("status <> 'P'").select(
        "record_id", F.nullif(F.col("priority"), F.lit("5-LOW")).alias("priority"), "day"
    )
    return keys.exclude_completed(rows, orders.where("status = 'F'").select("record_id"))


def _sendable(spark: SparkSession, sf: str) -> DataFrame:
    """Long orders: an `mrn` and a status row each, in an event."""
    wide = table(spark, sf, "orders").select(
        text("o_orderkey").alias("record"),
        F.concat(F.lit("event_"), "o_orderstatus").alias("redcap_event_name"),
        text("o_orderkey").alias("mrn"),
        F.lit("1").alias("enrollment_complete"),
    )
    return wide_to_eav(wide, ["record", "redcap_event_name"])


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS record, 'enrollment_complete' AS field_name, '2' AS value,
       'event_P' AS redcap_event_name
FROM orders WHERE o_orderstatus = 'O'
""")
def writeback(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    sent = orders.where("o_orderstatus IN ('O', 'F')").select(text("o_orderkey"))
    failed = orders.where("o_orderstatus <> 'O'").select(text("o_orderkey"))
    return keys.write_back(
        _sendable(spark, sf), sent, failed, "enrollment_complete", "2", order_by=["redcap_event_name"]
    )


def _pushed(spark: SparkSession, sf: str) -> DataFrame:
    """Pushed keys: all customers that ordered, and the suppliers' names, which no source has."""
    return (
        table(spark, sf, "orders").select(text("o_custkey").alias("record"))
        .unionByName(table(spark, sf, "supplier").select(F.col("s_name").alias("record")))
    )


BACK_MAP = """
  SELECT CAST(o_custkey AS VARCHAR) AS pushed_key,
         CAST(max(o_orderkey) FILTER (o_orderstatus <> 'P') AS VARCHAR) AS source_record FROM orders GROUP BY o_custkey
  UNION ALL SELECT s_name, NULL FROM supplier
"""


def _back_mapped(spark: SparkSession, sf: str) -> DataFrame:
    facts = _order_facts(spark, sf).withColumn("number", F.col("record").cast("bigint"))
    return keys.back_map(_pushed(spark, sf), facts, "mrn", ["number"])


@query(BACK_MAP)
def back_map(spark: SparkSession, sf: str) -> DataFrame:
    return _back_mapped(spark, sf)


@query(f"SELECT count(*) AS pushed, count(source_record) AS found, count(*) = count(source_record) AS consistent FROM ({BACK_MAP})")
def back_map_check(spark: SparkSession, sf: str) -> DataFrame:
    return keys.back_map_check(_back_mapped(spark, sf))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS record, 'event_' || o_orderstatus AS redcap_event_name,
       'intake_ready' AS field_name, '2' AS value FROM orders WHERE o_orderstatus <> 'P'
""")
def status_rows(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "orders").select(
        text("o_orderkey").alias("record"), F.concat(F.lit("event_"), "o_orderstatus").alias("redcap_event_name")
    )
    done = _order_facts(spark, sf).where("field_name = 'mrn'")
    return upsert.status_rows(done, events, "intake_ready", "2")


@query("""
SELECT c_custkey, c_nationkey, CAST(s.key AS VARCHAR) AS record_id FROM customer
JOIN (SELECT s_nationkey, min(s_suppkey) AS key FROM supplier GROUP BY s_nationkey) s ON c_nationkey = s_nationkey
""")
def secondary_lookup(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    context = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("r_id"), F.col("s_suppkey").alias("id"))
    return keys.lookup_by_secondary(
        customer, context.withColumn("c_nationkey", F.col("r_id")), "c_nationkey", "id", "record_id", ["id"]
    )


def _answers(spark: SparkSession, sf: str, kind: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf, "events")
    invited = events.select(F.col("user_id").alias("respondent_id")).distinct()
    answers = events.where((F.col("event_type") == kind) & (F.col("value") > 100)).select(
        F.col("user_id").alias("respondent_id"), text("event_id").alias("answer")
    )
    return invited, answers


@query("""
SELECT user_id AS respondent_id, CAST(event_id AS VARCHAR) AS answer FROM events
WHERE event_type = 'purchase' AND value > 100
""")
def answered_only(spark: SparkSession, sf: str) -> DataFrame:
    return keys.answered_only(*_answers(spark, sf, "purchase"))


@query("SELECT DISTINCT user_id AS respondent_id, CAST(NULL AS VARCHAR) AS answer FROM events")
def answered_none(spark: SparkSession, sf: str) -> DataFrame:
    return keys.answered_only(*_answers(spark, sf, "reply"))


@query("""
SELECT i.respondent_id, CAST(event_id AS VARCHAR) AS answer
FROM (SELECT DISTINCT user_id AS respondent_id FROM events) i
LEFT JOIN events ON user_id = respondent_id AND event_type = 'purchase' AND value > 100
""")
def answered_or_open(spark: SparkSession, sf: str) -> DataFrame:
    return keys.answered_only(*_answers(spark, sf, "purchase"), keep_unanswered=True)


def _tracked(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf, "events")
    eav = events.select(
        "event_id",
        F.concat("event_type", F.when(F.col("value") > 50, "_14_complete").otherwise("_complete")).alias("field_name"),
    )
    dictionary = events.where("event_type <> 'error'").select(
        F.concat("event_type", F.lit("_received")).alias("field_name")
    )
    return keys.tracked_rename(eav, dictionary)


@query("SELECT event_id, event_type || '_received' AS field_name FROM events WHERE event_type <> 'error'")
def tracked_rename(spark: SparkSession, sf: str) -> DataFrame:
    return _tracked(spark, sf)[0]


@query("""
SELECT event_id, event_type || CASE WHEN value > 50 THEN '_14_complete' ELSE '_complete' END AS field_name
FROM events WHERE event_type = 'error'
""")
def tracked_unknown(spark: SparkSession, sf: str) -> DataFrame:
    return _tracked(spark, sf)[1]


@query("""
SELECT key, 'both' AS side FROM (SELECT c_custkey AS key FROM customer INTERSECT SELECT o_custkey FROM orders)
UNION ALL
SELECT key, 'left_only' FROM (SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders)
""")
def key_set_ops(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.key_sets(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("key")),
        table(spark, sf, "orders").select(F.col("o_custkey").alias("key")),
    )
