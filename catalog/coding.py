"""Queries: code lists, choice strings, rules per record, recodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.base import (
    AGE, AS_OF, INTAKE_EAV, MONEY, intake_eav, money, query, table, text,
)
from recordflow.functions.dates import age_years
from recordflow.operators import codes, dedup, select
from recordflow.plans import fixed_values as fixed
from recordflow.plans.intake import standard_rules

STATUS = select.CodeList("o_orderstatus", {"finished": "F", "open": "O", "pending": "P"})


@query(f"""
WITH eav AS ({INTAKE_EAV})
SELECT * FROM eav WHERE record IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus <> 'P')
""")
def flagged_records(spark: SparkSession, sf: str) -> DataFrame:
    return select.flagged_records(intake_eav(spark, sf), fixed.INTAKE_READY, "Ready to Send")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def flagged_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where(STATUS.matches("open")).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def status_filter(spark: SparkSession, sf: str) -> DataFrame:
    return select.has_status(table(spark, sf, "orders"), "o_orderpriority", "1-URGENT").select("o_orderkey", "o_custkey")


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'pending' END AS label,
       o_orderstatus AS code FROM orders
""")
def code_list(spark: SparkSession, sf: str) -> DataFrame:
    labelled = table(spark, sf, "orders").withColumn("label", STATUS.decode(F.col("o_orderstatus")))
    return labelled.select("o_orderkey", "label", STATUS.encode(F.col("label")).alias("code"))


@query("""
SELECT CASE WHEN event_type IN ('signup', 'purchase') THEN '625' ELSE '891' END AS target, count(*) AS row_count
FROM events GROUP BY 1
""")
def route_targets(spark: SparkSession, sf: str) -> DataFrame:
    instrument = F.concat(F.initcap("event_type"), F.lit("_redcap"))
    target = select.target_of(instrument, ["signup", "purch"], "625", "891")
    return dedup.rows_per(table(spark, sf, "events").select(target.alias("target")), "target")


@query("SELECT p_partkey, p_size >= 11 AND p_size < 18 AS closed_open, p_size > 11 AND p_size <= 18 AS open_closed FROM part")
def range_rule(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey",
        select.Range(11, 18, True, False).contains(size).alias("closed_open"),
        select.Range(11, 18, False, True).contains(size).alias("open_closed"),
    )


_DOB = "CASE WHEN o_orderstatus = 'P' THEN '2010' ELSE strftime(o_orderdate, '%Y-%m-%d') END"


@query(f"""
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus <> 'P' THEN {AGE.format("strftime(o_orderdate, '%Y-%m-%d')")} END AS VARCHAR)
  AS age FROM orders
""")
def age_in_years(spark: SparkSession, sf: str) -> DataFrame:
    dob = F.when(F.col("o_orderstatus") == "P", "2010").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select("o_orderkey", age_years(dob, AS_OF).cast("string").alias("age"))


# The rules of the intake job, as SQL over a long table `named`.
FACTS = f"""
  SELECT record, max(value) FILTER (field_name = 'guardian2_consent') AS guardian,
         max(value) FILTER (field_name = 'dob') AS dob,
         coalesce(bool_or(field_name = 'complete_parent_second_guardian_consent'), false) AS has_form,
         coalesce(bool_or(field_name = 'permission_audiovideo_participant'), false) AS has_permission
  FROM named GROUP BY record
"""
NEWS = f"""
  SELECT record, has_form, has_permission, CASE guardian WHEN '0' THEN '3' WHEN '3' THEN '4' END AS form,
         CASE WHEN {AGE.format('dob')} < 11 OR {AGE.format('dob')} >= 18 THEN '0' END AS permission FROM facts
"""
RULED = """
  SELECT record, field_name, CASE WHEN field_name = 'complete_parent_second_guardian_consent' AND form IS NOT NULL THEN form
              WHEN field_name = 'permission_audiovideo_participant' AND permission IS NOT NULL THEN permission
              ELSE value END AS value,
         redcap_event_name, redcap_repeat_instrument, redcap_repeat_instance
  FROM named LEFT JOIN news USING (record)
  UNION ALL SELECT record, 'complete_parent_second_guardian_consent', form, NULL, NULL, NULL FROM news
  WHERE form IS NOT NULL AND NOT has_form
  UNION ALL SELECT record, 'permission_audiovideo_participant', permission, NULL, NULL, NULL FROM news
  WHERE permission IS NOT NULL AND NOT has_permission
"""
_NAMED = f"""
  SELECT record, CASE field_name WHEN 'permission_audiovideo_1113' THEN 'permission_audiovideo_participant'
                      WHEN 'parent_second_guardian_consent_complete' THEN 'complete_parent_second_guardian_consent'
                      ELSE field_name END AS field_name, value, redcap_event_name, redcap_repeat_instrument,
         redcap_repeat_instance FROM ({INTAKE_EAV})
"""


def _named(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ("permission_audiovideo_1113", "parent_second_guardian_consent_complete")
    return select.rename_fields(intake_eav(spark, sf), {n: fixed.INTAKE_RENAMES[n] for n in wanted})


@query(f"""
WITH named AS ({_NAMED}), facts AS ({FACTS}), news AS (SELECT * REPLACE (NULL AS permission) FROM ({NEWS})) {RULED}
""")
def guardian_rule(spark: SparkSession, sf: str) -> DataFrame:
    return codes.apply_rules(_named(spark, sf), standard_rules(AS_OF)[:1], ["value"])


@query(f"""
WITH named AS ({_NAMED}), facts AS ({FACTS}), news AS (SELECT * REPLACE (NULL AS form) FROM ({NEWS})) {RULED}
""")
def age_rule(spark: SparkSession, sf: str) -> DataFrame:
    return codes.apply_rules(_named(spark, sf), standard_rules(AS_OF)[1:], ["value"])


@query(f"WITH named AS ({_NAMED}), facts AS ({FACTS}), news AS ({NEWS}) {RULED}")
def rules_together(spark: SparkSession, sf: str) -> DataFrame:
    return codes.apply_rules(_named(spark, sf), standard_rules(AS_OF), ["value"])


@query("""
SELECT record, field_name, CASE WHEN field_name = 'l_linenumber' THEN CAST(TRY_CAST(value AS INTEGER) - 1 AS VARCHAR)
                           ELSE value END AS value
FROM (SELECT l_orderkey AS record, 'l_linenumber' AS field_name, CAST(l_linenumber AS VARCHAR) AS value FROM lineitem
      UNION ALL SELECT l_orderkey, 'l_linenumber', l_returnflag FROM lineitem
      UNION ALL SELECT l_orderkey, 'l_partkey', CAST(l_partkey AS VARCHAR) FROM lineitem)
""")
def decrement_code(spark: SparkSession, sf: str) -> DataFrame:
    pairs = F.array(
        F.struct(F.lit("l_linenumber").alias("field_name"), text("l_linenumber").alias("value")),
        F.struct(F.lit("l_linenumber").alias("field_name"), F.col("l_returnflag").alias("value")),
        F.struct(F.lit("l_partkey").alias("field_name"), text("l_partkey").alias("value")),
    )
    eav = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("record"), F.inline(pairs))
    return codes.decrement_code(eav, "l_linenumber")


@query("""
SELECT CAST(user_id AS VARCHAR) AS record, event_type || '_complete' AS field_name, '1' AS value,
       'admin_arm_1' AS redcap_event_name
FROM events WHERE event_type <> 'error' AND CAST(floor(value) AS INTEGER) = 2
""")
def complete_to_received(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "error_done").otherwise(F.concat("event_type", F.lit("_complete")))
    number = F.floor("value").cast("string")
    eav = table(spark, sf, "events").select(
        text("user_id").alias("record"), kind.alias("field_name"),
        F.when(F.col("event_type") == "click", F.concat(number, F.lit(".0"))).otherwise(number).alias("value"),
        F.lit("other").alias("redcap_event_name"),
    )
    return codes.complete_to_received(eav)


# ---------------------------------------------------------------- choice strings from parts


def _dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """One field per part; its choices are made of the part's own values."""
    return table(spark, sf, "part").select(
        F.concat(F.lit("part_"), text("p_partkey")).alias("field_name"),
        F.when(F.col("p_size") > 10, "radio").otherwise("text").alias("field_type"),
        F.concat(
            F.lit("0"), text("p_size"), F.lit(", "), "p_name", F.lit(" | x, Brand, "), "p_brand", F.lit(" |2, "),
            "p_type", F.lit(" | broken|7,"), "p_type", F.lit(" "),
        ).alias("select_choices_or_calculations"),
    )


DICTIONARY = """
  SELECT 'part_' || p_partkey AS field_name, CASE WHEN p_size > 10 THEN 'radio' ELSE 'text' END AS field_type,
         '0' || p_size || ', ' || p_name || ' | x, Brand, ' || p_brand || ' |2, ' || p_type || ' | broken|7,' || p_type || ' '
         AS choices FROM part
"""
_PARTS = f"""
  SELECT field_name, field_type, part, CAST(position AS INTEGER) - 1 AS position
  FROM (SELECT field_name, field_type, string_split(choices, '|') AS p FROM ({DICTIONARY})), unnest(p) WITH ORDINALITY AS u(part, position)
"""
CHOICE_ROWS = f"""
  SELECT field_name, lower(trim(substr(part, strpos(part, ', ') + 2))) AS label,
         coalesce(CAST(TRY_CAST(trim(substr(part, 1, strpos(part, ', ') - 1)) AS BIGINT) AS VARCHAR),
                  trim(substr(part, 1, strpos(part, ', ') - 1))) AS code, position
  FROM ({_PARTS}) WHERE strpos(part, ', ') > 0
"""


@query(CHOICE_ROWS)
def choice_rows(spark: SparkSession, sf: str) -> DataFrame:
    return codes.choice_rows(_dictionary(spark, sf))


RADIO = f"""
  SELECT field_name, label, arg_max(code, position) AS code FROM (
    SELECT field_name, trim(substr(part, strpos(part, ',') + 1)) AS label,
           trim(substr(part, 1, strpos(part, ',') - 1)) AS code, position
    FROM ({_PARTS}) WHERE strpos(part, ',') > 0 AND field_type = 'radio')
  GROUP BY field_name, label
"""


@query(RADIO)
def radio_choices(spark: SparkSession, sf: str) -> DataFrame:
    return codes.radio_choices(_dictionary(spark, sf))


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    """One answer per line item: the name or type of its part, or its quantity, as the label."""
    items, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    label = (
        F.when(F.col("l_returnflag") == "A", F.upper("p_name"))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit(" "), "p_type"))
        .otherwise(money("l_quantity"))
    )
    return items.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        text("l_orderkey").alias("record"),
        F.concat(F.lit("part_"), text("l_partkey")).alias("field_name"), label.alias("value"),
    )


ANSWERS = f"""
  SELECT CAST(l_orderkey AS VARCHAR) AS record, 'part_' || l_partkey AS field_name,
         CASE l_returnflag WHEN 'A' THEN upper(p_name) WHEN 'R' THEN ' ' || p_type ELSE {MONEY.format('l_quantity')} END AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey
"""


@query(f"""
WITH c AS (SELECT field_name, label, arg_max(code, position) AS code FROM ({CHOICE_ROWS}) GROUP BY field_name, label)
SELECT record, a.field_name, coalesce(code, value) AS value FROM ({ANSWERS}) a
LEFT JOIN c ON c.field_name = a.field_name AND c.label = lower(trim(value))
""")
def label_to_code(spark: SparkSession, sf: str) -> DataFrame:
    return codes.label_to_code(_answers(spark, sf), codes.choice_rows(_dictionary(spark, sf)))


def _responses(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Line items as answers of their part's question: option values, scores, or a mixture.

    The part's brand decides which; its options are its own name and type.
    """
    items, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    joined = items.join(part, F.col("l_partkey") == F.col("p_partkey"))
    second = F.col("l_linenumber") > 3
    value = (
        F.when(F.col("p_size") < 20, F.when(second, "2").otherwise("1"))
        .when(F.col("p_size") < 40, F.when(second, "20").otherwise("10"))
        .otherwise(F.when(second, "30").otherwise("1"))
    )
    options = F.concat(
        F.lit('[{"name":"'), "p_name", F.lit('","value":1,"score":10},{"name":" '), "p_type",
        F.lit('","value":"2","score":20}]'),
    )
    responses = joined.select(
        text("l_orderkey").alias("record"), F.concat(F.lit("part_"), text("l_partkey")).alias("field_name"),
        value.alias("value"), F.when(F.col("l_returnflag") != "A", options).alias("options"),
    )
    dictionary = part.select(
        F.concat(F.lit("part_"), text("p_partkey")).alias("field_name"), F.lit("radio").alias("field_type"),
        F.concat(F.lit("A1, "), "p_name", F.lit("|A2,"), "p_type").alias("select_choices_or_calculations"),
    )
    return responses, dictionary


@query("""
WITH r AS (SELECT CAST(l_orderkey AS VARCHAR) AS record, 'part_' || l_partkey AS field_name,
                  CASE WHEN p_size < 20 THEN CASE WHEN l_linenumber > 3 THEN '2' ELSE '1' END
                       WHEN p_size < 40 THEN CASE WHEN l_linenumber > 3 THEN '20' ELSE '10' END
                       ELSE CASE WHEN l_linenumber > 3 THEN '30' ELSE '1' END END AS value,
                  l_returnflag <> 'A' AS has_options
           FROM lineitem JOIN part ON l_partkey = p_partkey),
     f AS (SELECT field_name, bool_or(has_options) AS known, bool_and(value IN ('1', '2')) AS all_values,
                  bool_and(value IN ('10', '20')) AS all_scores, bool_or(value IN ('1', '2')) AS any_value
           FROM r GROUP BY field_name),
     s AS (SELECT field_name, known, CASE WHEN all_values THEN 'value' WHEN all_scores THEN 'score'
                  WHEN any_value THEN 'value' ELSE 'score' END AS source FROM f)
SELECT record, field_name, CASE WHEN known AND source = 'value' AND value = '1' OR known AND source = 'score' AND value = '10' THEN 'A1'
            WHEN known AND source = 'value' AND value = '2' OR known AND source = 'score' AND value = '20' THEN 'A2'
            ELSE value END AS value
FROM r JOIN s USING (field_name)
""")
def value_or_score_map(spark: SparkSession, sf: str) -> DataFrame:
    responses, dictionary = _responses(spark, sf)
    return codes.remap_responses(responses, dictionary).drop("options")


# ---------------------------------------------------------------- defaults and forms


@query(f"""
WITH rows AS (SELECT CAST(user_id AS VARCHAR) AS record_id, 'day_' || strftime(ts, '%d') AS redcap_event_name, event_type FROM events)
SELECT record_id, redcap_event_name, event_type, CAST(NULL AS VARCHAR) AS mood_alerts FROM rows
UNION ALL
SELECT DISTINCT record_id, 'admin_arm_1', CAST(NULL AS VARCHAR), 'no' FROM rows
WHERE record_id NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'error' AND value > 50)
""")
def default_no(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    rows = events.select(
        text("user_id").alias("record_id"),
        F.concat(F.lit("day_"), F.date_format("ts", "dd")).alias("redcap_event_name"), "event_type",
    )
    positives = events.where("event_type = 'error' AND value > 50").select("user_id")
    return codes.default_no(rows, positives, "Mood", "admin_arm_1")


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN '1' ELSE '0' END AS by_response,
       CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS by_invite FROM events
""")
def completion_status(spark: SparkSession, sf: str) -> DataFrame:
    response = F.when(F.col("event_type") == "view", F.lit(1))
    invite = F.when(F.col("event_type") == "signup", 3).when(F.col("event_type") == "view", 2)
    return table(spark, sf, "events").select(
        "event_id",
        codes.completion_status(response, invite).alias("by_response"),
        codes.completion_status(None, invite).alias("by_invite"),
    )


@query("""
WITH n AS (SELECT p_partkey, CASE WHEN p_size < 10 THEN 'ace_p' WHEN p_size < 20 THEN 'parent_baseline'
                  WHEN p_size < 30 THEN 'mood_child' WHEN p_size < 40 THEN 'scale_p' ELSE replace(p_name, ' ', '_') END AS i FROM part)
SELECT p_partkey, CASE WHEN suffix(i, '_p') OR i = 'parent_baseline' THEN 'ra_alerts_parent' ELSE 'ra_alerts_child' END AS form,
       CASE WHEN contains(i, 'parent') OR suffix(i, '_p') THEN 'ra_alerts_parent' ELSE 'ra_alerts_child' END AS form_of_item,
       CASE WHEN contains(i, 'parent') OR suffix(i, '_p') THEN 'ra_alerts_parent' ELSE 'ra_alerts_child' END AS form_of_flag,
       'ra_alerts_parent' AS form_of_other
FROM n
""")
def alert_form(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    name = (
        F.when(size < 10, "ace_p").when(size < 20, "parent_baseline").when(size < 30, "mood_child")
        .when(size < 40, "scale_p").otherwise(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")))
    )
    named = table(spark, sf, "part").select("p_partkey", name.alias("i"))
    return named.select(
        "p_partkey",
        codes.alert_form(F.col("i")).alias("form"),
        codes.alert_form_of_field(F.concat(F.lit("alerts_"), "i", F.lit("_3"))).alias("form_of_item"),
        codes.alert_form_of_field(F.concat("i", F.lit("_alerts"))).alias("form_of_flag"),
        codes.alert_form_of_field(F.upper("i")).alias("form_of_other"),
    )
