"""Queries: whole jobs, composed as a user would run them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.base import (
    AS_OF, DAY, INTAKE_EAV, ORDERS_FLAT, SNAPSHOT, intake_eav, iso, money, orders_flat, query, snapshot, table, text,
)
from catalog.choosing import LATEST
from catalog.coding import FACTS, NEWS, RULED
from recordflow.operators import dedup, keys, ledger
from recordflow.operators.reshape import eav_to_wide, wide_to_eav
from recordflow.plans import accounts, crm, data_load, intake, invitations, responders, tracking
from recordflow.plans import fixed_values as fixed

# ---------------------------------------------------------------- intake


ORDER = ["value", "redcap_event_name"]
_RENAMES = " ".join(
    f"WHEN '{name}' THEN '{fixed.INTAKE_RENAMES[name]}'"
    for name in (
        "permission_audiovideo_1113", "parent_second_guardian_consent_complete", "permission_collab_1821", "phone_1821",
    )
)
FORMATTED = f"""
  named AS (SELECT record, CASE field_name {_RENAMES} ELSE field_name END AS field_name, value, redcap_event_name,
                   redcap_repeat_instrument, redcap_repeat_instance FROM source),
  facts AS ({FACTS}), news AS ({NEWS}), ruled AS ({RULED}),
  kept AS (SELECT * FROM ruled WHERE field_name IN ('record_id', 'mrn', 'dob', 'permission_audiovideo_participant',
             'complete_parent_second_guardian_consent', 'permission_collab', 'phone')),
  ids AS (SELECT record, max(value) AS id FROM kept WHERE field_name = 'mrn' GROUP BY record),
  moved AS (SELECT coalesce(id, kept.record) AS record, field_name,
                   CASE WHEN field_name = 'record_id' THEN coalesce(id, kept.record) ELSE value END AS value,
                   redcap_event_name, redcap_repeat_instrument, redcap_repeat_instance
            FROM kept LEFT JOIN ids ON ids.record = kept.record),
  formatted AS (SELECT record, field_name, CASE WHEN field_name = 'permission_collab' THEN CAST(CAST(value AS INTEGER) - 1 AS VARCHAR)
                              ELSE value END AS value, redcap_event_name FROM ({LATEST.format('moved')}))
"""
READY = f"""
  everything AS ({INTAKE_EAV}),
  source AS (SELECT * FROM everything WHERE record IN (SELECT record FROM everything WHERE field_name = 'intake_ready' AND value = '1'))
"""


def _formatted(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    source = intake_eav(spark, sf)
    rules = intake.standard_rules(AS_OF)
    return source, intake.format_records(source, rules, ready=fixed.INTAKE_READY, order_by=ORDER)


@query(f"WITH {READY}, {FORMATTED} SELECT * FROM formatted")
def job_intake(spark: SparkSession, sf: str) -> DataFrame:
    return _formatted(spark, sf)[1]


@query(f"""
WITH source AS ({INTAKE_EAV}), {FORMATTED}
SELECT record, min(value) FILTER (field_name = 'dob') AS dob, min(value) FILTER (field_name = 'permission_collab') AS permission_collab,
       min(value) FILTER (field_name = 'phone') AS phone FROM formatted WHERE field_name IN ('dob', 'permission_collab', 'phone')
GROUP BY record
""")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Intake job over all records, then the wide layout."""
    formatted = intake.format_records(intake_eav(spark, sf), intake.standard_rules(AS_OF), order_by=ORDER)
    return eav_to_wide(formatted, ["dob", "permission_collab", "phone"], order_by=["value"])


@query("""
SELECT CAST(max(CAST(o_orderkey AS BIGINT)) AS VARCHAR) AS record, 'order_arm_1' AS redcap_event_name, 'intake_ready' AS field_name,
       '2' AS value FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey
""")
def job_intake_status(spark: SparkSession, sf: str) -> DataFrame:
    source, formatted = _formatted(spark, sf)
    numbered = intake.ready_records(source).withColumn("number", F.col("record").cast("bigint"))
    return intake.sent_status(formatted, numbered, order_by=["number"])[0]


# ---------------------------------------------------------------- accounts


def _operations(spark: SparkSession, sf: str) -> DataFrame:
    """A record per customer; the segment decides what is known of the parent's part and who is ready."""
    segment = F.col("c_mktsegment")
    wide = table(spark, sf, "customer").select(
        F.concat(F.lit("rec"), text("c_custkey")).alias("record"), F.lit("enroll_arm").alias("redcap_event_name"),
        text("c_custkey").alias("mrn"), F.col("c_name").alias("first_name"), segment.alias("last_name"),
        F.lower("c_name").alias("email"), F.concat(F.lit("kid "), "c_name").alias("app_email_child"),
        F.when(segment == "BUILDING", "1,2").when(segment == "MACHINERY", "2").alias("parent_involvement"),
        F.concat(F.lit("R"), text("c_custkey")).alias("r_id"), F.upper("c_name").alias("parentfirstname"),
        F.when(segment == "HOUSEHOLD", "0").otherwise("1").alias("enrollment_complete"),
    )
    return wide_to_eav(wide, ["record", "redcap_event_name"])


def _individuals(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return accounts.individuals(_operations(spark, sf), fixed.child_renames("app"), order_by=["value"])


_PAD = "CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 5 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') ELSE CAST(c_custkey AS VARCHAR) END"


@query(f"""
WITH kids AS (SELECT *, {_PAD} AS id FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'HOUSEHOLD'))
SELECT CASE kind WHEN 'full' THEN 'child' ELSE 'parent' END AS target, id AS "secretUserId",
       CASE kind WHEN 'full' THEN 'respondent' ELSE 'shell-account' END AS route,
       '{{"role":"respondent","tag":"Child","email":"kid ' || c_name || '","firstName":"' || c_name || '","lastName":"' || c_mktsegment
       || '","secretUserId":"' || id || '","language":"en","accountType":"' || kind || '"}}' AS body
FROM kids, (VALUES ('full'), ('limited')) AS v(kind)
UNION ALL
SELECT 'parent', 'R' || c_custkey, 'respondent',
       '{{"email":"' || lower(c_name) || '","role":"respondent","tag":"Parent","firstName":"' || upper(c_name) || '","secretUserId":"R'
       || c_custkey || '","language":"en"'
       || CASE c_mktsegment WHEN 'BUILDING' THEN ',"parent_involvement":"1,2"' WHEN 'MACHINERY' THEN ',"parent_involvement":"2"' ELSE '' END
       || ',"accountType":"full"}}' FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
""")
def job_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return accounts.account_requests(*_individuals(spark, sf))


@query("""
SELECT 'rec' || c_custkey AS record, 'enrollment_complete' AS field_name, '2' AS value, 'enroll_arm' AS redcap_event_name
FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'FURNITURE', 'HOUSEHOLD')
""")
def job_accounts_sent(spark: SparkSession, sf: str) -> DataFrame:
    """Write-back after pushes of which those of one segment failed and those of another existed."""
    segment = F.col("c_mktsegment")
    outcomes = table(spark, sf, "customer").select(
        F.concat(F.lit("000"), text("c_custkey")).alias("secretUserId"),
        F.when(segment == "FURNITURE", 500).when(segment == "BUILDING", 422).otherwise(200).alias("status"),
        F.lit(None).cast("string").alias("message"),
    )
    return accounts.sent_accounts(_operations(spark, sf), _individuals(spark, sf)[0], outcomes, order_by=["value"])


# ---------------------------------------------------------------- responders


def _consents(spark: SparkSession, sf: str) -> DataFrame:
    """A record per order: its customer as first responder, finished ones with a second."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    wide = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        text("o_orderkey").alias("record"),
        F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(F.col("c_name")).alias("email"),
        F.col("o_orderpriority").alias("parentfirstname"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("second "), "c_mktsegment")).alias("email_2"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dob"), text("o_custkey").alias("mrn"),
        F.when(F.col("o_orderstatus") == "P", "0").otherwise("1").alias("intake_ready"),
    )
    return wide_to_eav(wide, ["record"])


CONSENTS = f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS source_record, 0 AS pairing, c_name AS resp_email, o_orderpriority AS resp_fname,
         {DAY.format('o_orderdate')} AS child_dob, CAST(o_custkey AS VARCHAR) AS mrn
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING' AND o_orderstatus <> 'P'
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 1, 'second ' || c_mktsegment, NULL, {DAY.format('o_orderdate')}, CAST(o_custkey AS VARCHAR)
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'
"""
RESPONDERS = f"""
  SELECT * EXCLUDE (rn) FROM (SELECT resp_email, resp_fname, CAST(NULL AS VARCHAR) AS resp_lname, CAST(NULL AS VARCHAR) AS resp_phone,
    source_record, row_number() OVER (PARTITION BY resp_email ORDER BY resp_fname NULLS LAST, source_record) AS rn FROM ({CONSENTS})) WHERE rn = 1
"""


def _known_responders(spark: SparkSession, sf: str) -> DataFrame:
    """The customers of one segment, under their number."""
    return table(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'").select(
        text("c_custkey").alias("record"), F.upper("c_name").alias("resp_email")
    )


def _changed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    roles = responders.stacked_roles(_consents(spark, sf), order_by=["value"])
    return responders.responder_changes(roles, _known_responders(spark, sf))


def _tracked(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    participants = table(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'").select(
        text("c_custkey").alias("record"), F.col("c_nationkey").alias("redcap_repeat_instance")
    )
    roles = responders.stacked_roles(_consents(spark, sf), order_by=["value"])
    return responders.track(roles, _known_responders(spark, sf), participants)


@query(f"SELECT * FROM ({RESPONDERS}) WHERE resp_email NOT IN (SELECT c_name FROM customer WHERE c_mktsegment = 'MACHINERY')")
def job_responders(spark: SparkSession, sf: str) -> DataFrame:
    return _changed(spark, sf)[0]


@query(f"""
SELECT r.*, CAST(c_custkey AS VARCHAR) AS record FROM ({RESPONDERS}) r JOIN customer ON resp_email = c_name AND c_mktsegment = 'MACHINERY'
""")
def job_responders_known(spark: SparkSession, sf: str) -> DataFrame:
    return _changed(spark, sf)[1]


@query(f"""
WITH linked AS (SELECT p.*, CAST(c_custkey AS VARCHAR) AS record, c_nationkey FROM ({CONSENTS}) p
                LEFT JOIN customer ON resp_email = c_name AND c_mktsegment = 'MACHINERY')
SELECT record, resp_email, CAST(coalesce(c_nationkey, 0) + row_number() OVER (PARTITION BY coalesce('r' || record, 'e' || lower(trim(resp_email))) ORDER BY source_record, pairing) AS INTEGER)
         AS redcap_repeat_instance, child_dob, CAST(NULL AS VARCHAR) AS child_fname, mrn, 'child' AS participant_type, source_record
FROM linked
""")
def job_participants(spark: SparkSession, sf: str) -> DataFrame:
    return _tracked(spark, sf)[2]


@query("SELECT 'R' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS record, c_name AS resp_email FROM customer")
def job_responder_ids(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "customer").select(F.col("c_custkey").alias("record"), F.col("c_name").alias("resp_email"))
    return responders.responder_ids(known)


# ---------------------------------------------------------------- tracking


def _marks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A form status per event; large values are complete, and some marks exist already."""
    events = table(spark, sf, "events")
    source = events.select(
        text("user_id").alias("record"), F.concat("event_type", F.lit("_complete")).alias("field_name"),
        F.when(F.col("value") > 100, "2").when(F.col("value") > 90, "2.0").when(F.col("value") > 50, "N/A").otherwise("0").alias("value"),
        F.lit("visit").alias("redcap_event_name"),
    )
    target = events.where("value > 150").select(
        text("user_id").alias("record"), F.concat("event_type", F.lit("_received")).alias("field_name"),
        F.lit("1").alias("value"), F.lit("admin_arm_1").alias("redcap_event_name"),
    )
    dictionary = events.where("event_type <> 'view'").select(F.concat("event_type", F.lit("_received")).alias("field_name"))
    return tracking.new_marks(source, target, dictionary)


MARKS = """
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS record, event_type || '_received' AS field_name, '1' AS value,
         'admin_arm_1' AS redcap_event_name FROM events WHERE value > 90 AND event_type <> 'view'
  EXCEPT SELECT CAST(user_id AS VARCHAR), event_type || '_received', '1', 'admin_arm_1' FROM events WHERE value > 150
"""


@query(MARKS)
def job_tracking(spark: SparkSession, sf: str) -> DataFrame:
    return _marks(spark, sf)[0]


@query("""
SELECT CAST(user_id AS VARCHAR) AS record, 'view_complete' AS field_name, '1' AS value, 'admin_arm_1' AS redcap_event_name
FROM events WHERE value > 90 AND event_type = 'view'
""")
def job_tracking_unknown(spark: SparkSession, sf: str) -> DataFrame:
    return _marks(spark, sf)[1]


@query(f"""
SELECT string_agg(DISTINCT replace(field_name, '_received', ''), ',' ORDER BY replace(field_name, '_received', '')) AS names,
       count(DISTINCT field_name) AS instruments, count(DISTINCT record) AS records FROM ({MARKS})
""")
def job_tracking_report(spark: SparkSession, sf: str) -> DataFrame:
    return _marks(spark, sf)[2]


# ---------------------------------------------------------------- questionnaire data


def _loaded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders as one instrument; urgent ones arrive under another ID, the target has the snapshot."""
    orders = orders_flat(spark, sf)
    urgent = F.col("priority") == "1-URGENT"
    incoming = orders.withColumn("record_id", F.when(urgent, F.concat(F.lit("m"), "record_id")).otherwise(F.col("record_id")))
    ids = keys.id_map(
        orders.where(urgent).select(
            F.col("record_id").alias("record"), F.lit("mrn").alias("field_name"), F.concat(F.lit("m"), "record_id").alias("value")
        )
    )
    dictionary = orders.select(F.explode(F.array(F.lit("status"), F.lit("price"), F.lit("priority"), F.lit("orders_alerts"))).alias("field_name"))
    existing = snapshot(spark, sf)
    positives = orders.where("status = 'F'").select("record_id")
    changed, _ = data_load.prepare(
        incoming, ids, dictionary.distinct(), existing, "orders", positives, "order_arm_1", order_by=["price"]
    )
    return existing, changed


@query(f"""
WITH new AS ({ORDERS_FLAT}), old AS ({SNAPSHOT})
SELECT record_id, redcap_event_name, new.status, new.price, new.priority, CAST(NULL AS VARCHAR) AS orders_alerts
FROM new LEFT JOIN old USING (record_id, redcap_event_name) WHERE old.price IS NULL OR old.price <> new.price
UNION ALL SELECT record_id, redcap_event_name, NULL, NULL, NULL, 'no' FROM new WHERE status <> 'F'
""")
def job_data_load(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, sf)[1]


@query(f"""
WITH new AS ({ORDERS_FLAT}), old AS ({SNAPSHOT})
SELECT record_id, redcap_event_name, new.status, new.price, old.day, new.priority FROM new LEFT JOIN old USING (record_id, redcap_event_name)
""")
def job_data_target(spark: SparkSession, sf: str) -> DataFrame:
    """The target after the load of the changed answers."""
    existing, changed = _loaded(spark, sf)
    return data_load.load(existing, changed.where("orders_alerts IS NULL").drop("orders_alerts"))


@query("""
SELECT 'customers' AS instrument, 'no key column' AS reason, count(*) AS row_count FROM customer
UNION ALL SELECT 'orders_without_answers', 'no data columns', count(*) FROM orders
""")
def job_data_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Three instruments land; one lacks the key, one has nothing but keys."""
    orders = orders_flat(spark, sf)
    instruments = {
        "orders": orders,
        "customers": table(spark, sf, "customer").select("c_name"),
        "orders_without_answers": orders.select("record_id", "redcap_event_name"),
    }
    return data_load.rejected_instruments(instruments, spark)


@query("""
SELECT instrument, count(*) AS row_count, CASE WHEN instrument = 'N' THEN '625' ELSE '891' END AS target
FROM (SELECT l_returnflag AS instrument FROM lineitem WHERE l_returnflag <> 'A') GROUP BY instrument
""")
def job_data_route(spark: SparkSession, sf: str) -> DataFrame:
    """Instruments that are not in the ledger yet, with their target."""
    outputs = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("instrument"), text("l_orderkey").alias("record_id"), money("l_quantity").alias("answer")
    )
    known = dedup.table_hash(outputs.where("instrument = 'A'"), ["instrument"]).select(
        F.concat_ws(":", "instrument", "content_hash", text("row_count"))
    )
    log = ledger.entries(known, "load", "2024-02-01T00:00:00")
    rows, _ = data_load.to_load(data_load.route(outputs, ["n"], "625", "891").drop("target"), log, "load", "2024-02-01T00:01:00")
    routed = data_load.route(rows, ["n"], "625", "891")
    return routed.groupBy("instrument", "target").agg(F.count("*").alias("row_count"))


# ---------------------------------------------------------------- invitations


ACCOUNT = invitations.Account()
_STATUS = "CASE event_type WHEN 'view' THEN '3' WHEN 'click' THEN '2' ELSE '1' END"
_SEEN = "(event_type = 'signup' OR CAST(ts AS DATE) >= DATE '2024-01-19')"


def _respondents(spark: SparkSession, sf: str) -> DataFrame:
    """A respondent per event, known to two applications; errors only to the other one."""
    kind = F.col("event_type")

    def detail(application, secret):
        return F.struct(
            application.alias("appletId"), secret.alias("respondentSecretId"), text("event_id").alias("subjectId")
        )

    here = F.when(kind == "error", "other").otherwise("app")
    return table(spark, sf, "events").select(
        F.when(kind == "view", "invited").when(kind == "click", "pending").otherwise("not_invited").alias("status"),
        F.when(kind != "signup", iso("ts")).alias("lastSeen"),
        F.array(
            detail(here, F.lit("first")), detail(here, F.concat(F.lit("00"), text("user_id"))), detail(F.lit("else"), F.lit("x"))
        ).alias("details"),
    )


def _invited(spark: SparkSession, sf: str, account: invitations.Account) -> DataFrame:
    context = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(
        text("c_custkey").alias("r_id"), F.concat(F.lit("rec"), text("c_custkey")).alias("record_id")
    )
    return invitations.invitation_rows(_respondents(spark, sf), "app", account, "2024-01-20", context)


INVITED = f"""
  SELECT 'rec' || user_id AS record_id, CAST(user_id AS VARCHAR) AS account_created_source_secret_id,
         {_STATUS} AS account_created_invite_status, 'admin_arm_1' AS redcap_event_name, '0' AS account_created_responder_complete,
         CAST(event_id AS VARCHAR) AS respondent_id
  FROM events WHERE event_type <> 'error' AND {_SEEN}
    AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
"""


@query(INVITED)
def invitation_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _invited(spark, sf, ACCOUNT)


@query(f"""
SELECT CAST(user_id AS VARCHAR) AS record_id, CAST(user_id AS VARCHAR) AS account_created_source_secret_id_c,
       {_STATUS} AS account_created_invite_status_c, 'admin_arm_1' AS redcap_event_name, '0' AS account_created_child_complete,
       CAST(event_id AS VARCHAR) AS respondent_id FROM events WHERE event_type <> 'error' AND {_SEEN}
""")
def invitation_rows_child(spark: SparkSession, sf: str) -> DataFrame:
    return _invited(spark, sf, invitations.Account(kind="child"))


def _invitations(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Completed: users with an error; answered: large values; in the ledger: pending ones."""
    events = table(spark, sf, "events")
    completed = events.where("event_type = 'error' AND value > 120").select(F.concat(F.lit("rec"), text("user_id")).alias("record_id"))
    responses = events.where("value > 60").select(
        text("event_id").alias("respondent_id"),
        F.when(F.col("event_type") != "purchase", "1").alias("account_created_account_created_response"),
    )
    existing = events.where("event_type = 'purchase'").select(
        F.concat(F.lit("rec"), text("user_id")).alias("record_id"), F.lit("admin_arm_1").alias("redcap_event_name"),
        text("user_id").alias("account_created_source_secret_id"), F.lit("3").alias("account_created_invite_status"),
        F.lit("1").alias("account_created_responder_complete"), F.lit("1").alias("account_created_account_created_response"),
    ).distinct()
    invited = _invited(spark, sf, ACCOUNT)
    pending = events.where("event_type = 'click'").select(
        F.concat(F.lit("rec"), text("user_id"), F.lit(":2:0"))
    )
    log = ledger.entries(pending, "invitations", "2024-01-20T00:00:00")
    return invitations.load_rows(
        invited, completed, responses, existing, log, "invitations", "2024-01-20T00:01:00", ACCOUNT, order_by=["respondent_id"]
    )


HANDLED = f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT i.*, response, row_number() OVER (PARTITION BY record_id ORDER BY i.respondent_id DESC) AS rn
    FROM (SELECT * EXCLUDE (account_created_responder_complete),
                 account_created_invite_status AS status FROM ({INVITED})) i
    JOIN (SELECT CAST(event_id AS VARCHAR) AS respondent_id, CASE WHEN event_type <> 'purchase' THEN '1' END AS response
          FROM events WHERE value > 60) r USING (respondent_id)
    WHERE status <> '2'
      AND record_id NOT IN (SELECT 'rec' || user_id FROM events WHERE event_type = 'error' AND value > 120)) WHERE rn = 1
"""


@query(f"""
SELECT record_id, redcap_event_name, account_created_source_secret_id, account_created_invite_status,
       CASE WHEN response = '1' OR status = '3' THEN '1' ELSE '0' END AS account_created_responder_complete,
       response AS account_created_account_created_response
FROM ({HANDLED}) WHERE NOT (response IS NOT NULL AND status = '3'
  AND record_id IN (SELECT 'rec' || user_id FROM events WHERE event_type = 'purchase'))
""")
def job_invitations(spark: SparkSession, sf: str) -> DataFrame:
    return _invitations(spark, sf)[0]


@query(f"SELECT record_id || ':' || status || ':' || CASE WHEN response IS NULL THEN 0 ELSE 1 END AS cache_key FROM ({HANDLED})")
def job_invitation_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _invitations(spark, sf)[1]


# ---------------------------------------------------------------- CRM


def _contacts(spark: SparkSession, sf: str) -> DataFrame:
    """Two studies: customers with two contacts, suppliers with one."""
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("globalId"), F.col("c_custkey").alias("customId"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Wait").otherwise("Send to RedCap").alias("cv.consent_form"),
        F.when(F.col("c_nationkey") < 10, "phone").otherwise("email").alias("contact.1.infos.1.contactType"),
        F.concat(F.lit("1:"), "c_name").alias("contact.1.infos.1.information"),
        F.when(F.col("c_nationkey") < 5, "phone").otherwise("email").alias("contact.2.infos.1.contactType"),
        F.concat(F.lit("2:"), "c_name").alias("contact.2.infos.1.information"),
        F.lit("2024-01-15T10:00:00").alias("lastModified"), F.lit("main").alias("importType"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_name").alias("globalId"), (F.col("s_suppkey") + 10_000_000).alias("customId"),
        F.lit("Send to RedCap").alias("cv.consent_form"), F.lit("email").alias("contact.1.infos.1.contactType"),
        F.col("s_name").alias("contact.1.infos.1.information"), F.lit("waitlist").alias("importType"),
    )
    return crm.marked_contacts(customers, suppliers)


CONTACTS = """
  SELECT c_custkey AS record_id, c_custkey AS mrn, CASE WHEN c_nationkey >= 10 THEN '1:' || c_name
         WHEN c_nationkey >= 5 THEN '2:' || c_name END AS email_consent, '2024-01-15' AS day FROM customer WHERE c_mktsegment <> 'BUILDING'
  UNION ALL SELECT s_suppkey + 10000000, s_suppkey + 10000000, s_name, '' FROM supplier
"""
CRM_ROWS = f"""
  SELECT record_id, mrn, email_consent, mrn || ':' || substr(md5(coalesce(email_consent, 'nan')), 1, 8) || ':' || day AS cache_key FROM ({CONTACTS})
"""


@query(CRM_ROWS)
def intake_contacts(spark: SparkSession, sf: str) -> DataFrame:
    return crm.intake_rows(_contacts(spark, sf), "2024-02-01")


def _crm_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    rows = crm.intake_rows(_contacts(spark, sf), "2024-02-01")
    target = table(spark, sf, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_custkey").alias("mrn"))
    done = rows.where(F.col("email_consent").startswith("2:")).select("cache_key")
    log = ledger.entries(done, "crm", "2024-02-01T00:00:00")
    return crm.split_intake(rows, target, log, "crm", "2024-02-01T00:02:00", order_by=["record_id"])


FRESH = f"SELECT * FROM ({CRM_ROWS}) WHERE email_consent IS NULL OR NOT starts_with(email_consent, '2:')"


@query(f"""
SELECT t.id AS record_id, mrn, email_consent FROM ({FRESH}) JOIN (SELECT o_custkey, max(o_orderkey) AS id FROM orders GROUP BY o_custkey) t
ON mrn = o_custkey
""")
def job_crm(spark: SparkSession, sf: str) -> DataFrame:
    return _crm_split(spark, sf)[0]


@query(f"SELECT record_id, mrn, email_consent FROM ({FRESH}) WHERE mrn NOT IN (SELECT o_custkey FROM orders)")
def job_crm_new(spark: SparkSession, sf: str) -> DataFrame:
    return _crm_split(spark, sf)[1]


@query(f"SELECT cache_key FROM ({FRESH})")
def job_crm_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _crm_split(spark, sf)[2]


@query(f"SELECT o_custkey AS mrn, count(*) AS copies FROM orders WHERE o_custkey IN (SELECT mrn FROM ({FRESH})) GROUP BY o_custkey HAVING count(*) > 1")
def job_crm_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of the rows handled that several records hold."""
    return _crm_split(spark, sf)[3]


@query("""
SELECT c_name AS "globalId", 'consent_form_created_in_redcap' AS "cv.consent_form", 'main' AS "importType" FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT s_name, 'consent_form_created_in_redcap', 'waitlist' FROM supplier
""")
def job_crm_status(spark: SparkSession, sf: str) -> DataFrame:
    return crm.study_status(_contacts(spark, sf))
