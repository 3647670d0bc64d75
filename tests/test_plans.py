from datetime import datetime

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from recordflow.operators import ledger
from recordflow.plans import accounts, alerts, crm, data_load, intake, invitations, responders, tracking
from recordflow.plans import fixed_values as fixed
from recordflow.schemas import ANSWER_SCHEMA, DICT_SCHEMA, LEDGER_SCHEMA, RESPONDENT_SCHEMA

AS_OF = "2024-06-15"


def test_intake(eav):
    df = eav(
        ("a", "mrn", "10", "e"), ("a", "record_id", "a", "e"), ("a", "intake_ready", "1", "e"), ("a", "consent1", "Ann", "e"),
        ("a", "dob_1821", "2000-01-01", "e"), ("a", "guardian2_consent", "0", "e"), ("a", "permission_collab_1821", "1", "e"),
        ("a", "sibling", "old", "e", "sib", 1), ("a", "sibling", "new", "e", "sib", 2), ("a", "unrelated", "x", "e"),
        ("b", "mrn", "20", "e"), ("b", "intake_ready", "0", "e"),
    )
    rules = intake.standard_rules(AS_OF)
    out = intake.format_records(df, rules, ready=fixed.INTAKE_READY, order_by=["value"])
    assert rows(out, "record", "field_name", "value") == [
        ("10", "complete_parent_second_guardian_consent", "3"), ("10", "dob", "2000-01-01"), ("10", "first_name", "Ann"),
        ("10", "mrn", "10"), ("10", "permission_audiovideo_participant", "0"), ("10", "permission_collab", "0"),
        ("10", "record_id", "10"), ("10", "sibling", "new"),
    ]
    status, check = intake.sent_status(out, intake.ready_records(df), order_by=["value"])
    assert rows(status, "record", "redcap_event_name", "field_name", "value") == [("a", "e", "intake_ready", "2")]
    assert check.first().consistent
    everyone = intake.format_records(df, rules, order_by=["value"])
    assert ("20", "mrn") in rows(everyone, "record", "field_name")


def test_accounts(eav):
    df = eav(
        ("1", "mrn", "123", "x"), ("1", "first_name", "Kid", "x"), ("1", "parent_involvement", "1", "x"),
        ("1", "parentfirstname", "Par", "x"), ("1", "r_id", "R1", "x"), ("1", "enrollment_complete", "1", "arm"),
        ("2", "mrn", "456", "x"), ("2", "parent_involvement", "2", "x"), ("3", "mrn", "789", "x"),
    )
    children, parents = accounts.individuals(df, fixed.child_renames("app"), order_by=["value"], ready=None)
    assert rows(children, "secretUserId", "firstName", "language") == [("00123", "Kid", "en"), ("00789", None, "en")]
    assert "parent_involvement" not in children.columns
    requests = accounts.account_requests(children, parents.where("secretUserId IS NOT NULL"))
    assert rows(requests, "target", "secretUserId", "route") == [
        ("child", "00123", "respondent"), ("child", "00789", "respondent"), ("parent", "00123", "shell-account"),
        ("parent", "00789", "shell-account"), ("parent", "R1", "respondent"),
    ]
    outcomes = df.sparkSession.createDataFrame(
        [("00123", 200, None), ("00789", 500, None)], "secretUserId string, status int, message string"
    )
    sent = accounts.sent_accounts(df, children, outcomes, order_by=["value"])
    assert rows(sent, "record", "field_name", "value", "redcap_event_name") == [("1", "enrollment_complete", "2", "arm")]


def test_responders(spark, eav):
    df = eav(
        ("1", "email", "A@x"), ("1", "parentfirstname", "Ann"), ("1", "email_2", "b@x"), ("1", "dob", "2010-01-01"), ("1", "mrn", "10"),
        ("2", "email", "A@x"), ("2", "mrn", "20"), ("3", "email_1821", "c@x"), ("3", "mrn", "30"),
    )
    existing = spark.createDataFrame([("7", "a@X")], "record string, resp_email string")
    known = spark.createDataFrame([("7", 3)], "record string, redcap_repeat_instance int")
    create, update, people = responders.track(responders.stacked_roles(df, order_by=["value"], ready=None), existing, known)
    assert rows(create, "resp_email") == [("b@x",)]
    assert rows(update, "record", "resp_email", "resp_fname") == [("7", "A@x", "Ann")]
    assert rows(people, "record", "resp_email", "redcap_repeat_instance", "mrn") == [
        ("7", "A@x", 4, "10"), ("7", "A@x", 5, "20"), (None, "b@x", 1, "10")
    ]
    assert rows(responders.responder_ids(existing)) == [("R000007", "a@X")]


def test_tracking(spark, eav):
    source = eav(("1", "amas_sr_14_complete", "2", "e"), ("2", "amas_sr_complete", "2.0", "e"), ("3", "zzz_complete", "2", "e"))
    target = eav(("2", "amas_sr_received", "1", "admin_arm_1")).select("record", "field_name", "value", "redcap_event_name")
    dictionary = spark.createDataFrame([("amas_sr_received",), ("record_id",)], "field_name string")
    new, untracked, report = tracking.new_marks(source, target, dictionary)
    assert rows(new) == [("1", "amas_sr_received", "1", "admin_arm_1")]
    assert rows(untracked, "field_name") == [("zzz_complete",)]
    assert tuple(report.first()) == ("amas_sr", 1, 1)


def test_data_load(spark):
    df = spark.createDataFrame(
        [("m1", "e", "a", "x"), ("2", "e", "b", "x"), ("3", "e", "c", "x")], "record_id string, redcap_event_name string, q string, bad string"
    )
    ids = spark.createDataFrame([("m1", "1")], "_id string, _target string")
    existing = spark.createDataFrame([("1", "e", "a"), ("2", "e", "old")], "record_id string, redcap_event_name string, q string")
    dictionary = spark.createDataFrame([("q", "f", "text", None)], DICT_SCHEMA)
    changed, unknown = data_load.prepare(df, ids, dictionary, existing, "form")
    assert (rows(changed), unknown) == ([("2", "e", "b"), ("3", "e", "c")], ["bad"])
    assert rows(data_load.load(existing, changed)) == [("1", "e", "a"), ("2", "e", "b"), ("3", "e", "c")]
    odd = {"form": df, "keyless": df.select("q"), "bare": df.select("record_id", "redcap_event_name")}
    assert rows(data_load.rejected_instruments(odd, spark)) == [("bare", "no data columns", 3), ("keyless", "no key column", 3)]
    assert list(data_load.loadable(odd)[0]) == ["form"] and data_load.rejected_instruments({"form": df}, spark).isEmpty()
    with pytest.raises(ValueError, match="keyless: no key column"):
        data_load.prepare(odd["keyless"], ids, dictionary, existing, "keyless")
    wide = spark.range(1).select(F.lit("1").alias("record_id"), *[F.lit(i).alias(f"c{i}") for i in range(160)])
    assert [len(s.columns) for s in data_load.slices(wide)] == [101, 61]


def test_invitations(spark):
    respondents = spark.createDataFrame(
        [("invited", "2024-06-15T01:00:00", [("app", "00012", "s1"), ("app", "0013", "s2"), ("other", "9", "s3")]),
         ("pending", None, [("app", "14", "s4")]), ("invited", "2024-06-01T00:00:00", [("app", "15", "s5")]),
         ("invited", None, [("other", "16", "s6")])],
        RESPONDENT_SCHEMA,
    )
    child = invitations.Account(kind="child")
    out = invitations.invitation_rows(respondents, "app", child, AS_OF)
    assert rows(out, "record_id", child.field("invite_status"), "respondent_id", child.complete) == [
        ("13", "3", "s2", "0"), ("14", "2", "s4", "0")
    ]
    context = spark.createDataFrame([("13", "rec")], "r_id string, record_id string")
    account = invitations.Account()
    looked_up = invitations.invitation_rows(respondents, "app", account, AS_OF, context)
    assert rows(looked_up, "record_id", "respondent_id") == [("rec", "s2")]

    log = spark.createDataFrame([], LEDGER_SCHEMA)
    response = account.field("account_created_response")
    responses = spark.createDataFrame([("s2", "1")], f"respondent_id string, {response} string")
    done = spark.createDataFrame([], "record_id string")
    existing = spark.createDataFrame([], f"record_id string, redcap_event_name string, {response} string, "
                                     f"{account.field('source_secret_id')} string, {account.field('invite_status')} string, {account.complete} string")
    push, seen = invitations.load_rows(looked_up, done, responses, existing, log, "inv", datetime(2024, 6, 15), account)
    assert rows(push, "record_id", account.complete, response) == [("rec", "1", "1")]
    assert rows(seen) == [("rec:3:1",)]
    marked = ledger.entries(spark.createDataFrame([("rec:3:0",)], "k string"), "inv", datetime(2024, 6, 15))
    assert invitations.load_rows(looked_up, done, responses, existing, marked, "inv", datetime(2024, 6, 15), account)[0].count() == 0


def test_answer_rows(spark):
    item = ("i1", "mood", ("How?",), "singleSelect", ([("Good", 1, None), (None, None, 5)],))
    df = spark.createDataFrame(
        [("sub", "1.0", "2024-01-01T00:00:00.000Z", "2024-01-01T00:01:00.5", "r", None, [item, ("i2", "note", None, "text", None)], [("1",)])],
        ANSWER_SCHEMA,
    )
    first, second = invitations.answer_rows(df, "account_created").orderBy("position").collect()
    assert [tuple(o) for o in first["item"].response_options] == [("Good", 1, 0), ("", 0, 5)]
    assert (first.response.value.single_value, second.response.value.null_value, second["item"].prompt) == (1, True, "")
    assert (first.activity.name, first.target_user.secret_id, first.source_user.secret_id) == ("Account Created", "r", "")


def test_target_columns(spark):
    df = spark.createDataFrame([("1",) * 3], "account_created_child_x string, account_created_child_complete string, record_id string")
    out = invitations.target_columns(df, invitations.Account(kind="child"))
    assert out.columns == ["account_created_x_c", "account_created_child_complete", "record_id"]


def test_alerts(spark, eav):
    messages = spark.createDataFrame(
        [("1", "answer", "12345", 'Red: "Yes" to Sad asr_1'), ("2", "answer", "99999", 'Red: "No" to Sad asr_1'),
         ("3", "note", "12345", "x"), ("4", "answer", "12345", "unreadable"), ("5", "answer", "12345", 'Red: "Yes" to Sad zzz_1')],
        "id string, type string, secretId string, message string",
    )
    dictionary = spark.createDataFrame([("alerts_asr_1", "f", "radio", "0, No | 1, Yes")], DICT_SCHEMA)
    context = eav(("1", "mrn", "12345", "arm"))
    out = alerts.coded_alerts(alerts.parsed_alerts(messages), dictionary, context)
    assert rows(out, "record", "field_name", "value", "redcap_event_name") == [
        ("1", "alerts_asr_1", "1", "arm"), ("1", "asr_alerts", "yes", "arm")
    ]
    assert rows(alerts.rejected_alerts(messages), "id") == [("4",)]
    now = datetime(2024, 1, 1)
    empty = spark.createDataFrame([], LEDGER_SCHEMA)
    keys = alerts.new_alerts(messages, empty, "alerts", now).select("cache_key")
    assert alerts.new_alerts(messages, ledger.entries(keys.limit(2), "alerts", now), "alerts", now).count() == 3


def test_crm(spark):
    contacts = spark.createDataFrame(
        [("g1", "12345", "Send to RedCap", "phone", "1", "main"), ("g2", "67890", "Send to RedCap", "email", "a@x", "main"),
         ("g3", "99001", "Wait", "email", "b@x", "wait"), ("g4", "99002", "Send to RedCap", "email", "c@x", "wait")],
        "globalId string, customId string, `cv.consent_form` string, `contact.1.infos.1.contactType` string, "
        "`contact.1.infos.1.information` string, importType string",
    )
    marked = crm.marked_contacts(contacts)
    out = crm.intake_rows(marked, "2024-01-01")
    target = spark.createDataFrame([(12345, 1), (67890, 2), (67890, 0), (5, 3), (5, 4)], "mrn bigint, record_id bigint")
    empty = spark.createDataFrame([], LEDGER_SCHEMA)
    update, insert, seen, repeated = crm.split_intake(out, target, empty, "crm", "2024-01-01T00:00:00", order_by=["record_id"])
    assert rows(repeated) == [(67890, 2)]
    assert rows(update) == [(1, 12345, None), (2, 67890, "a@x")]
    assert rows(insert) == [(99002, 99002, "c@x")]
    again = crm.split_intake(out, target, ledger.entries(seen, "crm", "2024-01-01T00:00:00"), "crm", "2024-01-01T00:01:00")
    assert [part.count() for part in again] == [0, 0, 0, 0]
    assert rows(crm.study_status(marked), "globalId", "importType") == [("g1", "main"), ("g2", "main"), ("g4", "wait")]
