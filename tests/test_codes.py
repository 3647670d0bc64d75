import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from recordflow.operators import codes
from recordflow.plans import fixed_values as fixed
from recordflow.plans.intake import standard_rules
from recordflow.schemas import DICT_SCHEMA

AS_OF = "2024-06-15"


def dictionary(spark, *entries):
    """Dictionary rows from (field, type, choices)."""
    return spark.createDataFrame([(f, "form", kind, choices) for f, kind, choices in entries], DICT_SCHEMA)


def test_choice_rows(spark):
    d = dictionary(spark, ("a", "radio", "0, No | 1, Yes | 2, Maybe"), ("b", "radio", ""), ("c", "radio", "invalid_format"),
                   ("d", "text", None), ("e", "radio", "01, One, two |x, X"))
    assert rows(codes.choice_rows(d), "field_name", "label", "code") == [
        ("a", "maybe", "2"), ("a", "no", "0"), ("a", "yes", "1"), ("e", "one, two", "1"), ("e", "x", "x")
    ]


def test_radio_choices(spark):
    d = dictionary(spark, ("a", "radio", "0,No | 1, Yes, sir | 2, No"), ("b", "checkbox", "1, x"), ("c", "radio", "none"))
    assert rows(codes.radio_choices(d)) == [("a", "No", "2"), ("a", "Yes, sir", "1")]


def test_label_to_code(spark, eav):
    lookup = codes.choice_rows(dictionary(spark, ("q", "radio", "0, No | 1, Yes | 2, Yes")))
    df = eav(("1", "q", " YES "), ("2", "q", "other"), ("3", "z", "yes"), ("4", "q", None))
    assert rows(codes.label_to_code(df, lookup), "record", "value") == [("1", "2"), ("2", "other"), ("3", "yes"), ("4", None)]


OPTIONS = '[{"name":" Never ","value":0,"score":10},{"name":"Often","value":1,"score":20},{"name":"Gone","value":2}]'


@pytest.mark.parametrize(
    "values, mapped",
    [(["0", "1"], ["n", "o"]), (["10", "20"], ["n", "o"]), (["0", "30"], ["n", "30"]), (["30", "20"], ["30", "o"]),
     (["2", None], ["2", None])],
)
def test_values_or_scores(spark, values, mapped):
    d = dictionary(spark, ("q", "radio", "n, Never | o, Often"))
    df = spark.createDataFrame(
        [(i, "q", v, OPTIONS if i else None) for i, v in enumerate(values)], "i int, field_name string, value string, options string"
    )
    out = codes.remap_responses(df, d, ["i"])
    assert [r.value for r in out.orderBy("i").collect()] == mapped


def guardian(eav, *facts):
    return rows(codes.apply_rules(eav(*facts), standard_rules(AS_OF)[:1], ["value"]), "record", "field_name", "value")


def test_guardian_rule(eav):
    form = "complete_parent_second_guardian_consent"
    assert guardian(eav, ("1", "guardian2_consent", "0"), ("1", form, "2")) == [("1", form, "3"), ("1", "guardian2_consent", "0")]
    assert guardian(eav, ("1", "guardian2_consent", "3")) == [("1", form, "4"), ("1", "guardian2_consent", "3")]
    assert guardian(eav, ("1", "guardian2_consent", "1"), ("1", form, "2")) == [("1", form, "2"), ("1", "guardian2_consent", "1")]


@pytest.mark.parametrize("age, expected", [(0, "0"), (5, "0"), (10, "0"), (11, "1"), (17, "1"), (18, "0"), (65, "0")])
def test_age_rule(eav, age, expected):
    field = fixed.AUDIOVIDEO.field
    df = eav(("1", "dob", f"{2024 - age}-06-15"), ("1", field, "1"))
    out = codes.apply_rules(df, standard_rules(AS_OF)[1:], ["value"]).where(F.col("field_name") == field)
    assert rows(out, "value") == [(expected,)]


@pytest.mark.parametrize(
    "facts, expected",
    [([("1", "dob", "2000-01-01")], [("0", None)]), ([("1", "x", "2000-01-01")], []),
     ([("1", "dob", "bad"), ("1", fixed.AUDIOVIDEO.field, "2", "e")], [("2", "e")])],
)
def test_age_rule_appends_or_leaves(eav, facts, expected):
    out = codes.apply_rules(eav(*facts), standard_rules(AS_OF)[1:], ["value"])
    assert rows(out.where(F.col("field_name") == fixed.AUDIOVIDEO.field), "value", "redcap_event_name") == expected


def test_decrement(eav):
    df = eav(("1", "c", "1"), ("2", "c", "2.0"), ("3", "c", "x"), ("4", "d", "1"))
    assert rows(codes.decrement_code(df, "c"), "record", "value") == [("1", "0"), ("2", "1"), ("3", None), ("4", "1")]


def test_complete_to_received(eav):
    df = eav(*[(str(i), "a_complete", v, "e") for i, v in enumerate(["2", "2.0", "0", "N/A", ""])], ("9", "incomplete", "2"))
    assert rows(codes.complete_to_received(df)) == [
        ("0", "a_complete", "1", "admin_arm_1"), ("1", "a_complete", "1", "admin_arm_1")
    ]


def test_default_no(spark):
    df = spark.createDataFrame([(1, "e", 5), (1, "f", 6), (2, "e", 7)], "record_id int, redcap_event_name string, x int")
    out = codes.default_no(df, spark.createDataFrame([("2",)], "r string"), "MFQ", "admin")
    assert rows(out.where("mfq_alerts IS NOT NULL"), "record_id", "redcap_event_name", "x", "mfq_alerts") == [(1, "admin", None, "no")]
    assert codes.default_no(out, df.select("record_id"), "mfq", "admin").count() == out.count()


@pytest.mark.parametrize(
    "field, form",
    [("alerts_scale_p_1", "ra_alerts_parent"), ("alerts_scale_c_1", "ra_alerts_child"), ("parent_x_alerts", "ra_alerts_parent"),
     ("alerts_scale_1", "ra_alerts_child"), ("alerts_ra_alerts_thing_2", "ra_alerts_thing"), ("record_id", "ra_alerts_parent")],
)
def test_alert_form_of_field(spark, field, form):
    assert spark.range(1).select(codes.alert_form_of_field(F.lit(field))).first()[0] == form


@pytest.mark.parametrize("name, form", [("ace_p", "parent"), ("parent_followup", "parent"), ("scale_p", "parent"), ("scale_sr", "child")])
def test_alert_form(spark, name, form):
    assert spark.range(1).select(codes.alert_form(F.lit(name))).first()[0] == f"ra_alerts_{form}"
