from frame_rows import rows
from pyspark.sql import functions as F

from recordflow.operators import reshape, select
from recordflow.plans import fixed_values as fixed


def test_suffix_fields(spark):
    fields = spark.createDataFrame(
        [("asr_sr_received",), ("cbcl_p_received",), ("asr_sr_received",), ("record_id",), ("not_received_yet",)],
        "field_name string",
    )
    assert rows(select.fields_with_suffix(fields, "_received")) == [("asr_sr_received",), ("cbcl_p_received",)]
    assert rows(select.fields_with_suffix(fields, "_received", strip=True)) == [("asr_sr",), ("cbcl_p",)]


def test_prefixes_admit_longer_names(eav):
    df = eav(("1", "email", "a"), ("1", "email_consent", "b"), ("1", "sex", "c"), ("1", "xemail", "d"))
    assert rows(select.keep_prefixes(df, ["email", "sex"]), "value") == [("a",), ("b",), ("c",)]
    assert select.keep_prefixes(df, []).count() == 0


def test_fan_out(eav):
    df = eav(("1", "adult_email", "a"), ("1", "other", "b"))
    out = select.fan_out_fields(df, {"adult_email": ["adult_email", "email"]})
    assert rows(out, "field_name", "value") == [("adult_email", "a"), ("email", "a"), ("other", "b")]


def test_rename_infix_and_suffix(spark):
    df = spark.createDataFrame(
        [("1",) * 4], "acc_responder_id string, acc_responder_complete string, acc_x string, record_id string"
    )
    assert select.strip_infix(df, "acc_", "responder_").columns == ["acc_id", "acc_responder_complete", "acc_x", "record_id"]
    assert select.add_suffix(df, "acc_", "_c").columns == [
        "acc_responder_id_c", "acc_responder_complete", "acc_x_c", "record_id"
    ]


def test_drop_parent_ids(spark):
    df = spark.createDataFrame([("1", "9_P"), ("2_P", "9"), ("3", None)], "record_id string, target_user_secret_id string")
    assert rows(select.drop_parent_ids(df, "x"), "record_id") == [("2_P",), ("3",)]
    assert rows(select.drop_parent_ids(df.drop("target_user_secret_id"), "x")) == [("1",), ("3",)]
    assert select.drop_parent_ids(df, "resp_form", exempt_prefix="resp").count() == 3


def test_pivot_takes_first_non_null(eav):
    df = eav(("1", "a", None), ("1", "a", "x"), ("1", "a", "y"), ("1", "b", "z"), ("2", "b", "w"), ("2", "c", "v"))
    wide = reshape.eav_to_wide(df, ["a", "b", "missing"], order_by=["value"])
    assert rows(wide, "record", "a", "b", "missing") == [("1", "x", "z", None), ("2", None, "w", None)]


def test_round_trip(spark):
    df = spark.createDataFrame([("1", "a", None), ("2", "b", 5)], "mrn string, x string, y int")
    long = reshape.wide_to_eav(df, ["mrn"], ordered=True)
    assert [tuple(r) for r in long.collect()] == [("1", "x", "a"), ("2", "x", "b"), ("2", "y", "5")]


def test_default_only_for_absent_fields(eav):
    df = eav(("1", "tag", "mine"), ("1", "name", "n"), ("2", "name", "m"))
    wide = reshape.individual_frame(df, {"name": "nickname"}, {"nickname": None, "tag": "Child", "role": "r"})
    assert rows(wide, "record", "nickname", "tag", "role") == [("1", "n", "mine", "r"), ("2", "m", None, "r")]


def test_first_contact(spark):
    names = [f"contact.{i}.infos.1.{part}" for i in (1, 2) for part in ("contactType", "information")]
    df = spark.createDataFrame(
        [("phone", "1", "email", "a@x"), ("email", "b@x", "email", "c@x"), ("phone", "2", "phone", "3")],
        ", ".join(f"`{n}` string" for n in names),
    )
    assert rows(df.select(reshape.first_contact(df))) == [("a@x",), ("b@x",), (None,)]


def test_role_pairs(spark):
    df = spark.createDataFrame(
        [("1", "a@x", "A", None, "2010-01-01", "10"), ("2", None, None, "b@x", "2011-01-01", "20")],
        "record string, email string, parentfirstname string, email_2 string, dob string, mrn string",
    )
    pairs = reshape.role_pairs(df, fixed.RESPONDER_PAIRINGS)
    got = rows(pairs, "source_record", "participant_type", "resp_email", "resp_fname", "child_dob", "mrn")
    assert got == [("1", "child", "a@x", "A", "2010-01-01", "10"), ("2", "child", "b@x", None, "2011-01-01", "20")]


def test_chunks(spark):
    df = spark.range(1).select(F.lit("1").alias("record_id"), *[F.lit(i).alias(f"c{i}") for i in range(7)])
    assert [c.columns for c in reshape.column_chunks(df, 3)] == [
        ["record_id", "c0", "c1", "c2"], ["record_id", "c3", "c4", "c5"], ["record_id", "c6"]
    ]
    assert len(reshape.column_chunks(df, 7)) == 1


def test_split_columns(spark):
    df = spark.createDataFrame([("1", "e", "v", 2)], "record_id string, redcap_event_name string, good string, bad int")
    valid, unknown = reshape.split_columns(df, ["bad", "absent"])
    assert (valid.columns, unknown.columns) == (
        ["record_id", "redcap_event_name", "good"], ["record_id", "redcap_event_name", "bad"]
    )
    assert reshape.split_columns(df, ["absent"])[1] is None


def test_drop_all_null(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "a int, b string, c string")
    assert select.drop_all_null(df).columns == ["a", "c"]


def test_expand_variants(spark):
    out = select.expand_variants(spark.range(2), "accountType", ["full", "limited"])
    assert rows(out) == [(0, "full"), (0, "limited"), (1, "full"), (1, "limited")]
