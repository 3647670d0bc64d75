from datetime import datetime

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from recordflow.functions import dates, nested, text
from recordflow.operators.select import CodeList, Range


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "dob, age",
    [
        ("2004-02-29", 17),
        (" 2010-02-28 ", 12),
        ("2010-03-01", 11),
        ("2010", None),
        ("2010-1-5", None),
        ("2010-02-30", None),
        ("unknown", None),
    ],
)
def test_age(spark, dob, age):
    assert value(spark, dates.age_years(F.lit(dob), "2022-02-28")) == age


@pytest.mark.parametrize(
    "raw, millis",
    [
        ("2024-01-15T12:00:00.000Z", 0),
        ("2024-01-15T12:00:00.000", 0),
        ("2024-01-15T12:00:00.000000", 0),
        ("2024-01-15T12:00:00.042999", 42),
        ("2024-01-15T12:00:00", 0),
    ],
)
def test_iso_timestamp(spark, raw, millis):
    parsed = F.date_format(dates.iso_timestamp(F.lit(raw)), "yyyy-MM-dd HH:mm:ss.SSS")
    assert value(spark, parsed) == f"2024-01-15 12:00:00.{millis:03d}"


def test_iso_timestamp_rejects_other_text(spark):
    assert value(spark, dates.iso_timestamp(F.lit("15.01.2024"))) is None


@pytest.mark.parametrize(
    "seen, kept",
    [("2024-05-10T08:00:00", True), ("2024-05-09T23:59:59", True), ("2024-05-11T00:00:00", True),
     ("2024-05-08T23:59:59", False), (None, True)],
)
def test_recent(spark, seen, kept):
    assert value(spark, dates.is_recent(F.lit(seen).cast("string"), "2024-05-10")) is kept


@pytest.mark.parametrize(
    "raw, width, padded",
    [("123", 5, "00123"), ("123456", 5, "123456"), ("-7", 4, "-007"), ("", 2, "00"), (None, 5, None)],
)
def test_zero_pad(spark, raw, width, padded):
    assert value(spark, text.zero_pad(F.lit(raw).cast("string"), width)) == padded


@pytest.mark.parametrize(
    "raw, bare",
    [("00123", "123"), ("0", "0"), ("000", "0"), ("abc01", "abc01"), (" 007 ", "7"), ("-05", "-5"), ("+5", "5"),
     ("0" * 3 + "9" * 30, "9" * 30), ("1.50", "1.50"), ("", "")],
)
def test_strip_zeros(spark, raw, bare):
    assert value(spark, text.strip_zeros(F.lit(raw))) == bare


@pytest.mark.parametrize(
    "raw, number",
    [("1", 1), ("1.0", 1), ("0.0", 0), ("100.0", 100), ("7.9", 7), (None, None), ("NaN", None), ("x", None)],
)
def test_instance(spark, raw, number):
    assert value(spark, text.to_instance(F.lit(raw).cast("string"))) == number


def test_composite_key(spark):
    df = spark.createDataFrame(
        [("12345", "3", True), ("67890", "2", False), ("1", None, True)], "record string, status string, response boolean"
    )
    keyed = text.with_composite_key(df, ["record", "status", "response"])
    assert rows(keyed, "cache_key") == [("12345:3:1",), ("1::1",), ("67890:2:0",)]


def test_short_md5(spark):
    assert value(spark, text.short_md5(F.lit("hello world"))) == "5eb63bbbe01e"
    assert value(spark, text.short_md5(F.lit("hello world"), 8)) == "5eb63bbb"


def test_sanitize(spark):
    dirty = "a\r\nb\x1b[31mred\x1b[0m\x1b]0;title\x07\x00c  ​d\te\x7f\x1b"
    assert value(spark, text.sanitize(F.lit(dirty))) == "abredcde"


def test_redact(spark):
    assert value(spark, text.redact(F.lit("sécret"))) == "█" * 6
    assert value(spark, text.redact(F.lit(""))) == "█"


@pytest.mark.parametrize(
    "message, answer, field",
    [
        ('Red: "Yes" to Difficulty concentrating parent_baseline', "Yes", "alerts_parent_baseline"),
        ('Red: "a: "b" to c" to d Item_1', 'a: "b', "alerts_item_1"),
        ("no quotes here", None, None),
        ('Red: "Yes" to', None, None),
    ],
)
def test_alert_message(spark, message, answer, field):
    assert value(spark, text.alert_answer(F.lit(message))) == answer
    assert value(spark, text.alert_field(F.lit(message))) == field


@pytest.mark.parametrize(
    "field, instrument",
    [("amas_sr_14_complete", "amas_sr"), ("cbcl_p_complete", "cbcl_p"), ("x_complete_y", "x_complete_y")],
)
def test_strip_complete(spark, field, instrument):
    assert value(spark, text.strip_complete(F.lit(field))) == instrument


@pytest.mark.parametrize(
    "pattern, good, bad",
    [
        (text.UUID_PATTERN, "0a1b2c3d-0a1b-2c3d-4e5f-0a1b2c3d4e5f", "0a1b2c3d-0a1b2c3d4e5f-0a1b2c3d4e5f"),
        (text.ISO_8601_PATTERN, "2024-01-15T12:00:00.5+02:00", "2024-01-15 12:00:00"),
        (text.SEMVER_PATTERN, "v1.2.3-rc1", "1.2"),
    ],
)
def test_patterns(spark, pattern, good, bad):
    assert value(spark, text.matches(F.lit(good), pattern))
    assert not value(spark, text.matches(F.lit(bad), pattern))


def test_range():
    assert str(Range(11, 18, True, False)) == "[11, 18)"


@pytest.mark.parametrize("age, inside", [(10, False), (11, True), (17, True), (18, False)])
def test_range_bounds(spark, age, inside):
    assert value(spark, Range(11, 18, True, False).contains(F.lit(age))) is inside


def test_code_list(spark):
    codes = CodeList("f", {"No": "0", "Yes": "1"})
    assert codes["Yes"] == "1"
    assert value(spark, codes.encode(F.lit("No"))) == "0"
    assert value(spark, codes.encode(F.lit("Maybe"))) is None
    assert value(spark, codes.decode(F.lit("1"))) == "Yes"
    with pytest.raises(KeyError):
        codes.matches("Maybe")


def test_pair_items(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b"], ["x"]), (2, ["c"], ["y", "z"]), (3, ["d"], None), (4, [], ["q"])],
        "id int, items array<string>, answers array<string>",
    )
    pairs = df.select("id", F.inline(nested.pair_items(F.col("items"), F.col("answers"))))
    assert rows(pairs) == [(1, 0, "a", "x"), (1, 1, "b", None), (2, 0, "c", "y"), (3, 0, "d", None)]


@pytest.mark.parametrize(
    "raw, member, content",
    [("3", "single_value", 3), ('"abc"', "text", "abc"), ("[1,2]", "value", ["1", "2"]), ("null", "null_value", True),
     (None, "null_value", True), ("2.5", "raw_value", "2.5")],
)
def test_response_value(spark, raw, member, content):
    union = value(spark, nested.response_value(F.lit("t"), F.lit(raw).cast("string")))
    assert union[member] == content
    filled = [m for m in ("single_value", "text", "value") if union[m] is not None]
    assert filled == ([member] if member in ("single_value", "text", "value") else [])


def test_outbound_body(spark):
    df = spark.createDataFrame(
        [("a", None, ["only"], ["3", "1", "2"]), ("b", 'q"', ["x", "y"], ["1"])],
        "name string, nick string, tags array<string>, parent_involvement array<string>",
    )
    assert rows(df.select(nested.outbound_body(df))) == [
        ('{"name":"a","tags":"only","parent_involvement":["1","2","3"]}',),
        ('{"name":"b","nick":"q\\"","tags":["x","y"],"parent_involvement":["1"]}',),
    ]


def test_account_route(spark):
    routes = [value(spark, nested.account_route(F.lit(kind))) for kind in ("full", "limited", "other")]
    assert routes == ["respondent", "shell-account", None]


def test_camel_case(spark):
    df = spark.createDataFrame(
        [("s", ("b", "p"), [("k",)])],
        "secret_id string, encryption struct<account_id:string,public_key:string>, item_list array<struct<item_id:string>>",
    )
    named = nested.camel_case(df)
    assert named.columns == ["secretId", "encryption", "itemList"]
    row = named.first()
    assert (row.encryption.accountId, row.itemList[0].itemId) == ("b", "k")


def test_as_timestamp(spark):
    for given in (datetime(2024, 1, 1), "2024-01-01T00:00:00", "2024-01-01T00:00:00Z"):
        assert value(spark, F.date_format(dates.as_timestamp(given), "yyyy-MM-dd HH")) == "2024-01-01 00"
