from collections import defaultdict
from random import Random

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from recordflow.operators import dedup, keys, upsert

RI = "survey"


def latest(df):
    return dedup.latest_instance(df, ["value"])


def test_latest_instance_keeps_whole_instance(eav):
    df = eav(
        *[("1", "pi", v, None, RI, 1) for v in ("1", "2")], ("1", "email", "old", None, RI, 1),
        *[("1", "pi", v, None, RI, 2) for v in ("1", "2")], ("1", "email", "new", None, RI, 2),
    )
    assert rows(latest(df), "field_name", "value") == [("email", "new"), ("pi", "1"), ("pi", "2")]


def test_latest_instance_with_fewer_rows(eav):
    df = eav(*[("1", "pi", v, None, RI, 1) for v in "012"], *[("1", "pi", v, None, RI, 2) for v in "13"])
    assert rows(latest(df), "value") == [("1",), ("3",)]


def test_non_repeated_once_per_field(eav):
    df = eav(("1", "dob", "b"), ("1", "dob", "a"), ("1", "email", "e"), *[("1", "pi", v, None, RI, 1) for v in "012"])
    out = latest(df)
    assert rows(out, "field_name", "value") == [("dob", "a"), ("email", "e"), ("pi", "0"), ("pi", "1"), ("pi", "2")]
    assert out.columns == ["record", "field_name", "value", "redcap_event_name"]


def test_latest_instance_hot_record(spark):
    """A third of all rows in one record, compared with a plain computation."""
    random = Random(7)
    facts = [
        ("hot" if random.random() < 0.34 else f"r{random.randrange(50)}", f"f{random.randrange(5)}", str(i), None,
         random.choice(["A", "B"]), random.randrange(1, 9))
        for i in range(3000)
    ]
    best = defaultdict(int)
    for f in facts:
        best[f[0], f[4]] = max(best[f[0], f[4]], f[5])
    expected = sorted((f[0], f[1], f[2]) for f in facts if f[5] == best[f[0], f[4]])
    from recordflow.schemas import EAV_SCHEMA

    got = latest(spark.createDataFrame(facts, EAV_SCHEMA))
    assert sorted(map(tuple, got.select("record", "field_name", "value").collect())) == expected


@pytest.mark.parametrize("by", [["k"], []])
def test_running_number_hot_key(spark, by):
    random = Random(3)
    data = [("hot" if random.random() < 0.4 else f"k{random.randrange(30)}", random.randrange(10**6), i) for i in range(5000)]
    data.append((None, 5, -1))
    expected, count = [], defaultdict(int)
    for row in sorted(data, key=lambda r: ((r[0] or "") if by else "", r[1], r[2])):
        count[row[0] if by else 0] += 1
        expected.append((*row, count[row[0] if by else 0]))
    numbered = dedup.running_number(spark.createDataFrame(data, "k string, o int, i int"), by, ["o", "i"])
    assert sorted(map(tuple, numbered.collect()), key=repr) == sorted(expected, key=repr)


def test_running_number_spans_chunks(spark):
    """Keys over several chunks, keys that end where a chunk does, no rows, and the input computed once."""
    count = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            count.add(len(batch))
            yield batch

    data = spark.range(20_000).selectExpr("id % 2 AS k", "id AS o", "CAST(NULL AS INT) AS number_of").mapInPandas(seen, "k long, o long, number_of int")
    got = dedup.running_number(data, ["k"], ["o"])
    assert got.where("number <> 1 + (o - k) / 2").isEmpty() and got.count() == 20_000
    assert count.value <= 2 * 20_000  # once to place the range boundaries, once to write
    everything = dedup.running_number(spark.range(1000).withColumnRenamed("id", "o"), [], ["o"], "n")
    assert everything.where("n <> o + 1").isEmpty() and everything.count() == 1000
    assert dedup.running_number(spark.range(0), [], ["id"]).isEmpty()


def test_keep_one_reduces_before_the_shuffle(spark, capsys):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    dedup.keep_one(df, ["k"], ["id"]).explain()
    assert "WindowGroupLimit [k" in capsys.readouterr().out
    assert rows(dedup.keep_one(df, ["k"], ["id"]), "id") == [(0,), (1,), (2,)]
    assert rows(dedup.keep_one(df, ["k"], ["id"], keep="last"), "id") == [(97,), (98,), (99,)]


def test_keep_one_nulls_last(spark):
    df = spark.createDataFrame([("e", None), ("e", "a"), ("f", None)], "email string, name string")
    assert rows(dedup.keep_one(df, ["email"], ["name"])) == [("e", "a"), ("f", None)]


def test_changed_rows(spark):
    incoming = spark.createDataFrame(
        [("1", "e", "a", 1), ("2", "e", None, 2), ("3", "e", "c", 3), ("4", "e", "d", 4)],
        "record_id string, event string, x string, y int",
    )
    existing = spark.createDataFrame(
        [(1, "e", "a", "1"), (2, "e", "", "2"), (4, "e", "old", "4"), (4, "e", "d", "4")],
        "record_id int, event string, x string, y string",
    )
    out = dedup.changed_rows(incoming, existing.withColumn("n", F.when(F.col("x") == "d", 2).otherwise(1)),
                             ["record_id", "event"], ["x", "y"], ["n"])
    assert rows(out, "record_id") == [("2",), ("3",)]


def test_table_hash(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    b = spark.createDataFrame([(None, 2), ("x", 1)], "b string, a int")
    twice = a.unionByName(a)
    digest = lambda df: dedup.table_hash(df).first()["content_hash"]
    assert digest(a) == digest(b) and len(digest(a)) == 12
    assert digest(a) != digest(twice) and digest(a) != digest(a.fillna(""))


def test_summary_flags(eav):
    df = eav(
        ("1", "alerts_asr_1", "1", "e"), ("1", "alerts_asr_2", "1", "e"), ("1", "alerts_parent_base_3", "1", "e"),
        ("1", "alerts_a_b_c_4", "1", "e"), ("1", "mrn", "9", "e"),
    ).drop("redcap_repeat_instrument", "redcap_repeat_instance")
    flags = dedup.summary_flags(df).where("value = 'yes'")
    assert rows(flags, "record", "field_name", "redcap_event_name") == [
        ("1", "asr_alerts", "e"), ("1", "parent_base_alerts", "e")
    ]


@pytest.mark.parametrize(
    "outcomes, status, line",
    [
        ([("a", 3, True), ("b", 2, True)], "success", '{"status":"success","successes":5,"failures":0}'),
        ([("a", 3, True), ("b", 2, False)], "failure", '{"status":"failure","successes":3,"failures":1}'),
        ([("a", 0, True)], "no data", '{"status":"no data","successes":0,"failures":0}'),
    ],
)
def test_run_results(spark, outcomes, status, line):
    row = dedup.run_results(spark.createDataFrame(outcomes, "instrument string, rows long, ok boolean")).first()
    assert (row.status, row.exit_line) == (status, line)


def test_next_instance(spark):
    people = spark.createDataFrame([("1", "a", 1), ("1", "a", 2), ("2", "b", 3)], "record string, resp_email string, o int")
    existing = spark.createDataFrame([("1", 4), ("1", 2)], "record string, redcap_repeat_instance int")
    assert rows(dedup.next_instance(people, existing, ["o"]), "o", "redcap_repeat_instance") == [(1, 5), (2, 6), (3, 1)]
    assert rows(dedup.next_instance(people, None, ["o"]), "o", "redcap_repeat_instance") == [(1, 1), (2, 2), (3, 1)]


# ---------------------------------------------------------------- joins


def test_split_updates(spark):
    incoming = spark.createDataFrame([(12345, 12345, "a"), (67890, 67890, "b"), (99001, 99001, "c")],
                                     "record_id int, mrn int, email_consent string")
    target = spark.createDataFrame([(12345, 1), (67890, 2), (67890, 1)], "mrn int, record_id int")
    update, insert, repeated = keys.split_updates(incoming, target, order_by=["record_id"])
    assert rows(update, "record_id", "mrn") == [(1, 12345), (2, 67890)]
    assert rows(insert, "mrn") == [(99001,)]
    assert rows(repeated) == [(67890, 2)]


def test_id_map_keeps_leading_zeros(eav):
    ids = keys.id_map(eav(("1", "mrn", " 001234 "), ("2", "mrn", "007"), ("3", "mrn", "007")), order_by=["record"])
    kept, lost = keys.map_ids_inner(eav(("001234", "f", "a"), ("007", "f", "b"), ("7", "f", "c")), ids)
    assert rows(kept, "record", "value") == [("1", "a"), ("3", "b")]
    assert rows(lost, "record") == [("7",)]


def test_anti_all_columns(spark):
    new = spark.createDataFrame([("1", None), ("2", "a"), ("2", "b")], "r string, v string")
    old = spark.createDataFrame([("x", "1", None), ("x", "2", "a")], "z string, r string, v string")
    assert rows(keys.anti_all_columns(new, old)) == [("2", "b")]
    assert keys.anti_all_columns(new, old.limit(0)).count() == 3
    assert keys.anti_all_columns(new.limit(0), old).count() == 0


def test_remap_to_field(eav):
    df = eav(("a", "mrn", "10"), ("a", "record_id", "a"), ("b", "x", "v"), ("b", "record_id", "b"))
    assert rows(keys.remap_to_field(df), "record", "field_name", "value") == [
        ("10", "mrn", "10"), ("10", "record_id", "10"), ("b", "record_id", "b"), ("b", "x", "v")
    ]


def test_enrich_events_default(eav):
    context = eav(("1", "b", "x", "arm_b"), ("1", "a", "x", "arm_a"), ("2", "b", "x", "arm_z"))
    out = keys.enrich_events(eav(("1", "b", "v"), ("1", "c", "v")), context, ["record"])
    assert rows(out, "field_name", "redcap_event_name") == [("b", "arm_b"), ("c", "arm_a")]


def test_split_by_email(spark):
    people = spark.createDataFrame([(" A@x ",), ("b@x",), (None,)], "resp_email string")
    known = spark.createDataFrame([(7, "a@X"), (8, "c@x")], "record int, resp_email string")
    create, update = keys.split_by_email(people, known)
    assert rows(create, "resp_email") == [("b@x",), (None,)]
    assert rows(update, "resp_email", "record") == [(" A@x ", 7)]


def test_answered_only(spark):
    invited = spark.createDataFrame([("1",), ("2",)], "respondent_id string")
    answers = spark.createDataFrame([("2", "yes"), ("9", "no")], "respondent_id string, a string")
    assert rows(keys.answered_only(invited, answers)) == [("2", "yes")]
    assert rows(keys.answered_only(invited, answers.where("a = 'no'"))) == [("1", None), ("2", None)]
    assert rows(keys.answered_only(invited, answers, keep_unanswered=True)) == [("1", None), ("2", "yes")]


def test_tracked_rename(eav, spark):
    tracked = spark.createDataFrame([("amas_sr_received",)], "field_name string")
    matched, rest = keys.tracked_rename(eav(("1", "amas_sr_14_complete", "1"), ("1", "zzz_complete", "1")), tracked)
    assert rows(matched, "field_name") == [("amas_sr_received",)]
    assert rows(rest, "field_name") == [("zzz_complete",)]


# ---------------------------------------------------------------- upserts


def test_eav_upsert_replaces_sets(eav):
    target = eav(("1", "pi", "0", "e"), ("1", "pi", "1", "e"), ("1", "dob", "d", "e"), ("1", "pi", "7", None))
    source = eav(("1", "pi", "2", "e"), ("1", "pi", "3", "e"), ("1", "dob", "", "e"), ("2", "pi", "4", "e"))
    assert rows(upsert.eav_upsert(target, source), "record", "field_name", "value") == [
        ("1", "dob", "d"), ("1", "pi", "2"), ("1", "pi", "3"), ("1", "pi", "7"), ("2", "pi", "4")
    ]


def test_flat_upsert_blanks_do_not_overwrite(spark):
    target = spark.createDataFrame([("1", "a", 1), ("2", "b", 2)], "id string, x string, y int")
    source = spark.createDataFrame([("1", "", 9, "z"), ("3", "c", None, "")], "id string, x string, y int, w string")
    assert rows(upsert.flat_upsert(target, source, ["id"])) == [
        ("1", "a", 9, "z"), ("2", "b", 2, None), ("3", "c", None, None)
    ]


def test_auto_number(spark):
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    target = spark.createDataFrame([("3",), ("x",), ("12",)], "record_id string")
    assert rows(upsert.auto_number(new, target, ["name"]), "name", "record_id") == [("a", 13), ("b", 14)]
    assert rows(upsert.auto_number(new, target.limit(0), ["name"]), "record_id") == [(1,), (2,)]
