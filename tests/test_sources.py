import os

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from recordflow.session import MAX_LITERAL_ROWS, literal_table, shared_dir
from recordflow.sources import scan, sink


def test_csv_keeps_zeros(spark, tmp_path):
    (tmp_path / "a.csv").write_text("mrn,n,empty\n001,007,\n010,008,x\n")
    pinned = scan.read_csv_pinned(spark, str(tmp_path / "a.csv"))
    assert rows(pinned) == [("001", 7, None), ("010", 8, "x")]
    assert rows(scan.read_csv(spark, str(tmp_path / "a.csv"), "mrn string, n string, empty string"), "n") == [("007",), ("008",)]


def test_results_are_unwrapped(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"result": [{"id": "1"}, {"id": "2"}], "count": 2}\n{"result": []}\n')
    assert rows(scan.read_results(spark, str(tmp_path / "a.json"), "id string")) == [("1",), ("2",)]


def test_instrument_files(spark, tmp_path):
    for name in ("ASR", "cbcl", "unknown"):
        (tmp_path / f"{name}.csv").write_text(f"record_id,x\n{name[0]},1\n")
    known = spark.createDataFrame([("asr",), ("CBCL",), ("absent",)], "instrument_name string")
    out = scan.read_instruments(spark, str(tmp_path), "record_id string, x int", known)
    assert rows(out, "record_id", "instrument") == [("A", "ASR"), ("c", "cbcl")]


def test_any_filled(spark, eav):
    df = eav(("1", "a", ""), ("1", "b", "x"), ("2", "a", ""), ("2", "b", None), ("3", "c", "y"))
    assert rows(scan.export_eav(df, ["a", "b"], "any"), "record", "field_name") == [("1", "a"), ("1", "b")]
    assert scan.export_eav(df, ["a", "b"]).count() == 4
    wide = spark.createDataFrame([("1", "", "x"), ("2", "", None)], "record_id string, a string, b string")
    assert rows(scan.export_flat(wide, ["a", "b", "zz"], match="any")) == [("1", "", "x")]
    assert rows(scan.flat_to_long_export(wide, ["b"])) == [("1", "b", "x")]


def test_tolerant_select(spark):
    df, missing = scan.tolerant_select(spark.range(1), ["id", "nope"])
    assert (df.columns, missing) == (["id"], ["nope"])


def test_filter_reaches_the_scan(spark, capsys):
    wide = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    scan.export_flat(wide, ["o_orderstatus"], F.col("o_orderpriority") == "5-LOW", keys=("o_orderkey",)).explain()
    plan = capsys.readouterr().out
    assert "EqualTo(o_orderpriority,5-LOW)" in plan and "o_totalprice" not in plan


def test_fan_out_appends(spark):
    base = shared_dir(spark, "targets")
    targets = {"a": f"{base}/a", "b": f"{base}/b"}
    assert sink.fan_out(spark.range(5), targets) == 5
    assert sink.fan_out(spark.range(5, 8), targets) == 3
    assert rows(spark.read.parquet(f"{base}/a"), "id") == rows(spark.read.parquet(f"{base}/b"), "id") == [(i,) for i in range(8)]


def test_groups_and_log(spark):
    path = shared_dir(spark, "out")
    sink.per_instrument(spark.createDataFrame([("asr_redcap", 1), ("cbcl", 2)], "instrument string, x int"), path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["instrument=asr", "instrument=cbcl"]
    log = shared_dir(spark, "log")
    error = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS datetime, CAST(NULL AS STRING) AS mrn, 'bad' AS error, 'push' AS attempt")
    for _ in range(2):
        sink.append_error_log(error, log)
    back = spark.read.option("sep", "\t").option("header", True).csv(log)
    assert rows(back) == [("2024-01-01T00:00:00.000000", "N/A", "bad", "push")] * 2


def test_only_small_literal_tables_are_hinted(spark):
    def hinted(count):
        plan = literal_table(spark, ["a"], [("x",)] * count)._jdf.queryExecution().analyzed().toString()
        return "broadcast" in plan.lower()

    assert hinted(2) and not hinted(MAX_LITERAL_ROWS + 1)
    assert literal_table(spark, ["a"], [("x",)] * (MAX_LITERAL_ROWS + 1)).count() == MAX_LITERAL_ROWS + 1


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
