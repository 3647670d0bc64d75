import pytest
from frame_rows import rows

from recordflow.session import shared_dir
from recordflow.sources import cell_types, scan
from recordflow.sources.csv_folder import CsvFolder
from recordflow.sources.journal import Journal


@pytest.mark.parametrize(
    "cells,kind",
    [
        ([], "string"),
        (["", None], "string"),
        (["007", "-2", None], "int"),
        (["1", "2147483648"], "bigint"),
        (["1", "99999999999999999999"], "string"),
        (["1", ".5", "1e3", "2."], "double"),
        (["1.5", "x"], "string"),
        (["1", " 2"], "string"),
        (["2024-02-29"], "date"),
        (["2023-02-29"], "string"),
        (["2024-02-29", "2024-02-29T01:02:03.5Z"], "timestamp"),
        (["2024-02-29", "1"], "string"),
        (["true", "FALSE", ""], "boolean"),
        (["true", "1"], "string"),
    ],
)
def test_type_of_cells(spark, cells, kind):
    df = spark.createDataFrame([(c,) for c in cells], "a string")
    bits = df.agg(*cell_types.kinds(["a"])).first()[0]
    assert cell_types.type_of(bits).simpleString() == kind
    # Kinds of parts give those of the whole, and a part taken twice changes nothing.
    parts = [spark.createDataFrame([(c,)], "a string").agg(*cell_types.kinds(["a"])).first()[0] for c in cells]
    assert cell_types.type_of(sum({1 << i for p in parts for i in range(7) if p >> i & 1})).simpleString() == kind


def test_pinned_read_parses_once(spark, tmp_path, capsys):
    (tmp_path / "a.csv").write_text("mrn,a b,x.y,day,none\n001,1,true,2024-01-02,\n002,2.5,,,\n")
    out = scan.read_csv_pinned(spark, str(tmp_path))
    assert out.dtypes == [("mrn", "string"), ("a b", "double"), ("x.y", "boolean"), ("day", "date"), ("none", "string")]
    assert [r[:3] for r in rows(out)] == [("001", 1.0, True), ("002", 2.5, None)]
    out.explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and "FileScan csv" not in plan
    # Nothing reads the files again.
    (tmp_path / "a.csv").unlink()
    assert out.count() == 2


def test_header_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("mrn,n\n")
    out = scan.read_csv_pinned(spark, str(tmp_path))
    assert out.dtypes == [("mrn", "string"), ("n", "string")] and out.isEmpty()


def test_folder_follows_its_files(spark, tmp_path):
    folder = CsvFolder(Journal(spark, shared_dir(spark, "types")), "load", str(tmp_path), ["mrn", "n"], ["mrn"])

    def land(name, text):
        (tmp_path / f"{name}.csv").write_text("mrn,n\n" + text)

    def taken():
        return [r.row_count for r in folder.journal.lines().where("target = 'load_cells'").orderBy("number").collect()]

    land("a", "001,1\n002,\n")
    land("empty", "")
    assert folder.run("r1", "2024-01-01T00:00:00")
    assert folder.read().dtypes == [("mrn", "string"), ("n", "int")]
    land("b", "003,1.5\n")
    folder.run("r2", "2024-01-01T00:01:00")
    folder.run("r3", "2024-01-01T00:02:00")
    assert taken() == [2, 1, 0]
    assert rows(folder.read()) == [("001", 1.0), ("002", None), ("003", 1.5)]
    # A changed file is parsed again, one that is gone counts no more, also for the types.
    land("b", "003,77777777777\n")
    folder.run("r4", "2024-01-01T00:03:00")
    assert rows(folder.read()) == [("001", 1), ("002", None), ("003", 77777777777)]
    (tmp_path / "b.csv").unlink()
    assert folder.read().dtypes == [("mrn", "string"), ("n", "int")]
    assert not folder.run("r4", "2024-01-01T00:04:00")


def test_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,mrn\n1,001\n")
    folder = CsvFolder(Journal(spark, shared_dir(spark, "types")), "load", str(tmp_path), ["mrn", "n"])
    with pytest.raises(Exception, match="header"):
        folder.run("r1", "2024-01-01T00:00:00")
