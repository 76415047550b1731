"""Files: lenient CSV, fallback paths, optional tables, rewriting in place."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.sources.csv import scan_csv, scan_csv_lenient, with_numbers
from tidemark.sources.tables import Source, load_sources, recover_rewrite, report_name, rewrite_with_columns, write_report_set, write_table


def test_lenient_csv(spark, tmp_path):
    path = tmp_path / "messy.csv"
    path.write_text('﻿name, amount ,,name\n"Big, Co","say ""hi""",x,1\n  spaced  ,"two\nlines",,\n,,,\n\nshort\n', encoding="utf-8")
    df = scan_csv_lenient(spark, str(path))
    assert df.columns == ["name", "amount", "Column 3", "name_2"]
    assert [tuple(r) for r in df.collect()] == [
        ("Big, Co", 'say "hi"', "x", "1"), ("spaced", "two\nlines", None, None), ("short", None, None, None)]


def test_latin1_and_fallback_path(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("name,city\nCafé,São Paulo\n".encode("latin1"))
    assert tuple(scan_csv(spark, str(tmp_path / "absent.csv"), str(path)).first()) == ("Café", "São Paulo")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        scan_csv(spark, str(tmp_path / "absent.csv"))


def test_required_and_optional_sources(spark, tmp_path):
    path = tmp_path / "ok.csv"
    path.write_text("a\n1\n")
    tables, outcome = load_sources(spark, [Source("ok", str(path), True), Source("gone", str(tmp_path / "gone.csv"))])
    assert list(tables) == ["ok"]
    assert {r["id"]: r["error"] for r in outcome.collect()} == {"ok": None, "gone": "PATH_NOT_FOUND"}
    with pytest.raises(ValueError, match="gone"):
        load_sources(spark, [Source("gone", str(tmp_path / "gone.csv"), True)])


def test_rewrite_reads_its_own_path(spark, tmp_path):
    path = write_table(spark.range(5), str(tmp_path / "t"))
    wider = spark.read.parquet(path).withColumn("twice", F.col("id") * 2)
    rewrite_with_columns(wider, path, str(tmp_path / "staging"))
    assert sorted(r["twice"] for r in spark.read.parquet(path).collect()) == [0, 2, 4, 6, 8]


def test_a_rewrite_that_was_cut_off_is_mended(spark, tmp_path):
    path, staging, aside = tmp_path / "t", tmp_path / "s", tmp_path / "s-replaced"
    ids = lambda: sorted(r["id"] for r in spark.read.parquet(str(path)).collect())
    assert recover_rewrite(spark, str(path), str(staging)) == "none"
    # Cut off between the two renames: the new table is complete.
    write_table(spark.range(3), str(aside))
    write_table(spark.range(5), str(staging))
    assert recover_rewrite(spark, str(path), str(staging)) == "new" and ids() == list(range(5)) and not aside.exists()
    # The old table is aside and the new one is not complete.
    write_table(spark.range(3), str(aside))
    path.rename(tmp_path / "gone")
    staging.mkdir()
    assert recover_rewrite(spark, str(path), str(staging)) == "old" and ids() == list(range(3)) and not aside.exists()
    # Cut off before the old one was deleted; a new rewrite starts with the mending.
    write_table(spark.range(2), str(aside))
    rewrite_with_columns(spark.read.parquet(str(path)).withColumn("id", F.col("id") + 10), str(path), str(staging))
    assert ids() == [10, 11, 12] and not aside.exists() and not staging.exists()


def test_report_names(spark, tmp_path):
    assert report_name("Small / early venture-backed segment") == "Small_-_early_venture-backed_se"
    paths = write_report_set({"a/b": spark.range(2)}, str(tmp_path / "r"))
    assert spark.read.csv(paths["a/b"], header=True).count() == 2


def test_numbers_are_decided_by_the_data(spark):
    rows = [("1", "1,000", "a", None, "1e3", "nan"), (" 2.5", "7", "b", "", "4", "3"), (None, "8", "c", " ", "5", "12")]
    df = spark.createDataFrame(rows, "plain string, commas string, word string, empty string, `sci fi.x` string, gap string")
    got = with_numbers(df)
    assert dict(got.dtypes) == {"plain": "double", "commas": "string", "word": "string", "empty": "double",
                                "sci fi.x": "double", "gap": "double"}
    assert [r["gap"] for r in got.collect()] == [None, 3.0, 12.0]


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8", newline="")
    return str(folder)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.mark.parametrize("scan", [scan_csv, scan_csv_lenient])
def test_files_are_read_by_their_own_header(spark, tmp_path, scan):
    path = write(tmp_path / "mixed headers", a="x,y\n1,10\n", b="y,x\n20,2\n", c="z, x \n300,3\n", d="", e="x,y\n", f="\n \nx,y\n4,40\n")
    df = scan(spark, path)
    assert df.columns == ["x", "y", "z"]
    assert rows(df, "x", "y", "z") == [("1", "10", None), ("2", "20", None), ("3", None, "300"), ("4", "40", None)]


@pytest.mark.parametrize("scan", [scan_csv, scan_csv_lenient])
def test_line_ends_inside_cells(spark, tmp_path, scan):
    path = write(tmp_path / "t", a='k,v\n"a\nb",2\n"c ""d""\r\n,e",3\n', b="v,k\n4,plain\n", c='"v","a\nb"\n5,6\n')
    df = scan(spark, path)
    want = [('a\nb', "2", None), ('c "d"\r\n,e', "3", None), (None, "5", "6"), ("plain", "4", None)]
    assert rows(df, "k", "v", "a\nb") == sorted(want, key=str)


def test_only_files_with_open_quotes_are_not_split(spark, tmp_path):
    path = write(tmp_path / "t", a='k,v\n"a\nb",2\n', b="k,v\n" + "x,1\n" * 5000)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        df = scan_csv(spark, path)
        assert df.rdd.getNumPartitions() > 3 and df.count() == 5001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


@pytest.mark.parametrize("scan", [scan_csv, scan_csv_lenient])
def test_long_and_short_records_are_counted_and_kept(spark, tmp_path, scan):
    path = write(tmp_path / "t", a='a,b\n1,2\n3,4,5\n6\n"7,7",8\n', b='b,a\n"9\n9",0,x,\n')
    seen = Observation()
    df = scan(spark, path, counts=seen, record="bad")
    assert rows(df, "a", "b", "bad") == [("0", "9\n9", '"9\n9",0,x,'), ("1", "2", None), ("3", "4", "3,4,5"), ("6", None, "6"), ("7,7", "8", None)]
    assert seen.get == {"rows": 5, "long": 2, "short": 1}
    again = Observation()
    assert scan(spark, path, counts=again).columns == ["a", "b"]
    with pytest.warns(UserWarning, match="1 records"):
        assert scan(spark, path).count() == 5
    clash = write(tmp_path / "u", a="_record,bad\n1\n")
    assert scan(spark, clash, counts=Observation()).collect()[0][0] == "1"


def test_sources_are_split(spark, tmp_path):
    path = write(tmp_path / "t", a="k,v\n" + "x,1\n" * 5000)
    tables, _ = load_sources(spark, [Source("t", path, True)])
    assert "multiLine" not in tables["t"]._jdf.queryExecution().toString() and tables["t"].count() == 5000
