import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from recordloom.plans import derived
from recordloom.sources import files
from recordloom.sources.catalog import read_catalog_files


def test_fixed_records_drop_the_cut_off_tail(spark, tmp_path):
    values = np.arange(10 * 4 + 3, dtype="<u4") + 4_000_000_000
    values.tofile(tmp_path / "a.bin")
    np.arange(3, dtype="<u4").tofile(tmp_path / "short.bin")
    got = files.read_fixed(spark, str(tmp_path), "uint32", 4).orderBy("record_no").collect()
    assert [r["record_no"] for r in got] == list(range(10))
    assert [r["items"] for r in got] == values[:40].reshape(-1, 4).tolist()


@pytest.mark.parametrize("dtype", ["float", "double", "int", "bigint"])
def test_fixed_round_trip_in_ranges(spark, tmp_path, dtype, monkeypatch):
    monkeypatch.setattr(files, "_RANGE_BYTES", 64)
    df = spark.range(50).select(F.array(*[(F.col("id") + i).cast(dtype) for i in range(3)]).alias("v"))
    path = str(tmp_path / "out")
    assert files.write_fixed(df.repartition(3), "v", dtype, path) == 50
    assert files.write_fixed(df.repartition(3), "v", dtype, path) == 50  # parts are replaced, not doubled
    back = files.read_fixed(spark, path, dtype, 3)
    assert sorted(r["items"] for r in back.collect()) == sorted(r["v"] for r in df.collect())


def test_fixed_writes_leave_files_of_others(spark, tmp_path):
    df = spark.range(4).select(F.array("id").alias("v"))
    for name in ("part-00000.parquet", "notes.txt"):
        other = tmp_path / name.split(".")[1]
        other.mkdir()
        (other / name).write_text("kept")
        with pytest.raises(FileExistsError):
            files.write_fixed(df, "v", "bigint", str(other))
        assert [f.name for f in other.iterdir()] == [name]
    empty = tmp_path / "empty"
    empty.mkdir()
    assert files.write_fixed(df.limit(0), "v", "bigint", str(empty)) == 0
    assert files.read_fixed(spark, str(empty), "bigint", 1).count() == 0
    written = tmp_path / "own"
    files.write_fixed(df, "v", "bigint", str(written))
    (written / "added.txt").write_text("kept")
    with pytest.raises(FileExistsError):
        files.write_fixed(df, "v", "bigint", str(written))
    assert sorted(f.name for f in tmp_path.iterdir()) == ["empty", "own", "parquet", "txt"]  # no stage is left


def test_csv(spark, tmp_path):
    schema = T.StructType([T.StructField("value", T.IntegerType()), T.StructField("name", T.StringType())])
    df = spark.createDataFrame([('a "q", b', 1), ("é", 2)], "name string, value int")
    path = str(tmp_path / "csv")
    files.write_csv(df, path)
    assert rows(files.read_csv(spark, path, schema)) == rows(df.select("value", "name"))
    wrong = T.StructType([T.StructField("absent", T.StringType())])
    with pytest.raises(ValueError, match="absent"):
        files.read_csv(spark, path, wrong)


def test_lines(spark, tmp_path):
    (tmp_path / "log.txt").write_text("ok\nERROR: one\n\nERROR two\r\nlast")
    lines = files.scan_lines(spark, str(tmp_path / "log.txt"))
    assert tuple(files.count_matching(lines, "ERROR").first()) == (5, 2)


def test_jsonl_keys_in_order(spark, tmp_path):
    df = spark.createDataFrame([("do\nit", "", "x = 1")], "instruction string, input string, output string")
    path = tmp_path / "jsonl"
    files.write_jsonl(df.coalesce(1), str(path))
    line = next(path.glob("part-*")).read_text().strip()
    assert list(json.loads(line)) == ["instruction", "input", "output"]
    assert rows(files.read_jsonl(spark, str(path), df.schema)) == rows(df)


def test_versions_are_immutable(spark, tmp_path):
    base = str(tmp_path / "v")
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    files.write_version(df, base, "v1")
    with pytest.raises(Exception):
        files.write_version(df, base, "v1")
    files.write_version(df.select("b", "a").withColumn("a", F.lit(9)), base, "v2")
    assert rows(files.read_version(spark, base, "v1", ["a", "b"])) == [(1, 2.0)]
    assert rows(files.read_version(spark, base, "v2", ["a", "b"])) == [(9, 2.0)]


def test_equal_names_are_counted(spark, tmp_path):
    for folder in ("a", "b/c"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "same.txt").write_text(folder)
    (tmp_path / "one.txt").write_text("x")
    got = {r["name"]: (r["path"], r["n_paths"]) for r in files.list_files(spark, str(tmp_path)).collect()}
    assert got["same.txt"][1] == 2 and got["same.txt"][0].endswith("/b/c/same.txt")
    assert got["one.txt"][1] == 1


def test_nested_metrics(spark, tmp_path):
    df = spark.sql("SELECT named_struct('acc', 0.5D, 'per', map('a', 1)) AS report, 3 AS n")
    path = tmp_path / "m"
    files.write_metrics(df, str(path))
    line = next(path.glob("part-*")).read_text()
    assert json.loads(line) == {"report": {"acc": 0.5, "per": {"a": 1}}, "n": 3}


def test_csv_line_breaks_and_headers(spark, tmp_path):
    schema = "id int, text string"
    df = spark.createDataFrame([(1, 'two\nlines "quoted", é'), (2, "plain")], schema)
    files.write_csv(df, f"{tmp_path}/a")
    assert sorted(map(tuple, files.read_csv(spark, f"{tmp_path}/a", df.schema, multi_line=True).collect())) == sorted(map(tuple, df.collect()))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "1.csv").write_text("name,value\nx,1\n")
    (tmp_path / "b" / "2.csv").write_text("value,name\n2,y\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, f"{tmp_path}/b", spark.createDataFrame([], "name string, value string").schema).collect()


def test_fixed_records_are_not_mixed_with_an_earlier_write(spark, tmp_path):
    df = spark.createDataFrame([([1.0, 2.0],)] * 50, "v array<double>")
    for tasks in (6, 2):
        assert files.write_fixed(df.repartition(tasks), "v", "double", f"{tmp_path}/f") == 50
        assert files.read_fixed(spark, f"{tmp_path}/f", "double", 2).count() == 50


def test_texts_are_one_file_per_name_and_task(spark, tmp_path):
    path = str(tmp_path / "texts")
    data = [("a/x", "one"), ("b/y", "two\nlines"), ("a/x", "again"), ("a/z", "\u00e9")]
    files.write_texts(spark.createDataFrame(data, "name string, text string").coalesce(1), path)
    got = sorted((str(f.relative_to(path)), f.read_text()) for f in (tmp_path / "texts").rglob("*") if f.is_file())
    assert got == [
        ("a/x.00000.txt", "one\nagain\n"), ("a/z.00000.txt", "\u00e9\n"), ("b/y.00000.txt", "two\nlines\n")
    ]
    empty = str(tmp_path / "empty")
    files.write_texts(spark.createDataFrame([], "name string, text string"), empty)
    assert read_catalog_files(spark, empty, "*.txt").count() == 0


def test_many_small_files_need_few_folders_and_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(derived, "scratch_path", lambda *_: str(tmp_path / "patterns"))
    data = [(k, f"Supplier {k}", k % 3, 1.0) for k in range(300)] + [(None, "Supplier", None, 1.0)]
    spark.createDataFrame(data, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").coalesce(1).write.parquet(
        str(tmp_path / "supplier.parquet")
    )
    want = {f"nation={k % 3}/file={k}" for k in range(300)}
    want.add("nation=__HIVE_DEFAULT_PARTITION__/file=__HIVE_DEFAULT_PARTITION__")
    found = derived.supplier_files(spark, str(tmp_path))
    assert {r["path"] for r in found.collect()} == want and found.count() == 301
    assert len([d for d in (tmp_path / "patterns").rglob("*") if d.is_dir()]) == 4
    least = found.rdd.getNumPartitions()
    monkeypatch.setattr("recordloom.sources.catalog.TASKS_PER_CORE", 1)
    few = read_catalog_files(spark, str(tmp_path / "patterns"), "*.txt")
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism < least
    assert few.count() == 301
