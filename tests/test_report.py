import pytest
from pyspark.sql import functions as F

from conftest import CATALOG
from recordloom.operators.catalog import MISSING_BODY
from recordloom.operators.quality import STAR_CODE, error_breakdown, summary_counts
from recordloom.operators.report import REPORT, report_parts, validate_files
from recordloom.sources.catalog import read_catalog_files


@pytest.fixture(scope="module")
def report(spark):
    return validate_files(read_catalog_files(spark, CATALOG)).cache()


def test_every_file_has_one_row(report):
    got = {r["path"]: r for r in report.collect()}
    assert report.columns == REPORT and report.count() == len(got) == 7
    passed = {p for p, r in got.items() if r["status"] == "passed"}
    assert passed == {"greeting.yaml", "shapes/area.yml"}
    skipped = got["tables/list.yaml"]
    assert (skipped["status"], skipped["stage"], skipped["errors"]) == ("skipped", None, [])
    assert got["tables/unreadable.yaml"]["stage"] == "load"
    assert got["tables/unreadable.yaml"]["errors"] == ["Unexpected error: ParserError"]
    assert (got["tables/nobody.yaml"]["stage"], got["tables/nobody.yaml"]["errors"]) == ("schema", [MISSING_BODY])
    broken = got["tables/deep/broken.yaml"]
    assert broken["stage"] == "render" and broken["errors"][0].startswith("Generation failed: ")
    star = got["shapes/star.yaml"]
    assert star["stage"] == "code" and star["pattern_id"] == "shapes.star" and STAR_CODE in star["errors"][0]


def test_the_report_feeds_the_summaries(report):
    judged = report.filter(F.col("status") != "skipped")
    assert tuple(summary_counts(judged).first())[:3] == (6, 2, 4)
    classes = {r["error_type"]: r["n"] for r in error_breakdown(judged).collect()}
    assert classes["exception"] == 1 and classes["linter"] == 1
    parts = {(r["status"], r["stage"]): (r["n_files"], r["n_errors"]) for r in report_parts(report).collect()}
    assert parts[("passed", None)] == (2, 0) and parts[("failed", "render")] == (1, 1)


def test_validators_of_the_caller_and_an_empty_catalog(spark):
    texts = read_catalog_files(spark, CATALOG)
    strict = validate_files(texts, [F.when(~F.contains("code", F.lit("import")), "no import")])
    got = {r["path"]: r["errors"] for r in strict.collect()}
    assert got["greeting.yaml"] == ["no import"]
    assert validate_files(texts.limit(0)).count() == 0
    # an empty text holds no mapping, a null one cannot be loaded; rows that repeat are reported one by one
    odd = spark.createDataFrame([("a", ""), ("b", None), ("b", None)], "path string, yaml_text string")
    assert sorted(tuple(r) for r in validate_files(odd).select("path", "status", F.coalesce("stage", F.lit(""))).collect()) == [
        ("a", "skipped", ""), ("b", "failed", "load"), ("b", "failed", "load")
    ]
