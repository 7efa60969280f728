"""Registered queries: catalog checks over patterns derived from the part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.catalog import catalog_listing, load_stats, normalize_catalog
from ..operators.quality import STAR_CODE, STAR_MESSAGE, error_breakdown, summary_counts
from ..operators.report import report_parts, validate_files
from ..sources.catalog import parse_catalog
from .derived import (
    SUPPLIER_SQL,
    YAML_ERRORS_SQL,
    YAML_PATH_SQL,
    YAML_STATUS_SQL,
    checked_part_yaml,
    part_yaml,
    supplier_files,
)
from .registry import query

_PARSED = "p_size % 10 > 1"


@query(
    "check_catalog",
    f"SELECT {YAML_PATH_SQL} AS path, {YAML_ERRORS_SQL} AS errors FROM part WHERE {_PARSED}",
)
def check_catalog(spark, sf_dir):
    checked = checked_part_yaml(spark, sf_dir).filter(F.col("status") == "parsed")
    return checked.select("path", F.array_join("errors", "|").alias("errors"))


@query(
    "normalize_catalog",
    f"""
    SELECT 'part.' || p_partkey AS pattern_id,
      CASE WHEN p_size % 10 <> 4 THEN 'x = {{{{ n }}}}' || chr(10) || '# ' || p_name || chr(10) END AS definition,
      CASE WHEN p_size % 10 = 3 THEN 'import os' ELSE '' END AS imports,
      CASE WHEN p_size % 10 = 6 THEN 0 ELSE 2 END::BIGINT AS n_params,
      true AS linter_checks, 0::BIGINT AS n_tests, 0::BIGINT AS n_requires
    FROM part WHERE {_PARSED}""",
)
def normalize(spark, sf_dir):
    parsed = parse_catalog(part_yaml(spark, sf_dir)).filter(F.col("status") == "parsed")
    rows = normalize_catalog(parsed)
    return rows.select(
        "pattern_id",
        F.col("components.model_definition").alias("definition"),
        F.col("components.imports").alias("imports"),
        F.size("parameters").cast("long").alias("n_params"),
        "validation.linter_checks",
        F.size("validation.tests").cast("long").alias("n_tests"),
        F.size("requires").cast("long").alias("n_requires"),
    )


_LISTED = f"""
SELECT CASE WHEN p_size % 3 = 0 THEN 'general' ELSE lower(replace(p_brand, '#', '_')) END AS category,
  'part.' || p_partkey AS id, 'About ' || p_name AS description
FROM part WHERE {_PARSED}"""


@query("list_catalog", _LISTED)
def list_catalog(spark, sf_dir):
    return catalog_listing(parse_catalog(part_yaml(spark, sf_dir)))


@query(
    "list_catalog_markdown",
    f"""
    SELECT category, id, '- **`' || id || '`**: ' || description AS line FROM ({_LISTED})
    UNION ALL
    SELECT DISTINCT category, '', '## ' || upper(category[1]) || replace(category[2:], '_', ' ') FROM ({_LISTED})""",
)
def list_catalog_markdown(spark, sf_dir):
    return catalog_listing(parse_catalog(part_yaml(spark, sf_dir)), "markdown")


@query(
    "load_stats",
    f"""
    SELECT count(*) FILTER (WHERE {_PARSED} AND {YAML_ERRORS_SQL} = '') AS loaded,
      count(*) FILTER (WHERE {YAML_STATUS_SQL} = 'error' OR ({_PARSED} AND {YAML_ERRORS_SQL} <> '')) AS errors,
      count(*) FILTER (WHERE {YAML_STATUS_SQL} = 'skipped') AS skipped
    FROM part""",
)
def stats(spark, sf_dir):
    return load_stats(checked_part_yaml(spark, sf_dir))


_SUPPLIER = SUPPLIER_SQL.replace("{code}", STAR_CODE).replace("{message}", STAR_MESSAGE)
_STATUS = "CASE WHEN load_status = 'skipped' THEN 'skipped' WHEN stage IS NULL THEN 'passed' ELSE 'failed' END"


@query(
    "scan_catalog_files",
    f"""
    SELECT path, load_status AS status, pattern_id,
      CASE WHEN load_status = 'error' THEN 'ParserError' END AS error
    FROM ({_SUPPLIER})""",
)
def scan_catalog_files(spark, sf_dir):
    return parse_catalog(supplier_files(spark, sf_dir)).select("path", "status", "pattern_id", "error")


@query(
    "validate_catalog",
    f"""
    SELECT path, pattern_id, {_STATUS} AS status, stage, array_to_string(errors, '|') AS errors
    FROM ({_SUPPLIER})""",
)
def validate_catalog(spark, sf_dir):
    report = validate_files(supplier_files(spark, sf_dir))
    return report.withColumn("errors", F.array_join("errors", "|"))


@query(
    "validate_catalog_parts",
    f"""
    SELECT {_STATUS} AS status, stage, count(*) AS n_files, sum(len(errors))::BIGINT AS n_errors
    FROM ({_SUPPLIER}) GROUP BY 1, 2""",
)
def validate_catalog_parts(spark, sf_dir):
    return report_parts(validate_files(supplier_files(spark, sf_dir)))


@query(
    "validate_catalog_summary",
    f"""
    SELECT total, passed, total - passed AS failed, round(100.0 * passed / total, 1)::DOUBLE AS passed_pct,
      round(100.0 * (total - passed) / total, 1)::DOUBLE AS failed_pct
    FROM (SELECT count(*) AS total, count(*) FILTER (WHERE stage IS NULL) AS passed
      FROM ({_SUPPLIER}) WHERE load_status <> 'skipped')""",
)
def validate_catalog_summary(spark, sf_dir):
    report = validate_files(supplier_files(spark, sf_dir))
    return summary_counts(report.filter(F.col("status") != "skipped"))


@query(
    "validate_catalog_errors",
    f"""
    SELECT CASE stage WHEN 'load' THEN 'exception' ELSE if(contains(e, 'Syntax'), 'syntax', 'linter') END AS error_type,
      count(*) AS n
    FROM (SELECT stage, unnest(errors) AS e FROM ({_SUPPLIER})) WHERE stage IN ('load', 'code') GROUP BY 1""",
)
def validate_catalog_errors(spark, sf_dir):
    report = validate_files(supplier_files(spark, sf_dir))
    return error_breakdown(report.filter(F.col("stage").isin("load", "code")))
