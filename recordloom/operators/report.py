"""A validation report over catalog files: how far each one gets, and what stops it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scale import materialize
from ..sources.catalog import parse_catalog
from .catalog import check_catalog, normalize_catalog
from .generate import compile_catalog, render_samples
from .params import default_context
from .quality import UNEXPECTED, validate

REPORT = ["path", "pattern_id", "status", "stage", "errors"]


def validate_files(
    texts: DataFrame, validators: list[str | Column] | None = None, codes: list[str] | None = None
) -> DataFrame:
    """(path, yaml_text) -> one row per file: path, pattern_id, status, stage, errors.

    A file passes if it loads, has every required field, renders with its default values
    and the code then passes the `validators`, the parser and the lint rules. `stage` names
    the first step that failed: load (unreadable YAML or no text at all), schema, render or
    code. A file that holds no mapping, an empty one too, is `skipped`, with neither stage nor errors. Files are read and parsed
    once; a file never stops the others.
    """
    checked = materialize(check_catalog(parse_catalog(texts)), "catalog")
    read = F.col("status") == "parsed"
    clean = F.size("errors") == 0
    load_error = F.array(F.concat(F.lit(UNEXPECTED), "error"))
    stopped = checked.filter(~read | ~clean).select(
        "path",
        "pattern_id",
        F.when(F.col("status") == "skipped", "skipped").otherwise("failed").alias("status"),
        F.when(F.col("status") == "error", "load").when(read, "schema").alias("stage"),
        F.when(F.col("status") == "error", load_error)
        .when(read, F.col("errors"))
        .otherwise(F.array().cast("array<string>"))
        .alias("errors"),
    )
    loaded = checked.filter(read & clean).drop("status", "error", "errors", "type_errors")
    ready = compile_catalog(normalize_catalog(loaded), "path")
    samples = render_samples(ready.withColumn("ctx", default_context(F.col("parameters"))))
    judged = validate(
        samples.select("path", "pattern_id", "render_error", "code"), "code", validators or [], parse=True, codes=codes
    )
    failed_render = F.col("render_error").isNotNull()
    found = F.when(
        failed_render, F.array(F.concat(F.lit("Generation failed: "), "render_error"))
    ).otherwise(F.col("errors"))
    ended = judged.withColumn("errors", found).select(
        "path",
        "pattern_id",
        F.when(F.size("errors") == 0, "passed").otherwise("failed").alias("status"),
        F.when(failed_render, "render").when(F.size("errors") > 0, "code").alias("stage"),
        "errors",
    )
    return stopped.unionByName(ended)


def report_parts(report: DataFrame) -> DataFrame:
    """Files per status and stage; a fixed number of rows however many files there are."""
    return report.groupBy("status", "stage").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum(F.size("errors")).alias("n_errors")
    )
