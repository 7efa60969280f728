"""Pattern catalogs: YAML files in, one typed row per pattern out."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.template import VALUE
from ..scale import materialize

# Scans of many small files: tasks that every core gets at least, splits that a task takes at most.
TASKS_PER_CORE = 4
SPLITS_PER_TASK = 32

PARAM = f"struct<type:string,description:string,default:{VALUE},options:array<{VALUE}>>"
COMPONENTS = (
    "struct<imports:string,model_definition:string,data_setup:string,"
    "training_loop:string,evaluation:string>"
)
DOC = (
    "struct<version:string,pattern_id:string,"
    "metadata:struct<author:string,description:string,tags:array<string>,"
    "pedagogy:struct<concept:string,difficulty:string,related_patterns:array<string>>>,"
    f"instruction:string,components:{COMPONENTS},template:string,"
    f"parameters:map<string,{PARAM}>,"
    "validation:struct<linter_checks:boolean,tests:array<string>>,"
    "requires:array<string>,type_errors:array<string>>"
)


def shown_value(value) -> dict:
    """A bound value as the templates show it: text, kind, list items."""
    if isinstance(value, bool):
        kind = "bool"
    elif value is None:
        kind = "none"
    elif isinstance(value, (int, float)):
        kind = "num"
    elif isinstance(value, str):
        kind = "str"
    else:
        kind = "list"
    items = [str(x) for x in value] if isinstance(value, (list, tuple)) else None
    return dict(v=str(value), k=kind, items=items)


class _Typed:
    """Reads a mapping by expected type and notes what has the wrong one."""

    def __init__(self) -> None:
        self.errors: list[str] = []

    def get(self, source, key: str, kind: type, where: str = ""):
        value = source.get(key) if isinstance(source, dict) else None
        if value is None or isinstance(value, kind):
            return value
        self.errors.append(f"{where}{key} must be {kind.__name__}")
        return None

    def texts(self, source, key: str, where: str = ""):
        values = self.get(source, key, list, where)
        if values is not None and not all(isinstance(v, str) for v in values):
            self.errors.append(f"{where}{key} must hold only str")
            return None
        return values


def _row_of(raw: dict) -> dict:
    t = _Typed()
    version_key = next((k for k in raw if isinstance(k, str) and k.endswith("_version")), "version")
    meta = t.get(raw, "metadata", dict)
    pedagogy = t.get(meta, "pedagogy", dict, "metadata.")
    parts = t.get(raw, "components", dict)
    checks = t.get(raw, "validation", dict)
    params = t.get(raw, "parameters", dict)
    row = dict(
        version=t.get(raw, version_key, str),
        pattern_id=t.get(raw, "pattern_id", str),
        instruction=t.get(raw, "instruction", str),
        template=t.get(raw, "template", str),
        requires=t.texts(raw, "requires"),
    )
    if meta is not None:
        row["metadata"] = dict(
            author=t.get(meta, "author", str, "metadata."),
            description=t.get(meta, "description", str, "metadata."),
            tags=t.texts(meta, "tags", "metadata."),
        )
        if pedagogy is not None:
            where = "metadata.pedagogy."
            row["metadata"]["pedagogy"] = dict(
                concept=t.get(pedagogy, "concept", str, where),
                difficulty=t.get(pedagogy, "difficulty", str, where),
                related_patterns=t.texts(pedagogy, "related_patterns", where),
            )
    if parts is not None:
        names = ("imports", "model_definition", "data_setup", "training_loop", "evaluation")
        row["components"] = {n: t.get(parts, n, str, "components.") for n in names}
    if checks is not None:
        row["validation"] = dict(
            linter_checks=t.get(checks, "linter_checks", bool, "validation."),
            tests=t.texts(checks, "unit_test_snippets", "validation."),
        )
    if params is not None:
        row["parameters"] = {}
        for name, spec in params.items():
            where = f"parameters.{name}."
            if not isinstance(spec, dict):
                t.errors.append(f"parameters.{name} must be dict")
                continue
            for key in ("type", "description", "default"):
                if key not in spec:
                    t.errors.append(f"{where}{key} is missing")
            limits = t.get(spec, "constraints", dict, where) or {}
            options = limits.get("options")
            row["parameters"][str(name)] = dict(
                type=t.get(spec, "type", str, where),
                description=t.get(spec, "description", str, where),
                default=shown_value(spec.get("default")),
                options=[shown_value(o) for o in options] if isinstance(options, list) else None,
            )
    row["type_errors"] = t.errors
    return row


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import yaml

    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

    def parse(text: str) -> tuple[str, str | None, str | None]:
        try:
            raw = yaml.load(text, Loader=loader)
        except Exception as exc:  # any unreadable file is counted, loading goes on
            return "error", f"{type(exc).__name__}", None
        if not isinstance(raw, dict):
            return "skipped", None, None
        return "parsed", None, json.dumps(_row_of(raw))

    for pdf in batches:
        rows = [parse(text) for text in pdf["yaml_text"]]
        yield pd.DataFrame(
            dict(
                path=pdf["path"],
                status=[r[0] for r in rows],
                error=pd.Series([r[1] for r in rows], dtype=object),
                doc=pd.Series([r[2] for r in rows], dtype=object),
            )
        )


def parse_catalog(files: DataFrame) -> DataFrame:
    """(path, yaml_text) -> path, status (parsed/skipped/error), error, pattern columns."""
    parsed = files.select("path", "yaml_text").mapInPandas(
        _parse_batches, "path string, status string, error string, doc string"
    )
    return parsed.withColumn("doc", F.from_json("doc", DOC)).select(
        "path", "status", "error", "doc.*"
    )


def read_catalog_files(spark: SparkSession, path: str, names: str = "*.{yaml,yml}") -> DataFrame:
    """Whole texts of the files below `path` whose name fits, with the path relative to it.

    Spark gives a task some thirty small files; with thousands of tasks, starting them would be most
    of the work, and each would write a file of its own later, so a task takes more of them then.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", names)
        .text(path, wholetext=True)
    )
    root = path.rstrip("/") + "/"
    full = F.col("_metadata.file_path")
    at = F.instr(full, root)
    found = files.select(
        F.when(at > 0, F.substring(full, at + len(root), F.length(full))).otherwise(full).alias("path"),
        F.col("value").alias("yaml_text"),
    )
    splits, cores = files.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism
    tasks = max(TASKS_PER_CORE * cores, -(-splits // SPLITS_PER_TASK))
    return found.coalesce(tasks) if splits > tasks else found


def read_catalog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad): patterns that pass every check, and files that do not."""
    from ..operators.catalog import check_catalog, normalize_catalog

    # both results and every later use read the parsed rows, not the files
    checked = materialize(check_catalog(parse_catalog(read_catalog_files(spark, path))), "catalog")
    ok = (F.col("status") == "parsed") & (F.size("errors") == 0)
    failed = (F.col("status") == "error") | ((F.col("status") == "parsed") & (F.size("errors") > 0))
    good = normalize_catalog(checked.filter(ok)).drop("status", "error", "errors", "type_errors")
    bad = checked.filter(failed).select(
        "path",
        F.coalesce(
            F.when(F.col("status") == "error", F.array("error")), F.col("errors")
        ).alias("errors"),
    )
    return good, bad
