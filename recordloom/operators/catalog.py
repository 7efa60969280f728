"""Checks and listings over pattern catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.template import title_case
from ..scale import materialize

MISSING_BODY = "either components or template is required"
DOUBLE_BODY = "components and template exclude each other"

REQUIRED = [
    "version",
    "pattern_id",
    "metadata.author",
    "metadata.description",
    "metadata.tags",
    "metadata.pedagogy.concept",
    "metadata.pedagogy.difficulty",
    "instruction",
]


def check_catalog(df: DataFrame) -> DataFrame:
    """Add `errors`: missing fields, wrong types, and the two body errors."""
    missing = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in REQUIRED]
    no_parts, no_template = F.col("components").isNull(), F.col("template").isNull()
    body = [
        F.when(no_parts & no_template, F.lit(MISSING_BODY)),
        F.when(~no_parts & ~no_template, F.lit(DOUBLE_BODY)),
    ]
    found = F.array_compact(F.array(*missing, *body))
    types = F.coalesce(F.col("type_errors"), F.array().cast("array<string>"))
    return df.withColumn("errors", F.concat(found, types))


def normalize_catalog(df: DataFrame) -> DataFrame:
    """A template becomes the definition part; absent optional fields get defaults."""
    parts = F.struct(
        F.coalesce("components.imports", F.lit("")).alias("imports"),
        F.coalesce("template", "components.model_definition").alias("model_definition"),
        F.col("components.data_setup").alias("data_setup"),
        F.col("components.training_loop").alias("training_loop"),
        F.col("components.evaluation").alias("evaluation"),
    )
    no_texts = F.array().cast("array<string>")
    param_type = df.schema["parameters"].dataType.simpleString()
    checks = F.struct(
        F.coalesce("validation.linter_checks", F.lit(True)).alias("linter_checks"),
        F.coalesce("validation.tests", no_texts).alias("tests"),
    )
    return df.withColumns(
        {
            "components": parts,
            "parameters": F.coalesce("parameters", F.create_map().cast(param_type)),
            "validation": checks,
            "requires": F.coalesce("requires", no_texts),
        }
    ).drop("template")


def category_of(path_col="path"):
    """Directory of a relative path, `general` at the top."""
    folder = F.regexp_extract(path_col, r"^(.*)/[^/]*$", 1)
    return F.when(folder == "", F.lit("general")).otherwise(folder)


def catalog_listing(df: DataFrame, fmt: str = "rows") -> DataFrame:
    """(category, id, description) sorted; `markdown` gives one `line` per row instead."""
    text = F.coalesce(F.col("metadata.description"), F.lit("No description."))
    listed = df.filter(F.col("status") == "parsed").select(
        category_of().alias("category"),
        F.coalesce("pattern_id", F.lit("N/A")).alias("id"),
        F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), "\n")[0].alias("description"),
    )
    rows = materialize(listed, "listing")  # sorting and headings read it again
    if fmt == "rows":
        return rows.orderBy("category", "id")
    title = title_case(F.replace(F.col("category"), F.lit("_"), F.lit(" ")))
    heads = rows.select("category").distinct().select(
        "category", F.lit("").alias("id"), F.concat(F.lit("## "), title).alias("line")
    )
    items = rows.select(
        "category", "id", F.format_string("- **`%s`**: %s", "id", "description").alias("line")
    )
    return heads.unionAll(items).orderBy("category", "id")


def load_stats(checked: DataFrame) -> DataFrame:
    """Loaded, error and skipped file counts of a checked catalog."""
    ok = (F.col("status") == "parsed") & (F.size("errors") == 0)
    return checked.agg(
        F.count_if(ok).alias("loaded"),
        F.count_if((F.col("status") != "skipped") & ~ok).alias("errors"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
    )
