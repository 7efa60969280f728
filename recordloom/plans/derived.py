"""Catalogs that Spark derives from the part table, one pattern per part.

They let the catalog and generation operators run over a whole table: parameters,
templates and defects all follow from the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.template import VALUE
from ..operators.catalog import check_catalog
from ..scale import scratch_path
from ..sources.catalog import COMPONENTS, PARAM, parse_catalog, read_catalog_files
from ..sources.files import write_texts
from .registry import spread_table

BODY = (
    "def f_{{ style }}(x):\n"
    "    {% if flag %}\n"
    "    return x * {{ size }}\n"
    "    {% else %}\n"
    "    return x + {{ size }}\n"
    "    {% endif %}\n"
)
INSTRUCTION = "Write a {{ style }} function for {{ brand }} of size {{ size }}."
TEST = "assert f_{{ style }}(1) is not None"


def _value(text: Column, kind: str) -> Column:
    return F.struct(
        text.cast("string").alias("v"),
        F.lit(kind).alias("k"),
        F.lit(None).cast("array<string>").alias("items"),
    ).cast(VALUE)


def _param(kind: str, default: Column, options: Column | None = None) -> Column:
    none = F.lit(None).cast(f"array<{VALUE}>")
    return F.struct(
        F.lit(kind).alias("type"),
        F.lit("").alias("description"),
        default.alias("default"),
        (none if options is None else options).alias("options"),
    ).cast(PARAM)


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised patterns: every tenth size imports a star, others fail to parse or render."""
    part = spread_table(spark, sf_dir, "part")
    size = F.col("p_size")
    words = F.transform(F.split("p_name", " "), lambda w: _value(w, "str"))
    flag = F.when(size % 2 == 0, "True").otherwise("False")
    params = F.create_map(
        F.lit("style"),
        _param("choice", words[0], words),
        F.lit("size"),
        _param("choice", _value(size, "num"), F.array(*[_value(size + i, "num") for i in range(3)])),
        F.lit("flag"),
        _param("bool", _value(flag, "bool")),
        F.lit("brand"),
        _param("string", _value(F.col("p_brand"), "str")),
    )
    body = (
        F.when(size % 7 == 3, F.lit("def broken(:\n"))
        .when(size % 13 == 5, F.lit("{{ style | nosuch }}"))
        .otherwise(F.lit(BODY))
    )
    parts = F.struct(
        F.when(size % 10 == 0, "from math import *").otherwise("import math").alias("imports"),
        body.alias("model_definition"),
        F.concat(F.lit("price = "), F.col("p_retailprice").cast("int").cast("string")).alias("data_setup"),
        F.lit(None).cast("string").alias("training_loop"),
        F.lit("").alias("evaluation"),
    ).cast(COMPONENTS)
    return part.select(
        F.concat(F.lit("part."), F.col("p_partkey").cast("string")).alias("pattern_id"),
        F.lit(INSTRUCTION).alias("instruction"),
        parts.alias("components"),
        params.alias("parameters"),
        F.struct(F.lit(True).alias("linter_checks"), F.array(F.lit(TEST)).alias("tests")).alias("validation"),
        F.array(F.lit("math"), F.lit("from typing import List")).alias("requires"),
    )


# The same catalog as SQL text, for the oracles.
PART_SQL = """
SELECT p_partkey, 'part.' || p_partkey AS pattern_id, string_split(p_name, ' ') AS words,
  p_size AS size0, p_brand AS brand, p_size % 2 = 0 AS flag,
  p_size % 7 = 3 AS broken, p_size % 7 <> 3 AND p_size % 13 = 5 AS unrendered,
  p_size % 10 = 0 AS starred,
  CASE WHEN p_size % 10 = 0 THEN 'from math import *' ELSE 'import math' END AS imports,
  'price = ' || (floor(p_retailprice)::BIGINT) AS setup
FROM part
"""


def sql_code(style: str, size: str, flag: str) -> str:
    """Rendered and stripped code of a part pattern as SQL text."""
    return (
        "(imports || chr(10) || chr(10) || setup || chr(10) || chr(10) || "
        f"CASE WHEN broken THEN 'def broken(:' ELSE 'def f_' || {style} || '(x):' || chr(10) || "
        f"CASE WHEN {flag} THEN '    return x * ' ELSE '    return x + ' END || {size} END)"
    )


def sql_instruction(style: str, size: str) -> str:
    return f"('Write a ' || {style} || ' function for ' || brand || ' of size ' || {size} || '.')"


def part_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, yaml_text): a YAML pattern per part, with defects that follow the size."""
    part = spread_table(spark, sf_dir, "part")
    m = F.col("p_size") % 10
    key = F.col("p_partkey").cast("string")
    lines = F.concat_ws(
        "\n",
        F.lit('format_version: "2.0"'),
        F.concat(F.lit("pattern_id: part."), key),
        F.lit("metadata:"),
        F.lit("  author: us"),
        F.concat(F.lit("  description: |\n    About "), F.col("p_name"), F.lit("\n    second line")),
        F.when(m == 5, F.lit("  tags: plain")).otherwise(F.concat(F.lit("  tags: ["), F.lower("p_type"), F.lit("]"))),
        F.lit("  pedagogy: {concept: parts, difficulty: easy}"),
        F.when(m != 2, F.concat(F.lit('instruction: "Make {{ kind }} '), F.col("p_name"), F.lit('"'))),
        F.when(m != 4, F.concat(F.lit("template: |\n  x = {{ n }}\n  # "), F.col("p_name"))),
        F.when(m == 3, F.lit("components:\n  imports: import os")),
        F.when(
            m != 6,
            F.concat(
                F.lit("parameters:\n  kind: {type: choice, description: d, default: a, "),
                F.lit("constraints: {options: [a, b, c]}}\n  n: {type: int, description: d, default: "),
                F.col("p_size").cast("string"),
                F.lit("}"),
            ),
        ),
        F.lit("unknown_key: ignored"),
    )
    text = F.when(m == 0, F.lit("- only\n- a list")).when(m == 1, F.lit("a: [unclosed")).otherwise(lines)
    folder = F.when(
        F.col("p_size") % 3 == 0, F.lit("")
    ).otherwise(F.concat(F.lower(F.replace("p_brand", F.lit("#"), F.lit("_"))), F.lit("/")))
    return part.select(F.concat(folder, key, F.lit(".yaml")).alias("path"), text.alias("yaml_text"))


def checked_part_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_catalog(parse_catalog(part_yaml(spark, sf_dir)))


YAML_PATH_SQL = (
    "(CASE WHEN p_size % 3 = 0 THEN '' ELSE lower(replace(p_brand, '#', '_')) || '/' END "
    "|| p_partkey || '.yaml')"
)
YAML_STATUS_SQL = (
    "(CASE p_size % 10 WHEN 0 THEN 'skipped' WHEN 1 THEN 'error' ELSE 'parsed' END)"
)
YAML_ERRORS_SQL = (
    "(CASE p_size % 10 WHEN 2 THEN 'instruction is missing' "
    "WHEN 3 THEN 'components and template exclude each other' "
    "WHEN 4 THEN 'either components or template is required' "
    "WHEN 5 THEN 'metadata.tags is missing|metadata.tags must be list' ELSE '' END)"
)


def supplier_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nation, file, yaml_text): a pattern file per supplier; its key decides what stops it."""
    rows = spread_table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    m = F.col("s_suppkey") % 10
    code = (
        F.when(m == 3, "  x = {{ kind | nosuch }}")
        .when(m == 4, "  x = 1\n  def broken(:")
        .when(m == 5, "  from math import *\n  from cmath import *\n  x = {{ n }}")
        .otherwise("  def f_{{ kind }}(x):\n      return x + {{ n }}")
    )
    lines = F.concat_ws(
        "\n",
        F.lit('format_version: "1.0"'),
        F.concat(F.lit("pattern_id: supplier."), key),
        F.lit("metadata:\n  author: us"),
        F.concat(F.lit("  description: About "), F.col("s_name")),
        F.lit("  tags: [supplier]\n  pedagogy: {concept: parts, difficulty: easy}"),
        F.when(m != 2, F.lit("instruction: Write f_{{ kind }}.")),
        F.when(m != 6, F.concat(F.lit("template: |\n"), code)),
        F.lit("parameters:\n  kind: {type: string, description: d, default: a}"),
        F.concat(F.lit("  n: {type: int, description: d, default: "), key, F.lit("}")),
    )
    text = F.when(m == 0, F.lit("- only\n- a list")).when(m == 1, F.lit("a: [unclosed")).otherwise(lines)
    return rows.select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("file"), text.alias("yaml_text"))


def supplier_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, yaml_text) of the same patterns, written as one file each and found again by a scan."""
    path = scratch_path(spark, "patterns")
    keys = [F.coalesce(F.col(k).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")) for k in ("nation", "file")]
    name = F.concat(F.lit("nation="), keys[0], F.lit("/file="), keys[1])
    write_texts(supplier_yaml(spark, sf_dir).select(name.alias("name"), F.col("yaml_text").alias("text")), path)
    found = read_catalog_files(spark, path, "*.txt")
    return found.withColumn("path", F.regexp_replace("path", r"\.\d+\.txt$", ""))


SUPPLIER_SQL = """
SELECT 'nation=' || s_nationkey || '/file=' || s_suppkey AS path,
  CASE WHEN s_suppkey % 10 > 1 THEN 'supplier.' || s_suppkey END AS pattern_id,
  CASE s_suppkey % 10 WHEN 0 THEN 'skipped' WHEN 1 THEN 'error' ELSE 'parsed' END AS load_status,
  CASE s_suppkey % 10 WHEN 1 THEN 'load' WHEN 2 THEN 'schema' WHEN 3 THEN 'render' WHEN 4 THEN 'code'
    WHEN 5 THEN 'code' WHEN 6 THEN 'schema' END AS stage,
  CASE s_suppkey % 10 WHEN 1 THEN ['Unexpected error: ParserError'] WHEN 2 THEN ['instruction is missing']
    WHEN 3 THEN ['Generation failed: unsupported filter: nosuch']
    WHEN 4 THEN ['Syntax error on line 2: invalid syntax']
    WHEN 5 THEN ['Linter ({code} at L1:17): {message}', 'Linter ({code} at L2:18): {message}']
    WHEN 6 THEN ['either components or template is required'] ELSE [] END AS errors
FROM supplier"""
