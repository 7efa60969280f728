"""Registered queries: quality rules, linting and reports."""

from __future__ import annotations

import builtins

from pyspark.sql import functions as F

from ..functions.text import template_vars, tokenize_alpha
from ..operators import quality as q
from ..operators.generate import render_defaults
from .derived import PART_SQL, part_catalog, sql_code
from .registry import query, spread_table, sql_alpha, table


def _docs(spark, sf_dir):
    return spread_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars", "source")


def _part_code(spark, sf_dir):
    rows = render_defaults(part_catalog(spark, sf_dir))
    return rows.filter(F.col("render_error").isNull()).select("pattern_id", "code")


@query(
    "syntax_screen",
    f"""
    SELECT pattern_id, CASE WHEN broken THEN 'Syntax error on line 5: invalid syntax' END AS syntax_error
    FROM ({PART_SQL}) WHERE NOT unrendered""",
)
def syntax_screen(spark, sf_dir):
    return q.syntax_screen(_part_code(spark, sf_dir), "code").select("pattern_id", "syntax_error")


@query("syntax_screen_documents")
def syntax_screen_documents(spark, sf_dir):
    return q.syntax_screen(_docs(spark, sf_dir), "text").select("doc_id", "syntax_error")


def _with_imports(spark, sf_dir):
    """Document texts with a star import (plain or indented) added to two thirds of them."""
    kind = F.col("doc_id") % 3
    added = F.when(kind == 0, "\nfrom mod import *").when(kind == 1, "\n  from a.b import  *\nend").otherwise("")
    return _docs(spark, sf_dir).select("doc_id", F.concat("text", added).alias("text"))


_STARS = f"""
SELECT doc_id, (len(text) - len(replace(text, chr(10), '')) + 2)::BIGINT AS line,
  instr(CASE doc_id % 3 WHEN 0 THEN 'from mod import *' ELSE '  from a.b import  *' END, '*') - 1 AS "column",
  '{q.STAR_CODE}' AS code, '{q.STAR_MESSAGE}' AS message
FROM documents WHERE doc_id % 3 < 2"""


@query("lint_star_import", _STARS)
def lint_star_import(spark, sf_dir):
    return q.lint_star_import(_with_imports(spark, sf_dir), "text")


_NAMES = "[" + ", ".join(f"'{n}'" for n in dir(builtins)) + "]"


@query(
    "undefined_names",
    f"""
    SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(l, lambda t:
        NOT list_contains(l[1:20], t) AND NOT list_contains({_NAMES}, t)
        AND NOT list_contains(['the', 'der', 'la'], t)))), ' ') AS names
    FROM (SELECT doc_id, {sql_alpha('text')} AS l FROM documents)""",
)
def undefined_names(spark, sf_dir):
    tokens = tokenize_alpha(F.col("text"))
    known = F.array(F.lit("the"), F.lit("der"), F.lit("la"))
    names = q.undefined_names(tokens, F.slice(tokens, 1, 20), known)
    return _docs(spark, sf_dir).select("doc_id", F.array_join(names, " ").alias("names"))


@query(
    "template_vars",
    "SELECT p_partkey, array_to_string(list_sort(list_distinct([p_brand[1:5], split_part(p_name, ' ', 1), p_type])), ' ') AS names FROM part",
)
def template_variables(spark, sf_dir):
    name = F.split("p_name", " ")[0]
    text = F.concat(
        F.lit("{{ "), F.substring("p_brand", 1, 5), F.lit(" }} and {{"), name, F.lit("}} or {{  "),
        F.col("p_type"), F.lit(" }} not { x } {{ a b }} again {{ "), name, F.lit(" }}"),
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(template_vars(text), " ").alias("names")
    )


def _price_rule():
    """A user rule on code lines: prices that end in 0."""
    q.register_rule("U002", "round price", lambda x: x.rlike("^price = .*0$"), lambda x: F.length(x) - 1)
    return ["U002"]


@query(
    "lint_known",
    f"""
    SELECT pattern_id, 1::BIGINT AS line, 17::BIGINT AS "column", '{q.STAR_CODE}' AS code
    FROM ({PART_SQL}) WHERE NOT unrendered AND NOT broken AND starred
    UNION ALL
    SELECT pattern_id, 3, len(setup) - 1, 'U002' FROM ({PART_SQL})
    WHERE NOT unrendered AND NOT broken AND ends_with(setup, '0')
    UNION ALL
    SELECT pattern_id, 7, 6, 'W201' FROM ({PART_SQL}) WHERE NOT unrendered AND NOT broken""",
)
def lint_known(spark, sf_dir):
    whole = F.regexp_replace("code", r"\n+$", "")
    code = _part_code(spark, sf_dir).withColumn("code", F.concat(whole, F.lit("\nprint(lost, given)")))
    linted = q.lint(code, "code", F.array(F.lit("given")), check_names=True, codes=_price_rule())
    return linted.select("pattern_id", F.explode("violations").alias("v")).select(
        "pattern_id", F.col("v.line").cast("long").alias("line"),
        F.col("v.column").cast("long").alias("column"), "v.code",
    )


@query(
    "validator_chain_code",
    f"""
    SELECT pattern_id, CASE WHEN brand LIKE '%5' THEN 'brand' WHEN broken THEN 'Syntax error on line 5: invalid syntax'
      ELSE concat_ws('|', CASE WHEN starred THEN 'Linter ({q.STAR_CODE} at L1:17): {q.STAR_MESSAGE}' END,
        CASE WHEN ends_with(setup, '0') THEN 'Linter (U002 at L3:' || (len(setup) - 1) || '): round price' END)
      END AS errors
    FROM ({PART_SQL}) WHERE NOT unrendered""",
)
def validator_chain_code(spark, sf_dir):
    """All errors of each text: a native rule, the parser, star imports and a user rule."""
    key = F.concat(F.lit("part."), F.col("p_partkey").cast("string")).alias("pattern_id")
    brands = table(spark, sf_dir, "part").select(key, "p_brand")
    rows = _part_code(spark, sf_dir).join(brands, "pattern_id")
    rules = [F.when(F.endswith("p_brand", F.lit("5")), "brand")]
    checked = q.validate(rows, "code", rules, parse=True, codes=_price_rule())
    return checked.select("pattern_id", F.array_join("errors", "|").alias("errors"))


@query(
    "validator_chain",
    """
    SELECT doc_id, CASE WHEN n_chars < 400 THEN 'too short' WHEN NOT contains(text, 'the') THEN 'no article'
      WHEN contains(text, 'http') THEN 'has a link' END AS error,
      n_chars >= 400 AND contains(text, 'the') AND NOT contains(text, 'http') AS valid
    FROM documents""",
)
def validator_chain(spark, sf_dir):
    text = F.col("text")
    rules = [
        F.when(F.col("n_chars") < 400, "too short"),
        F.when(~q.require_all(text, ["the"]), "no article"),
        F.when(q.require_any(text, ["http"]), "has a link"),
    ]
    return q.validate(_docs(spark, sf_dir), "text", rules).select("doc_id", "error", "valid")


_MESSAGES = """
CASE event_type WHEN 'click' THEN 'F821 name ' || user_id WHEN 'error' THEN 'Syntax error on line ' || user_id
  WHEN 'purchase' THEN 'Linter (W101 at L1:0)' WHEN 'signup' THEN 'Python Execution error ' || user_id
  ELSE CASE WHEN user_id % 2 = 0 THEN 'an Undefined thing' ELSE 'something else' END END"""


def _messages():
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    return (
        F.when(kind == "click", F.concat(F.lit("F821 name "), user))
        .when(kind == "error", F.concat(F.lit("Syntax error on line "), user))
        .when(kind == "purchase", F.lit("Linter (W101 at L1:0)"))
        .when(kind == "signup", F.concat(F.lit("Python Execution error "), user))
        .when(F.col("user_id") % 2 == 0, "an Undefined thing")
        .otherwise("something else")
    )


@query(
    "classify_errors",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'F821_undefined' WHEN 'error' THEN 'syntax'
      WHEN 'purchase' THEN 'linter' WHEN 'signup' THEN 'execution'
      ELSE CASE WHEN user_id % 2 = 0 THEN 'F821_undefined' ELSE 'other' END END AS error_type
    FROM events""",
)
def classify_errors(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", q.classify_error(_messages()).alias("error_type")
    )


def _report(spark, sf_dir):
    """Validation errors per labelled document, from its labels and its text."""
    rows = table(spark, sf_dir, "labels").join(_docs(spark, sf_dir), "doc_id")
    return rows.select(
        "doc_id",
        F.array_compact(
            F.array(
                F.when(F.col("quality") == 0, "Syntax error"),
                F.when(F.col("toxic") == 1, "execution failed"),
                F.when(F.col("n_chars") < 400, "Linter: short"),
                F.when(F.contains("text", F.lit("http")), "link"),
                F.when(F.col("doc_id") % 5 == 0, "undefined"),
            )
        ).alias("errors"),
    )


_REPORT = """
(SELECT doc_id, list_filter([CASE WHEN quality = 0 THEN 'Syntax error' END,
   CASE WHEN toxic = 1 THEN 'execution failed' END, CASE WHEN n_chars < 400 THEN 'Linter: short' END,
   CASE WHEN contains(text, 'http') THEN 'link' END, CASE WHEN doc_id % 5 = 0 THEN 'undefined' END],
   lambda e: e IS NOT NULL) AS errors
 FROM labels JOIN documents USING (doc_id))"""


@query(
    "validation_summary",
    f"""
    SELECT total, passed, total - passed AS failed, round(100.0 * passed / total, 1)::DOUBLE AS passed_pct,
      round(100.0 * (total - passed) / total, 1)::DOUBLE AS failed_pct
    FROM (SELECT count(*) AS total, count(*) FILTER (WHERE len(errors) = 0) AS passed FROM {_REPORT})""",
)
def validation_summary(spark, sf_dir):
    return q.summary_counts(_report(spark, sf_dir))


@query(
    "error_breakdown",
    f"""
    SELECT CASE e WHEN 'Syntax error' THEN 'syntax' WHEN 'execution failed' THEN 'execution'
      WHEN 'Linter: short' THEN 'linter' WHEN 'undefined' THEN 'F821_undefined' ELSE 'other' END AS error_type,
      count(*) AS n
    FROM (SELECT unnest(errors) AS e FROM {_REPORT}) GROUP BY 1""",
)
def error_breakdown(spark, sf_dir):
    return q.error_breakdown(_report(spark, sf_dir))


@query(
    "failure_lines",
    f"""
    SELECT doc_id, array_to_string(errors[1:3], '; ') AS first_errors,
      greatest(len(errors) - 3, 0)::BIGINT AS n_more
    FROM {_REPORT} WHERE len(errors) > 0""",
)
def failure_lines(spark, sf_dir):
    rows = q.failure_lines(_report(spark, sf_dir))
    return rows.select(
        "doc_id", F.array_join("first_errors", "; ").alias("first_errors"), F.col("n_more").cast("long").alias("n_more")
    )


@query(
    "suggest_fixes",
    """
    SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'remove module ' || p_name
      WHEN 1 THEN 'add module providing ' || p_type END AS hint
    FROM part""",
)
def suggest_fixes(spark, sf_dir):
    m = F.col("p_size") % 3
    message = (
        F.when(m == 0, F.concat(F.lit("1:1: F401 '"), "p_name", F.lit("' imported but unused")))
        .when(m == 1, F.concat(F.lit("9:2: F821 undefined name '"), "p_type", F.lit("'")))
        .otherwise(F.lit("E501 line too long 'x'"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", q.suggest_fix(message).alias("hint"))


@query(
    "lint_report",
    f"""
    SELECT source, count(*) AS n_errors, min(line) AS line, arg_min("column", line * 1000 + "column") AS "column",
      '{q.STAR_CODE}' AS codes, (SELECT count(DISTINCT source) FROM documents) - (SELECT count(DISTINCT source)
        FROM documents WHERE doc_id % 3 < 2) AS n_passed
    FROM ({_STARS}) JOIN documents USING (doc_id) GROUP BY source""",
)
def lint_report(spark, sf_dir):
    sources = table(spark, sf_dir, "documents").select("doc_id", "source")
    texts = _with_imports(spark, sf_dir).join(sources, "doc_id").drop("doc_id")
    report = q.lint_report(q.lint_star_import(texts, "text"), "source")
    return q.lint_summary(sources, report, "source").withColumn("codes", F.array_join("codes", ","))


@query(
    "content_rules",
    """
    SELECT doc_id, contains(text, 'the') AND contains(text, 'and') AS has_all,
      contains(text, 'http') OR contains(text, '@') AS has_any,
      len(list_filter(l, lambda x: NOT contains(x, 'e'))) = 0 AS lines_all,
      len(list_filter(l, lambda x: contains(x, '='))) > 0 AS lines_any
    FROM (SELECT doc_id, text, list_filter(string_split(text, chr(10)),
            lambda x: trim(x, ' ') <> '' AND NOT starts_with(trim(x, ' '), '#')) AS l FROM documents)""",
)
def content_rules(spark, sf_dir):
    text = F.col("text")
    return _docs(spark, sf_dir).select(
        "doc_id",
        q.require_all(text, ["the", "and"]).alias("has_all"),
        q.require_any(text, ["http", "@"]).alias("has_any"),
        q.lines_all(text, "e").alias("lines_all"),
        q.lines_any(text, "=").alias("lines_any"),
    )


@query(
    "register_validator",
    """
    SELECT doc_id, CASE WHEN len(text) % 2 = 1 THEN 'odd length' WHEN n_chars < 400 THEN 'too short' END AS error
    FROM documents""",
)
def user_validator(spark, sf_dir):
    q.register_validator("odd_length", lambda c: F.when(F.length(c) % 2 == 1, "odd length"))
    rules = ["odd_length", F.when(F.col("n_chars") < 400, "too short")]
    return q.validate(_docs(spark, sf_dir), "text", rules).select("doc_id", "error")


@query(
    "register_rule",
    """
    SELECT doc_id, line, instr(l, '@')::BIGINT - 1 AS "column", 'U001' AS code, 'has an at sign' AS message
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
            generate_subscripts(string_split(text, chr(10)), 1)::BIGINT AS line FROM documents)
    WHERE contains(l, '@')""",
)
def user_rule(spark, sf_dir):
    at = F.lit("@")
    q.register_rule(
        "U001", "has an at sign", lambda x: F.contains(x, at), lambda x: F.instr(x, at) - 1
    )
    return q.lint_lines(_docs(spark, sf_dir).select("doc_id", "text"), "text", ["U001"])
