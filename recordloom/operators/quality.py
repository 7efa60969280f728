"""Quality rules on text and code columns, validator chains and reports."""

from __future__ import annotations

import ast
import builtins
import warnings
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import template_vars
from ..scale import materialize

STAR_CODE = "W101"
STAR_MESSAGE = "Star import hides where names come from."
STAR_IMPORT = r"^\s*from\s+\S+\s+import\s+\*"

_PLACE = T.StructType([T.StructField("line", T.IntegerType()), T.StructField("column", T.IntegerType())])
CODE_FACTS = T.StructType(
    [
        T.StructField("error", T.StringType()),
        T.StructField("stars", T.ArrayType(_PLACE)),
        T.StructField("used", T.ArrayType(T.StringType())),
        T.StructField("used_at", T.ArrayType(_PLACE)),
        T.StructField("defined", T.ArrayType(T.StringType())),
    ]
)

# ---------------------------------------------------------------- code reading


def _facts(code: str | None) -> tuple:
    """(error, star imports, used names, their first places, defined names) of one source text."""
    if code is None:
        return None, [], [], [], []
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(code)
    except SyntaxError as exc:
        return f"Syntax error on line {exc.lineno}: {exc.msg}", [], [], [], []
    except (ValueError, RecursionError, MemoryError) as exc:
        return f"Syntax error on line 0: {type(exc).__name__}", [], [], [], []
    lines, stars, used, defined = code.split("\n"), [], {}, set()

    def place(line: int, at: int) -> dict:
        return {"line": line, "column": len(lines[line - 1].encode()[:at].decode(errors="ignore"))}

    for node in ast.walk(tree):
        if isinstance(node, ast.Name):
            if isinstance(node.ctx, ast.Load):
                at = (node.lineno, node.col_offset)
                used[node.id] = min(at, used.get(node.id, at))
            else:
                defined.add(node.id)
        elif isinstance(node, ast.arg):
            defined.add(node.arg)
        elif isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
            defined.add(node.name)
        elif isinstance(node, ast.alias):
            if node.name == "*":
                stars.append(place(node.lineno, node.col_offset))
            else:
                defined.add(node.asname or node.name.split(".")[0])
        elif isinstance(node, (ast.ExceptHandler, ast.MatchAs, ast.MatchStar)):
            defined.add(node.name)
        elif isinstance(node, ast.MatchMapping):
            defined.add(node.rest)
    names = sorted(used)
    return None, stars, names, [place(*used[n]) for n in names], sorted(defined - {None})


def with_code_facts(df: DataFrame, col: str, out: str = "_facts") -> DataFrame:
    """Parse each text once (never run it) and add what the rules need.

    The other columns pass through as Arrow buffers, so nothing is converted for them.
    """

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        texts = pa.list_(pa.string())
        place = pa.struct([("line", pa.int32()), ("column", pa.int32())])
        kind = pa.struct(
            [("error", pa.string()), ("stars", pa.list_(place)), ("used", texts), ("used_at", pa.list_(place)), ("defined", texts)]
        )
        names = [f.name for f in kind]
        for batch in batches:
            codes = batch.column(batch.schema.get_field_index(col)).to_pylist()
            facts = pa.array([dict(zip(names, _facts(code))) for code in codes], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, facts], [*batch.schema.names, out])

    return df.mapInArrow(add, T.StructType([*df.schema.fields, T.StructField(out, CODE_FACTS)]))


def syntax_screen(df: DataFrame, col: str, out: str = "syntax_error") -> DataFrame:
    """Null where the text parses, else `Syntax error on line n: why`."""
    return with_code_facts(df, col).withColumn(out, F.col("_facts.error")).drop("_facts")


# ------------------------------------------------------------------ line rules

_RULES: dict[str, tuple[str, Callable[[Column], Column], Callable[[Column], Column]]] = {}
_VALIDATORS: dict[str, Callable[[Column], Column]] = {}


def register_rule(
    code: str,
    message: str,
    line_pred: Callable[[Column], Column],
    column_at: Callable[[Column], Column] = lambda line: F.lit(0),
) -> None:
    """A user lint rule: lines where `line_pred` holds become violations."""
    _RULES[code] = (message, line_pred, column_at)


def register_validator(name: str, fn: Callable[[Column], Column]) -> None:
    """A user validator: an error text, or null when the text is accepted."""
    _VALIDATORS[name] = fn


register_rule(
    STAR_CODE,
    STAR_MESSAGE,
    lambda line: line.rlike(STAR_IMPORT),
    lambda line: F.length(F.regexp_extract(line, f"({STAR_IMPORT})", 1)) - 1,
)


def lint_lines(df: DataFrame, col: str, codes: list[str]) -> DataFrame:
    """One row per violation: the input without `col`, line (from 1), column (from 0)."""
    others = [c for c in df.columns if c != col]
    lines = df.select(*others, F.posexplode(F.split(F.col(col), "\n")).alias("_pos", "_line"))
    hits = []
    for code in codes:
        message, pred, column_at = _RULES[code]
        line = F.col("_line")
        hits.append(
            F.when(
                pred(line),
                F.struct(
                    column_at(line).cast("long").alias("column"),
                    F.lit(code).alias("code"),
                    F.lit(message).alias("message"),
                ),
            )
        )
    found = lines.withColumn("_hits", F.array_compact(F.array(*hits))).filter(F.size("_hits") > 0)
    return found.select(
        *others, (F.col("_pos") + 1).cast("long").alias("line"), F.explode("_hits").alias("_hit")
    ).select(*others, "line", "_hit.*")


def lint_star_import(df: DataFrame, col: str) -> DataFrame:
    return lint_lines(df, col, [STAR_CODE])


def undefined_names(used: Column, defined: Column, known: Column) -> Column:
    """Names used but neither defined, nor built in, nor known; sorted."""
    standard = F.array(*[F.lit(n) for n in dir(builtins)])
    left = F.array_except(F.array_except(F.array_except(used, defined), known), standard)
    return F.array_sort(left)


def rule_hits(col: Column, codes: list[str]) -> Column:
    """Violations of registered line rules in one text, by line: array of line, column, code, message."""

    def hits(line: Column, at: Column) -> Column:
        found = []
        for code in codes:
            message, pred, column_at = _RULES[code]
            hit = _violation(at + 1, column_at(line), F.lit(code), F.lit(message))
            found.append(F.when(pred(line), hit))
        return F.array_compact(F.array(*found))

    return F.flatten(F.transform(F.split(col, "\n"), hits))


def _violation(line: Column, column: Column, code: Column, message: Column) -> Column:
    return F.struct(
        line.cast("int").alias("line"),
        column.cast("int").alias("column"),
        code.alias("code"),
        message.alias("message"),
    )


def _violations(col: Column, codes: list[str] | None) -> Column:
    """Star imports of a parsed text, then what the registered rules `codes` find; empty if it does not parse."""
    found = F.transform(
        "_facts.stars",
        lambda s: _violation(s["line"], s["column"], F.lit(STAR_CODE), F.lit(STAR_MESSAGE)),
    )
    own = [c for c in codes or [] if c != STAR_CODE]  # the star rule works on parsed text here
    if not own:
        return found
    return F.when(
        F.col("_facts.error").isNull() & col.isNotNull(), F.concat(found, rule_hits(col, own))
    ).otherwise(found)


def lint(
    df: DataFrame,
    col: str,
    known: Column | None = None,
    check_names: bool = False,
    codes: list[str] | None = None,
) -> DataFrame:
    """Add `violations` per row; text that does not parse has none.

    Star imports come first, then the registered rules `codes`, then undefined names at their
    first use. Name checks know the given names plus the template variables of the text.
    """
    facts = with_code_facts(df, col)
    found = _violations(F.col(col), codes)
    if check_names:
        none = F.array().cast("array<string>")
        own = F.coalesce(template_vars(F.col(col)), none)
        names = F.array_union(own, none if known is None else known)
        missing = undefined_names(F.col("_facts.used"), F.col("_facts.defined"), names)

        def unknown(n: Column) -> Column:
            at = F.get("_facts.used_at", (F.array_position("_facts.used", n) - 1).cast("int"))
            message = F.concat(F.lit("undefined name '"), n, F.lit("'"))
            return _violation(at["line"], at["column"], F.lit("W201"), message)

        found = F.concat(found, F.transform(missing, unknown))
    return facts.withColumn("violations", found).drop("_facts")


# ------------------------------------------------------------- validator chain


def require_all(col: Column, terms: list[str]) -> Column:
    test = F.lit(True)
    for term in terms:
        test = test & F.contains(col, F.lit(term))
    return test


def require_any(col: Column, terms: list[str]) -> Column:
    test = F.lit(False)
    for term in terms:
        test = test | F.contains(col, F.lit(term))
    return test


def content_lines(col: Column) -> Column:
    """Lines that are neither blank nor comments."""
    return F.filter(
        F.split(col, "\n"), lambda x: (F.trim(x) != "") & ~F.startswith(F.trim(x), F.lit("#"))
    )


def lines_all(col: Column, token: str) -> Column:
    """Every non-comment line holds the token."""
    return F.forall(content_lines(col), lambda x: F.contains(x, F.lit(token)))


def lines_any(col: Column, token: str) -> Column:
    return F.exists(content_lines(col), lambda x: F.contains(x, F.lit(token)))


def validate(
    df: DataFrame,
    col: str,
    validators: list[str | Column],
    parse: bool = False,
    codes: list[str] | None = None,
) -> DataFrame:
    """Add `valid`, `errors` and `error`, the first of them; the first failing validator wins.

    Native rules come first; with `parse`, only texts they accept reach the parser, and
    parsed text is linted: every star import and every hit of the registered rules `codes`
    is an error of its own.
    """
    rules = [_VALIDATORS[v](F.col(col)) if isinstance(v, str) else v for v in validators]
    first = F.coalesce(F.lit(None).cast("string"), *rules)
    checked = df.withColumn("errors", F.array_compact(F.array(first)))
    if parse:
        text = F.when(F.size("errors") == 0, F.col(col))
        checked = with_code_facts(checked.withColumn("_text", text), "_text")
        linted = F.transform(
            _violations(F.col("_text"), codes),
            lambda v: F.format_string(
                "Linter (%s at L%d:%d): %s", v["code"], v["line"], v["column"], v["message"]
            ),
        )
        parsed = F.when(F.col("_facts.error").isNotNull(), F.array("_facts.error")).otherwise(linted)
        checked = checked.withColumn(
            "errors", F.when(F.size("errors") > 0, F.col("errors")).otherwise(parsed)
        ).drop("_facts", "_text")
    return checked.withColumns({"error": F.get("errors", F.lit(0)), "valid": F.size("errors") == 0})


# --------------------------------------------------------------------- reports


# How a message begins that tells of an exception, not of a finding.
UNEXPECTED = "Unexpected error: "


def classify_error(col: Column) -> Column:
    low = F.lower(col)
    return (
        F.when(F.startswith(col, F.lit(UNEXPECTED)), "exception")
        .when(F.contains(col, F.lit("F821")) | F.contains(low, F.lit("undefined")), "F821_undefined")
        .when(F.contains(col, F.lit("Syntax")), "syntax")
        .when(F.contains(col, F.lit("Linter")), "linter")
        .when(F.contains(low, F.lit("execution")), "execution")
        .otherwise("other")
    )


def summary_counts(report: DataFrame, errors: str = "errors") -> DataFrame:
    """total, passed, failed and their shares in percent, one decimal."""
    bad = F.size(errors) > 0
    total = F.count(F.lit(1))
    counted = report.agg(
        total.alias("total"), F.count_if(~bad).alias("passed"), F.count_if(bad).alias("failed")
    )
    return counted.withColumns(
        {
            "passed_pct": F.round(F.try_divide(F.col("passed") * 100.0, F.col("total")), 1),
            "failed_pct": F.round(F.try_divide(F.col("failed") * 100.0, F.col("total")), 1),
        }
    )


def error_breakdown(report: DataFrame, errors: str = "errors") -> DataFrame:
    """Error classes by falling count."""
    return (
        report.select(F.explode(errors).alias("_e"))
        .groupBy(classify_error(F.col("_e")).alias("error_type"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "error_type")
    )


def failure_lines(report: DataFrame, errors: str = "errors", shown: int = 3) -> DataFrame:
    """Failed rows with their first errors and how many more there are."""
    return report.filter(F.size(errors) > 0).withColumns(
        {
            "first_errors": F.slice(errors, 1, shown),
            "n_more": F.greatest(F.size(errors) - shown, F.lit(0)),
        }
    )


def suggest_fix(col: Column) -> Column:
    """Hint for an unused import or an undefined name, taken from the message."""
    name = F.regexp_extract(col, "'([^']*)'", 1)
    return F.when(
        F.contains(col, F.lit("F401")) & F.contains(col, F.lit("imported but unused")),
        F.concat(F.lit("remove module "), name),
    ).when(
        F.contains(col, F.lit("F821")) & F.contains(col, F.lit("undefined name")),
        F.concat(F.lit("add module providing "), name),
    )


def lint_report(violations: DataFrame, key: str) -> DataFrame:
    """Per key: number of violations, first place, and the rule codes that occur.

    Fixed-width aggregates and a set bounded by the number of rules: a hot key is
    combined map-side.
    """
    place = F.col("line").cast("long") * F.lit(1 << 31) + F.col("column")
    return (
        violations.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n_errors"),
            F.min(place).alias("_at"),
            F.array_sort(F.collect_set("code")).alias("codes"),
        )
        .withColumns(
            {
                "line": F.shiftright("_at", 31),
                "column": F.col("_at").bitwiseAND(F.lit((1 << 31) - 1)),
            }
        )
        .drop("_at")
    )


def lint_summary(checked: DataFrame, report: DataFrame, key: str) -> DataFrame:
    """Failures sorted by key, each with the number of rows that passed."""
    report = materialize(report, "lint-report")  # the texts are linted once
    failed = report.count()
    passed = checked.select(key).distinct().count() - failed
    return report.withColumn("n_passed", F.lit(passed).cast("long")).orderBy(key)
