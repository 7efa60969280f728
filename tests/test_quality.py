import pytest
from pyspark.sql import functions as F

from recordloom.functions.text import template_vars
from recordloom.operators import quality as q


STAR_LINE = "    é = 'ü'; from math import *"


@pytest.fixture(scope="module")
def codes(spark):
    data = [
        (1, "x = 1\n"),
        (2, "def f(:\n  pass"),
        (3, "import os\nif True:\n" + STAR_LINE + "\n"),
        (4, '"""\nfrom text import *\n"""\n'),
        (5, "print(undefined_thing, {{ name }})"),
        (6, "a = b + len(c)\ndef f(d): return d"),
        (7, "x = '\0'"),
        (8, None),
    ]
    return spark.createDataFrame(data, "id long, code string")


def test_syntax_screen(codes):
    got = {r["id"]: r["syntax_error"] for r in q.syntax_screen(codes, "code").collect()}
    assert got[1] is None and got[3] is None and got[8] is None
    assert got[2].startswith("Syntax error on line 1: ")
    assert got[7].startswith("Syntax error on line")


def test_exact_lint_ignores_text_and_counts_characters(codes):
    got = {r["id"]: r["violations"] for r in q.lint(codes, "code").collect()}
    assert [(v["line"], v["column"], v["code"]) for v in got[3]] == [(3, STAR_LINE.index("*"), q.STAR_CODE)]
    assert got[1] == [] and got[2] == [] and got[4] == []


def test_undefined_names(codes):
    got = {r["id"]: [v["message"] for v in r["violations"]] for r in q.lint(codes, "code", F.array(F.lit("c")), True).collect()}
    assert got[6] == ["undefined name 'b'"]
    assert got[8] == []


def test_line_lint(spark):
    df = spark.createDataFrame([(1, "a\n  from x.y import  *\nfrom z import q")], "id long, code string")
    assert [tuple(r) for r in q.lint_star_import(df, "code").collect()] == [(1, 2, 19, q.STAR_CODE, q.STAR_MESSAGE)]


def test_validator_order_and_parse_only_for_survivors(codes):
    rules = [F.when(F.length("code") < 7, "short"), F.when(F.contains("code", F.lit("import")), "imports")]
    got = {r["id"]: r["error"] for r in q.validate(codes.filter("code is not null"), "code", rules, parse=True).collect()}
    assert got[1] == "short" and got[3] == "imports"
    assert got[2].startswith("Syntax error") and got[6] is None
    none = {r["id"]: r["error"] for r in q.validate(codes, "code", [], parse=True).collect()}
    assert none[3] == f"Linter ({q.STAR_CODE} at L3:{STAR_LINE.index('*')}): {q.STAR_MESSAGE}"


def test_registered_rule_and_validator(spark):
    q.register_rule("T1", "tab", lambda x: F.contains(x, F.lit("\t")), lambda x: F.instr(x, F.lit("\t")) - 1)
    q.register_validator("no_todo", lambda c: F.when(F.contains(c, F.lit("TODO")), "todo left"))
    df = spark.createDataFrame([(1, "ok\nx\ty"), (2, "TODO")], "id long, text string")
    assert [tuple(r) for r in q.lint_lines(df, "text", ["T1"]).collect()] == [(1, 2, 1, "T1", "tab")]
    assert {r["id"]: r["valid"] for r in q.validate(df, "text", ["no_todo"]).collect()} == {1: True, 2: False}


def test_every_violation_is_an_error(spark):
    q.register_rule("T2", "tab", lambda x: F.contains(x, F.lit("\t")), lambda x: F.instr(x, F.lit("\t")) - 1)
    star = "from os import *"
    data = [(1, f"{star}\nif a:\n\t{star}\nb = é + c"), (2, "x = (\t"), (3, None), (4, "short")]
    df = spark.createDataFrame(data, "id long, code string")
    rules = [F.when(F.col("code") == "short", "too short")]
    got = {r["id"]: r for r in q.validate(df, "code", rules, parse=True, codes=["T2"]).collect()}
    assert got[1]["errors"] == [
        f"Linter ({q.STAR_CODE} at L1:15): {q.STAR_MESSAGE}",
        f"Linter ({q.STAR_CODE} at L3:16): {q.STAR_MESSAGE}",
        "Linter (T2 at L3:0): tab",
    ]
    assert got[1]["error"] == got[1]["errors"][0] and not got[1]["valid"]
    assert len(got[2]["errors"]) == 1 and got[2]["error"].startswith("Syntax error")
    assert got[3]["errors"] == [] and got[3]["valid"] and got[4]["errors"] == ["too short"]
    found = {r["id"]: r["violations"] for r in q.lint(df, "code", check_names=True, codes=["T2"]).collect()}
    names = [(v["line"], v["column"], v["message"]) for v in found[1] if v["code"] == "W201"]
    assert names == [(2, 3, "undefined name 'a'"), (4, 8, "undefined name 'c'"), (4, 4, "undefined name 'é'")]
    assert found[2] == [] and found[3] == []


def test_content_rules(spark):
    df = spark.createDataFrame([("# pins\na==1\n\nb==2",), ("a==1\nb>=2",), ("# only",)], "t string")
    rows = df.select(q.lines_all(F.col("t"), "==").alias("all"), q.lines_any(F.col("t"), ">=").alias("any")).collect()
    assert [tuple(r) for r in rows] == [(True, False), (False, True), (True, False)]


def test_classes_and_hints(spark):
    df = spark.createDataFrame(
        [("F821 undefined name 'np'",), ("x is Undefined",), ("Syntax error",), ("Linter (A)",), ("Execution died",),
         ("odd",), ("1: F401 'os' imported but unused",)], "e string")
    got = [tuple(r) for r in df.select(q.classify_error(F.col("e")), q.suggest_fix(F.col("e"))).collect()]
    assert [g[0] for g in got] == ["F821_undefined", "F821_undefined", "syntax", "linter", "execution", "other", "other"]
    assert got[0][1] == "add module providing np" and got[6][1] == "remove module os" and got[5][1] is None


def test_summary(spark):
    df = spark.createDataFrame([(1, []), (2, ["a", "Syntax b", "c", "d"]), (3, ["Syntax z"])], "id long, errors array<string>")
    assert tuple(q.summary_counts(df).first()) == (3, 1, 2, 33.3, 66.7)
    assert [tuple(r) for r in q.error_breakdown(df).collect()] == [("other", 3), ("syntax", 2)]
    lines = {r["id"]: (r["first_errors"], r["n_more"]) for r in q.failure_lines(df).collect()}
    assert lines == {2: (["a", "Syntax b", "c"], 1), 3: (["Syntax z"], 0)}
    assert tuple(q.summary_counts(df.limit(0)).first()) == (0, 0, 0, None, None)


def test_template_vars(spark):
    df = spark.createDataFrame([("{{ b }}{{a}} {{ b }} {{ c.d }} { e }",)], "t string")
    assert df.select(template_vars(F.col("t"))).first()[0] == ["a", "b"]


def test_names_bound_by_imports_handlers_and_patterns(spark):
    code = "import os.path\ntry:\n    os.path\nexcept ValueError as e:\n    print(e, lost)\nmatch os:\n    case [a, *b]:\n        print(a, b)\n    case {'k': c, **d}:\n        print(c, d)"
    df = q.with_code_facts(spark.createDataFrame([(code,)], "code string"), "code")
    facts = df.first()["_facts"]
    assert set(facts["used"]) - set(facts["defined"]) == {"print", "ValueError", "lost"}
