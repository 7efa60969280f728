import pytest
from pyspark.sql import functions as F

from recordloom.functions.template import (
    COMPILED,
    VALUE,
    TemplateError,
    compile_json,
    parse_template,
    render_segments,
    render_table,
)

# (template, expected text) for the row below
CASES = [
    ("plain", "plain"),
    ("a\n", "a"),
    ("a\n\n", "a\n"),
    ("{{ name }}!", "ann lee!"),
    ("{{ nothing }}|", "|"),
    ("{{ name | title }}", "Ann Lee"),
    ("{{ name | replace(' ', '_') | upper }}", "ANN_LEE"),
    ("{{ name.replace('a', 'o') }}", "onn lee"),
    ("{{ yes }} {{ no }} {{ n }}", "True False 0"),
    ("{{ 'min' if 'lee' in name else 'max' }}", "min"),
    ("{{ '}}' }}{{ '{%' }}", "}}{%"),
    ("{% if yes %}\nA\n{% else %}\nB\n{% endif %}\nend", "A\nend"),
    ("x\n  {% if no %}\n  A\n  {% elif n == 0 %}\n  B\n  {% else %}\n  C\n  {% endif %}\ny", "x\n  B\ny"),
    ("{% if n %}N{% endif %}{% if not n %}Z{% endif %}", "Z"),
    ("{% if name != 'bob' %}ok{% endif %}", "ok"),
    ("{% if 'q' not in name %}ok{% endif %}", "ok"),
    ("{% if yes %}{% if no %}1{% else %}2{% endif %}{% endif %}", "2"),
    ("[{% for w in words %}<{{ w | title }}>{% endfor %}]", "[<Red><Blue>]"),
    ("{{ words | join('+') }}", "red+blue"),
    ("{% raw %}{{ name }}{% endraw %}", "{{ name }}"),
    ("a {# note #} b", "a  b"),
    ("a\n  {# note #}\nb", "a\nb"),
    ("a  {%- if yes %} b {%- endif %} c", "a b c"),
    ("a {% if yes -%}   b{% endif %}", "a b"),
    ("text {% if yes %}\nmore{% endif %}", "text more"),
]
BAD = ["{{ a + b }}", "{{ x | nope }}", "{% if x %}", "{% endif %}", "{{ x", "{% foo %}", "{{ x.y.z }}",
       "{% if a and b %}1{% endif %}", "{% raw %}x", "{{{ x }}", "{{ n:, }}"]


@pytest.fixture(scope="module")
def row(spark):
    return spark.sql("SELECT 'ann lee' AS name, true AS yes, false AS no, 0 AS n, array('red','blue') AS words")


@pytest.mark.parametrize("template,expected", CASES)
def test_column_target(row, template, expected):
    assert render_table(row, template).first()["text"] == expected


def test_segment_target(spark):
    def value(v, k, items=None):
        return dict(v=v, k=k, items=items)

    ctx = dict(
        name=value("ann lee", "str"),
        yes=value("True", "bool"),
        no=value("False", "bool"),
        n=value("0", "num"),
        words=value("['red', 'blue']", "list", ["red", "blue"]),
    )
    data = [(i, compile_json(t), ctx) for i, (t, _) in enumerate(CASES)]
    df = spark.createDataFrame(data, f"i int, j string, ctx map<string,{VALUE}>")
    done = df.withColumn("c", F.from_json("j", COMPILED)).select(
        "i", "c.error", render_segments("c.segments", "ctx").alias("text")
    )
    for r in done.collect():
        assert r["error"] is None
        assert r["text"] == CASES[r["i"]][1], CASES[r["i"]][0]


@pytest.mark.parametrize("template", BAD)
def test_outside_the_subset(template):
    with pytest.raises(TemplateError):
        parse_template(template)


def test_null_and_missing(spark):
    df = spark.sql("SELECT CAST(NULL AS string) AS s, CAST(NULL AS boolean) AS b")
    assert render_table(df, "{{ s }}{{ b }}{% if b %}x{% endif %}").first()["text"] == "NoneNone"


def test_title_filter_and_doubles_follow_the_template_language(spark):
    from recordloom.functions.template import template_column

    names = ["foo_bar l'amour 3d", "x-ray (beta) [two]<three>", "ÉTÉ a\u00a0b", ""]
    shown = ["Foo_bar L'amour 3d", "X-Ray (Beta) [Two]<Three>", "Été A\u00a0B", ""]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    assert [r[0] for r in df.select(template_column("{{ s | title }}", df.schema)).collect()] == shown
    values = [12345678.9, 0.0001, 1e-05, 1e16, 123456789012345.6, -2.5e-7, 1e7, 0.1, 3.0, 1.5e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(template_column("{{ v }}", df.schema)).collect()] == [str(v) for v in values]
