"""Registered queries: dataset generation over table-derived catalogs and tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.template import render_table
from ..operators import generate as g
from ..operators.params import bind_params, draw_patterns, expand_grid
from .derived import PART_SQL, part_catalog, sql_code, sql_instruction
from .q_sources import RECORDS_SQL
from .registry import query, sql_draw, table

SEED = 7


def _attempts(spark, sf_dir):
    """One attempt per order, numbered by its key."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("attempt"))


def _shown(name):
    return F.element_at("ctx", F.lit(name))["v"].alias(name)


def _pick(items: str, attempt: str, name: str) -> str:
    draw = sql_draw(f"'{SEED}:' || {attempt} || ':' || pattern_id || ':{name}'")
    return f"{items}[1 + {draw} % len({items})]"


_SIZES = "[size0, size0 + 1, size0 + 2]"
_INDEXED = f"SELECT *, row_number() OVER (ORDER BY pattern_id) - 1 AS pos FROM ({PART_SQL})"
_DRAWN = f"""
SELECT a.attempt, p.*, {_pick('words', 'a.attempt', 'style')} AS style,
  {_pick(_SIZES, 'a.attempt', 'size')} AS size
FROM (SELECT o_orderkey AS attempt, {sql_draw(f"'{SEED}:' || o_orderkey")} %
        (SELECT count(*) FROM part) AS pos FROM orders) a
JOIN ({_INDEXED}) p USING (pos)"""


@query("draw_patterns", f"SELECT attempt, pattern_id FROM ({_DRAWN})")
def draw(spark, sf_dir):
    catalog = part_catalog(spark, sf_dir).select("pattern_id")
    return draw_patterns(_attempts(spark, sf_dir), catalog, SEED, "pattern_id").select(
        "attempt", "pattern_id"
    )


@query(
    "bind_params",
    f"""
    SELECT attempt, pattern_id, style, size::VARCHAR AS size,
      CASE WHEN flag THEN 'True' ELSE 'False' END AS flag, brand FROM ({_DRAWN})""",
)
def bind(spark, sf_dir):
    catalog = part_catalog(spark, sf_dir).select("pattern_id", "parameters")
    drawn = draw_patterns(_attempts(spark, sf_dir), catalog, SEED, "pattern_id")
    names = ("style", "size", "flag", "brand")
    return bind_params(drawn, SEED).select("attempt", "pattern_id", *[_shown(n) for n in names])


_GRID = f"""
SELECT p.*, style, size, f AS is_on, (si * 3 + zi) * 2 + fi AS grid_no
FROM ({PART_SQL}) p,
  (SELECT unnest(generate_series(0, 1)) AS si), (SELECT unnest(generate_series(0, 2)) AS zi),
  (SELECT unnest([0, 1]) AS fi, unnest([true, false]) AS f),
  LATERAL (SELECT words[si + 1] AS style, size0 + zi AS size)
WHERE si < len(words)"""


@query(
    "expand_grid",
    f"""
    SELECT pattern_id, grid_no::BIGINT AS grid_no, style, size::VARCHAR AS size,
      CASE WHEN is_on THEN 'True' ELSE 'False' END AS flag FROM ({_GRID})""",
)
def grid(spark, sf_dir):
    catalog = part_catalog(spark, sf_dir).select("pattern_id", "parameters")
    rows = expand_grid(catalog, include_bools=True)
    return rows.select("pattern_id", "grid_no", *[_shown(n) for n in ("style", "size", "flag")])


@query(
    "assemble_parts",
    """
    SELECT p_partkey, 'use ' || p_brand || chr(10) || chr(10) || p_name
      || CASE WHEN p_size % 2 = 0 THEN '' ELSE chr(10) || chr(10) || p_type END
      || chr(10) || chr(10) || 'def ' || p_size AS code
    FROM part""",
)
def assemble(spark, sf_dir):
    parts = [
        F.concat(F.lit("use "), "p_brand"),
        F.col("p_name"),
        F.when(F.col("p_size") % 2 != 0, F.col("p_type")).otherwise(""),
        F.lit(None).cast("string"),
        F.concat(F.lit("def "), F.col("p_size").cast("string")),
    ]
    return table(spark, sf_dir, "part").select("p_partkey", g.assemble_parts(parts).alias("code"))


ORDER_TEMPLATE = (
    "Order {{ o_orderkey }} is {{ o_orderpriority | replace('-', ' ') | title }}.\n"
    "{% if o_orderstatus == 'F' %}\n"
    "Closed.\n"
    "{% elif big %}\n"
    "Large and {{ 'open' if 'O' in o_orderstatus else 'partial' }}.\n"
    "{% else %}\n"
    "Other{{ missing }}.\n"
    "{% endif %}\n"
    "Tags:{% for t in tags %} [{{ t | upper }}]{% endfor %} ({{ tags | join(', ') }})"
)


@query(
    "render_table",
    """
    SELECT o_orderkey,
      'Order ' || o_orderkey || ' is ' || CASE o_orderpriority WHEN '1-URGENT' THEN '1 Urgent'
        WHEN '2-HIGH' THEN '2 High' WHEN '3-MEDIUM' THEN '3 Medium'
        WHEN '4-NOT SPECIFIED' THEN '4 Not Specified' WHEN '5-LOW' THEN '5 Low' END || '.' || chr(10)
      || CASE WHEN o_orderstatus = 'F' THEN 'Closed.'
         WHEN o_totalprice > 200000 THEN 'Large and '
           || CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'partial' END || '.'
         ELSE 'Other.' END || chr(10)
      || 'Tags: [' || upper(o_orderstatus) || '] [' || upper(substr(o_orderpriority, 3)) || '] ('
      || o_orderstatus || ', ' || substr(o_orderpriority, 3) || ')' AS text
    FROM orders""",
)
def render(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "big": F.col("o_totalprice") > 200000,
            "tags": F.array("o_orderstatus", F.substr("o_orderpriority", F.lit(3))),
        }
    )
    return render_table(orders, ORDER_TEMPLATE).select("o_orderkey", "text")


@query(
    "render_catalog",
    f"""
    SELECT pattern_id, grid_no::BIGINT AS grid_no,
      CASE WHEN NOT unrendered THEN {sql_instruction('style', 'size')} END AS instruction,
      CASE WHEN NOT unrendered THEN {sql_code('style', 'size', 'is_on')} END AS code,
      CASE WHEN NOT unrendered THEN 'assert f_' || style || '(1) is not None' END AS test,
      unrendered AS failed
    FROM ({_GRID})""",
)
def render_catalog(spark, sf_dir):
    ready = g.compile_catalog(part_catalog(spark, sf_dir))
    samples = g.render_samples(expand_grid(ready, include_bools=True))
    return samples.select(
        "pattern_id",
        "grid_no",
        "instruction",
        "code",
        F.get("tests", F.lit(0)).alias("test"),
        F.col("render_error").isNotNull().alias("failed"),
    )


@query(
    "render_defaults",
    f"""
    SELECT pattern_id,
      CASE WHEN unrendered THEN imports || chr(10) || chr(10) || setup || chr(10) || chr(10)
          || '{{{{ style | nosuch }}}}'
        ELSE {sql_code('words[1]', 'size0', 'flag')} || CASE WHEN broken THEN '' ELSE chr(10) END END AS code,
      'assert f_' || words[1] || '(1) is not None' AS tests
    FROM ({PART_SQL})""",
)
def render_defaults(spark, sf_dir):
    rows = g.render_defaults(part_catalog(spark, sf_dir))
    return rows.select("pattern_id", "code", F.array_join("tests", "|").alias("tests"))


@query(
    "dedup_md5",
    "SELECT min(doc_id) AS doc_id, md5(text) AS md5 FROM documents WHERE text <> '' GROUP BY text",
)
def dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return g.dedup_md5(docs, "text", "doc_id").select("doc_id", "md5")


_BATCH = 4


@query(
    "generate_batch",
    f"""
    WITH tries AS (
      SELECT p.*, t AS attempt, {_pick('words', 't', 'style')} AS style,
        {_pick(_SIZES, 't', 'size')} AS size
      FROM ({PART_SQL}) p, (SELECT unnest(generate_series(0, {_BATCH - 1})) AS t)
      WHERE NOT unrendered),
    named AS (SELECT *, {sql_code('style', 'size', 'flag')} AS code FROM tries)
    SELECT pattern_id, min(attempt)::BIGINT AS attempt, code
    FROM named GROUP BY pattern_id, code, broken, starred
    HAVING min(attempt) > 0 OR NOT (broken OR starred)""",
)
def batch(spark, sf_dir):
    rows = g.generate_batch(part_catalog(spark, sf_dir), None, _BATCH, SEED)
    return rows.select("pattern_id", F.col("attempt").cast("long").alias("attempt"), "code")


_JUDGED = f"""
WITH drawn AS ({_DRAWN}),
named AS (SELECT *, {sql_code('style', 'size', 'flag')} AS code,
            {sql_instruction('style', 'size')} AS instruction FROM drawn),
firsts AS (SELECT * FROM named WHERE NOT unrendered
           QUALIFY row_number() OVER (PARTITION BY code ORDER BY attempt) = 1)
SELECT attempt, pattern_id, instruction, code, NOT (broken OR starred) AS ok FROM firsts"""


@query(
    "generate_attempts",
    f"""
    SELECT attempt, pattern_id, instruction, code,
      CASE WHEN ok THEN 'accepted' ELSE 'invalid' END AS outcome FROM ({_JUDGED})
    UNION ALL
    SELECT min(attempt), pattern_id, NULL, NULL, 'render_error'
    FROM ({_DRAWN}) WHERE unrendered GROUP BY pattern_id, style, size""",
)
def attempts(spark, sf_dir):
    judged = g.generate_attempts(part_catalog(spark, sf_dir), _attempts(spark, sf_dir), SEED)
    return judged.select("attempt", "pattern_id", "instruction", "code", "outcome")


def flagship(spark, sf_dir):
    """As many records as the catalog has patterns, from at most 200 attempts each."""
    catalog = part_catalog(spark, sf_dir)
    samples, report = g.generate_dataset(catalog, catalog.count(), SEED)
    return samples, report


@query(
    "generate_dataset",
    f"""
    WITH size AS (SELECT count(*) AS n FROM part),
    attempts AS (SELECT unnest(generate_series(0, (SELECT n * 200 - 1 FROM size))) AS o_orderkey),
    judged AS ({_JUDGED.replace('FROM orders)', 'FROM attempts)')})
    SELECT attempt, pattern_id, instruction, '' AS input, code AS output
    FROM judged WHERE ok ORDER BY attempt LIMIT (SELECT n FROM size)""",
)
def dataset(spark, sf_dir):
    samples, _ = flagship(spark, sf_dir)
    return samples.select(
        "attempt", "pattern_id", "instruction", F.lit("").alias("input"), F.col("code").alias("output")
    )


@query("instruction_records", RECORDS_SQL)
def records(spark, sf_dir):
    return g.turns_to_records(table(spark, sf_dir, "conversations"))


@query(
    "pair_flawed_fixed",
    f"""
    WITH sides AS (SELECT pattern_id, style, size, is_on, {sql_code('style', 'size', 'is_on')} AS code
                   FROM ({_GRID}) WHERE NOT unrendered)
    SELECT a.pattern_id, a.code AS flawed, b.code AS fixed
    FROM sides a JOIN sides b USING (pattern_id, style, size) WHERE a.is_on AND NOT b.is_on""",
)
def pairs(spark, sf_dir):
    ready = g.compile_catalog(part_catalog(spark, sf_dir))
    samples = expand_grid(ready, include_bools=True)
    rendered = g.render_samples(samples).filter(F.col("render_error").isNull())
    return g.pair_flawed_fixed(rendered, "flag").select("pattern_id", "flawed", "fixed")
