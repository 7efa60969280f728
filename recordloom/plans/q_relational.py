"""Registered queries: relational operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values as v
from ..operators import relational as r
from .registry import query, spread_table, table


@query("filter_map", "SELECT p_partkey, (p_size * p_size)::BIGINT AS squared FROM part WHERE p_size % 2 = 0")
def filter_map(spark, sf_dir):
    size = F.col("p_size").cast("long")
    rows = r.filter_map(table(spark, sf_dir, "part"), size % 2 == 0, size * size, "squared")
    return rows.select("p_partkey", "squared")


@query("build_map", 'SELECT p_brand AS "key", arg_max(p_name, p_partkey) AS "value" FROM part GROUP BY 1')
def build_map(spark, sf_dir):
    return r.build_map(table(spark, sf_dir, "part"), F.col("p_brand"), F.col("p_name"), F.col("p_partkey"))


@query("distinct_map", "SELECT DISTINCT (p_size * p_size)::BIGINT AS squared FROM part")
def distinct_map(spark, sf_dir):
    size = F.col("p_size").cast("long")
    return r.distinct_map(table(spark, sf_dir, "part"), size * size, "squared")


@query(
    "group_lists",
    """
    SELECT o_custkey, 0::BIGINT AS part, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS items
    FROM orders GROUP BY o_custkey""",
)
def group_lists(spark, sf_dir):
    lists = r.group_lists(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderkey")
    return lists.withColumn("items", F.array_join("items", ","))


@query(
    "most_common",
    """
    SELECT l_partkey, count(*) AS n, min(l_orderkey) AS first_at FROM lineitem
    GROUP BY 1 ORDER BY n DESC, first_at, l_partkey LIMIT 20""",
)
def most_common(spark, sf_dir):
    return r.most_common(table(spark, sf_dir, "lineitem"), "l_partkey", 20, "l_orderkey")


@query("cartesian", "SELECT p_partkey, r_name, q AS quarter FROM part, region, (SELECT unnest([1, 2]) AS q)")
def cartesian(spark, sf_dir):
    names = [x["r_name"] for x in r.bounded_values(table(spark, sf_dir, "region"), ["r_name"])]
    part = table(spark, sf_dir, "part").select("p_partkey")
    return r.cartesian(part, {"r_name": names, "quarter": [1, 2]})


@query(
    "pairs",
    """
    SELECT p_partkey, l[i] AS first, l[j] AS second
    FROM (SELECT p_partkey, list_concat(string_split(p_name, ' '), [p_type, p_brand]) AS l FROM part),
      (SELECT unnest(generate_series(1, 4)) AS i), (SELECT unnest(generate_series(1, 4)) AS j)
    WHERE i < j AND j <= len(l)""",
)
def pairs(spark, sf_dir):
    options = F.concat(F.split("p_name", " "), F.array("p_type", "p_brand"))
    rows = table(spark, sf_dir, "part").select("p_partkey", options.alias("options"))
    return r.array_pairs(rows, "options").select("p_partkey", "first", "second")


@query(
    "membership",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 45)""",
)
def membership(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").filter("l_quantity >= 45").select("l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return r.membership(orders, "o_orderkey", keys, "l_orderkey")


@query(
    "membership_counts",
    """
    SELECT count(*) FILTER (WHERE k) AS n_in, count(*) FILTER (WHERE NOT k) AS n_out
    FROM (SELECT l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AS k FROM lineitem)""",
)
def membership_counts(spark, sf_dir):
    probes = table(spark, sf_dir, "lineitem").select("l_orderkey")
    closed = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    return r.membership_counts(probes, "l_orderkey", closed, "o_orderkey")


@query(
    "update_where",
    "SELECT * REPLACE (CASE WHEN p_type = 'SMALL' THEN 0 ELSE p_size END AS p_size) FROM part",
)
def update_where(spark, sf_dir):
    return r.update_where(table(spark, sf_dir, "part"), F.col("p_type") == "SMALL", "p_size", F.lit(0))


@query(
    "column_arithmetic",
    "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * l_quantity, 2) AS total_value FROM lineitem",
)
def column_arithmetic(spark, sf_dir):
    rows = r.with_total(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.round("total_value", 2).alias("total_value"))


@query(
    "enumerate_rows",
    """
    SELECT o_orderkey, "index", 'Index: ' || "index" || ', Item: ''' || o_orderpriority || '''' AS line
    FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS "index" FROM orders)""",
)
def enumerate_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    rows = r.enumerate_rows(orders, [F.col("o_totalprice").desc(), "o_orderkey"], "o_orderpriority")
    return rows.select("o_orderkey", "index", "line")


@query(
    "slice_array",
    """
    SELECT vec_id, round(e[1]::DOUBLE, 6) AS first, round(e[-1]::DOUBLE, 6) AS last,
      array_to_string(list_transform(e[3:5], lambda x: round(x::DOUBLE, 4)::VARCHAR), ' ') AS middle
    FROM (SELECT vec_id, embedding AS e FROM embeddings)""",
)
def slice_array(spark, sf_dir):
    first, last, middle = v.array_parts(F.col("embedding").cast("array<double>"))
    shown = F.transform(middle, lambda x: F.regexp_replace(F.format_number(x, 4), r"(\.\d+?)0+$", "$1"))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.round(first, 6).alias("first"), F.round(last, 6).alias("last"),
        F.array_join(shown, " ").alias("middle"),
    )


@query(
    "bucketize",
    """
    SELECT event_id, CASE WHEN value >= 90 THEN 'A' WHEN value >= 80 THEN 'B' WHEN value >= 70 THEN 'C'
      WHEN value >= 60 THEN 'D' ELSE 'F' END AS grade FROM events""",
)
def bucketize(spark, sf_dir):
    cuts = [(90, "A"), (80, "B"), (70, "C"), (60, "D")]
    return table(spark, sf_dir, "events").select(
        "event_id", v.bucketize(F.col("value"), cuts, "F").alias("grade")
    )


@query(
    "map_get",
    """
    SELECT event_id, (props->>'$.k')::BIGINT AS k, NULL::BIGINT AS missing, -1::BIGINT AS with_default,
      (props->>'$.k')::BIGINT AS kept, 7::BIGINT AS added, 2::BIGINT AS n_keys
    FROM events""",
)
def map_get(spark, sf_dir):
    props = F.from_json("props", "map<string,bigint>")
    one = F.lit(7).cast("long")
    return table(spark, sf_dir, "events").select("event_id", props.alias("m")).select(
        "event_id",
        v.map_get(F.col("m"), "k").alias("k"),
        v.map_get(F.col("m"), "z").alias("missing"),
        v.map_get(F.col("m"), "z", -1).alias("with_default"),
        v.map_get(v.map_set_default(F.col("m"), "k", 0), "k").alias("kept"),
        v.map_get(v.map_set_default(F.col("m"), "z", 7), "z").alias("added"),
        F.size(v.map_set_default(F.col("m"), "z", 7)).cast("long").alias("n_keys"),
    )


@query(
    "safe_divide",
    """
    SELECT event_id, round(value / nullif((props->>'$.k')::BIGINT % 5, 0), 6) AS ratio, NULL::DOUBLE AS bad
    FROM events""",
)
def safe_divide(spark, sf_dir):
    k = F.get_json_object("props", "$.k").try_cast("bigint") % 5
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.round(v.safe_divide(F.col("value"), k), 6).alias("ratio"),
        v.safe_divide(F.col("event_type"), F.lit(2)).alias("bad"),
    )


def _payload(spark, sf_dir):
    """JSON payloads built from events; some ids are not whole numbers, some mails are broken."""
    mail = F.when(F.col("user_id") % 4 == 0, "nobody").otherwise(F.concat("event_type", F.lit("@x.org")))
    body = F.struct(
        F.when(F.col("event_id") % 7 != 0, F.col("value").cast("string")).alias("amount"),
        F.col("user_id").cast("string").alias("id"),
        mail.alias("email"),
        F.array("event_type").alias("tags"),
    )
    return spread_table(spark, sf_dir, "events").select("event_id", F.to_json(body).alias("payload"))


_FIELDS = {"id": "int", "amount": "double", "email": "string", "tags": "array<string>"}


def _coerced(spark, sf_dir):
    rule = {"email has no @": F.contains("email", F.lit("@"))}
    return r.coerce(_payload(spark, sf_dir), "payload", _FIELDS, rule)


@query(
    "coerce_quarantine",
    """
    SELECT event_id, user_id AS id, value AS amount, event_type || '@x.org' AS email, event_type AS tag
    FROM events WHERE event_id % 7 <> 0 AND user_id % 4 <> 0""",
)
def coerce_good(spark, sf_dir):
    good, _ = _coerced(spark, sf_dir)
    return good.select("event_id", "id", "amount", "email", F.col("tags")[0].alias("tag"))


@query(
    "coerce_rejected",
    """
    SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'amount is missing' ELSE 'email has no @' END AS reason
    FROM events WHERE event_id % 7 = 0 OR user_id % 4 = 0""",
)
def coerce_bad(spark, sf_dir):
    _, bad = _coerced(spark, sf_dir)
    return bad.select("event_id", "reason")


@query(
    "coerce_integers",
    r"""
    SELECT event_id, CASE WHEN regexp_full_match(value::VARCHAR, '\d+\.0') THEN NULL ELSE 'amount has the wrong type' END AS reason
    FROM events WHERE NOT regexp_full_match(value::VARCHAR, '\d+')""",
)
def coerce_integers(spark, sf_dir):
    text = F.to_json(F.struct(F.col("value").cast("string").alias("amount")))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("payload"))
    _, bad = r.coerce(rows, "payload", {"amount": "int"})
    whole = F.get_json_object("payload", "$.amount").rlike(r"^\d+\.0$")
    return bad.select("event_id", F.when(~whole, F.col("reason")).alias("reason"))


@query(
    "sum_numbers",
    """
    SELECT round(sum(value) FILTER (WHERE user_id % 3 <> 0), 2) AS total,
      count(*) FILTER (WHERE user_id % 3 = 0) AS n_skipped FROM events""",
)
def sum_numbers(spark, sf_dir):
    text = F.when(F.col("user_id") % 3 == 0, F.col("event_type")).otherwise(F.col("value").cast("string"))
    rows = table(spark, sf_dir, "events").select(text.alias("item"))
    return r.sum_numbers(rows, "item").withColumn("total", F.round("total", 2))


@query("sort_rows", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey")
def sort_rows(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return r.sort_rows(supplier, "s_acctbal", "s_suppkey")


@query(
    "sort_array",
    """
    SELECT vec_id, list_sort(e)[1]::DOUBLE AS lowest, list_sort(e)[32]::DOUBLE AS middle, list_sort(e)[-1]::DOUBLE AS highest
    FROM (SELECT vec_id, embedding AS e FROM embeddings)""",
)
def sort_array(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.array_sort(F.col("embedding").cast("array<double>")).alias("s")
    )
    return rows.select(
        "vec_id",
        F.element_at("s", F.lit(1)).alias("lowest"),
        F.element_at("s", F.lit(32)).alias("middle"),
        F.element_at("s", F.lit(-1)).alias("highest"),
    )


@query(
    "op_dispatch",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
      round(CASE l_returnflag WHEN 'A' THEN l_quantity + l_tax WHEN 'N' THEN l_quantity - l_tax END, 6) AS result,
      CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'unknown operation: ' || l_returnflag END AS error
    FROM lineitem""",
)
def op_dispatch(spark, sf_dir):
    flag = F.col("l_returnflag")
    op = F.when(flag == "A", "add").when(flag == "N", "subtract").otherwise(flag)
    result, error = v.op_dispatch(F.col("l_quantity"), F.col("l_tax"), op, as_float=True)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(result, 6).alias("result"), error.alias("error")
    )


@query(
    "sum_squares",
    "SELECT sum(l_orderkey::HUGEINT * l_orderkey)::VARCHAR AS sum_squares FROM lineitem",
)
def sum_squares(spark, sf_dir):
    return r.sum_squares(table(spark, sf_dir, "lineitem"), F.col("l_orderkey")).select(
        F.col("sum_squares").cast("string").alias("sum_squares")
    )


@query(
    "ledger_fold",
    """
    SELECT user_id, round(s.b, 2) AS balance, s.a AS n_accepted, s.r AS n_rejected
    FROM (SELECT user_id, list_reduce(
        list_prepend({'b': 0.0::DOUBLE, 'a': 0::BIGINT, 'r': 0::BIGINT, 'm': 0.0::DOUBLE, 'd': true},
          list({'b': 0.0::DOUBLE, 'a': 0::BIGINT, 'r': 0::BIGINT, 'm': value - 5, 'd': event_type IN ('click', 'view')} ORDER BY event_id)),
        lambda x, y: {
          'b': x.b + CASE WHEN y.m > 0 AND y.d THEN y.m WHEN y.m > 0 AND y.m <= x.b THEN -y.m ELSE 0 END,
          'a': x.a + CASE WHEN y.m > 0 AND (y.d OR y.m <= x.b) THEN 1 ELSE 0 END,
          'r': x.r + CASE WHEN y.m > 0 AND (y.d OR y.m <= x.b) THEN 0 ELSE 1 END, 'm': y.m, 'd': y.d}) AS s
      FROM events GROUP BY user_id)""",
)
def ledger_fold(spark, sf_dir):
    kind = F.when(F.col("event_type").isin("click", "view"), "deposit").otherwise("withdraw")
    moves = table(spark, sf_dir, "events").select(
        "user_id", "event_id", (F.col("value") - 5).alias("amount"), kind.alias("kind")
    )
    rows = r.ledger(moves, "user_id", "event_id", "amount", "kind")
    return rows.withColumn("balance", F.round("balance", 2))
