"""Registered queries: metrics, statistics, features, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as a
from ..operators import evaluate as e
from ..operators import features as f
from .registry import query, sql_draw, table

# -------------------------------------------------------------- classification

LABEL_SQL = (
    "(SELECT quality::BIGINT AS y, CASE WHEN n_chars > 1500 THEN 1 WHEN n_chars > 300 THEN 2 ELSE 0 END::BIGINT AS p, "
    "source FROM labels JOIN documents USING (doc_id))"
)
REPORT_SQL = """
WITH l AS {labels},
c AS (SELECT label, sum(tp) AS tp, sum(pred) AS pred, sum(sup) AS support FROM (
  SELECT y::VARCHAR AS label, (y = p)::INT AS tp, 0 AS pred, 1 AS sup FROM l
  UNION ALL SELECT p::VARCHAR, 0, 1, 0 FROM l) GROUP BY label),
pr AS (SELECT label, support::BIGINT AS support, tp, coalesce(tp / nullif(pred, 0), 0) AS precision,
  coalesce(tp / nullif(support, 0), 0) AS recall FROM c),
s AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pr)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM s
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
  round(sum(tp) / sum(support), 6), sum(support)::BIGINT FROM s
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  sum(support)::BIGINT FROM s
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  sum(support)::BIGINT FROM s"""


def labelled(spark, sf_dir):
    """Quality labels (y) against a length rule (p)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    n = F.col("n_chars")
    rule = F.when(n > 1500, 1).when(n > 300, 2).otherwise(0).cast("long")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        F.col("quality").cast("long").alias("y"), rule.alias("p"), "source"
    )


@query(
    "confusion_matrix",
    f"""
    WITH l AS {LABEL_SQL}, k AS (SELECT y AS c FROM l UNION SELECT p FROM l)
    SELECT a.c AS y, b.c AS p, (SELECT count(*) FROM l WHERE l.y = a.c AND l.p = b.c) AS n FROM k a, k b""",
)
def confusion_matrix(spark, sf_dir):
    return e.confusion_matrix(labelled(spark, sf_dir), "y", "p")


@query("classification_report", REPORT_SQL.format(labels=LABEL_SQL))
def classification_report(spark, sf_dir):
    report = e.classification_report(labelled(spark, sf_dir), "y", "p")
    return report.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "accuracy",
    f"SELECT source, round(avg((y = p)::INT), 6) AS accuracy, count(*) AS n FROM {LABEL_SQL} GROUP BY source",
)
def accuracy(spark, sf_dir):
    rows = e.accuracy(labelled(spark, sf_dir), "y", "p", ["source"])
    return rows.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "phase_means",
    """
    SELECT event_type AS phase, (event_id % 3)::BIGINT AS epoch, round(avg(value), 6) AS mean_loss,
      round(avg((user_id % 2 = 0)::INT), 6) AS accuracy FROM events GROUP BY 1, 2""",
)
def phase_means(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("phase"),
        (F.col("event_id") % 3).alias("epoch"),
        "value",
        (F.col("user_id") % 2 == 0).cast("int").alias("hit"),
    )
    means = e.phase_means(rows, ["phase", "epoch"], "value", "hit")
    return means.withColumns({c: F.round(c, 6) for c in ("mean_loss", "accuracy")})


# ------------------------------------------------------------------ statistics


def daily(spark, sf_dir):
    """Mean value per event type and day number."""
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01")).cast("long")
    return table(spark, sf_dir, "events").groupBy("event_type", day.alias("day")).agg(
        F.round(F.avg("value"), 6).alias("value")
    )


_DAILY = """
(SELECT event_type, date_diff('day', DATE '2024-01-01', ts::DATE) AS day, round(avg(value), 6) AS value
 FROM events GROUP BY 1, 2)"""


@query(
    "auc_trapezoid",
    f"""
    SELECT event_type, round(coalesce(sum((day - ld) * (value + lv) / 2), 0), 4) AS auc
    FROM (SELECT *, lag(day) OVER w AS ld, lag(value) OVER w AS lv FROM {_DAILY}
          WINDOW w AS (PARTITION BY event_type ORDER BY day)) GROUP BY 1""",
)
def auc_trapezoid(spark, sf_dir):
    areas = e.auc(daily(spark, sf_dir), ["event_type"], "day", "value")
    return areas.withColumn("auc", F.round("auc", 4))


_U = """
WITH v AS (SELECT value, count(*) FILTER (WHERE event_type = 'click')::DOUBLE AS a,
    count(*) FILTER (WHERE event_type = 'view')::DOUBLE AS b
  FROM events WHERE event_type IN ('click', 'view') GROUP BY value),
r AS (SELECT *, coalesce(sum(b) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM v),
s AS (SELECT sum(a) AS na, sum(b) AS nb, sum(a * (below + b / 2)) AS u, sum((a + b) ^ 3 - (a + b)) AS t FROM r)
SELECT na::BIGINT AS n_a, nb::BIGINT AS n_b, u, round((u - na * nb / 2 - 0.5) /
  sqrt(na * nb / 12 * ((na + nb + 1) - t / ((na + nb) * (na + nb - 1)))), 6) AS z FROM s"""


@query("mann_whitney_u", _U)
def mann_whitney_u(spark, sf_dir):
    row = e.mann_whitney(table(spark, sf_dir, "events"), "event_type", "value", "click", "view")
    return row.select("n_a", "n_b", "u", F.round("z", 6).alias("z"))


@query(
    "t_test_ind",
    """
    WITH s AS (SELECT count(*) FILTER (WHERE event_type = 'click') AS na, count(*) FILTER (WHERE event_type = 'view') AS nb,
      avg(value) FILTER (WHERE event_type = 'click') AS ma, avg(value) FILTER (WHERE event_type = 'view') AS mb,
      var_samp(value) FILTER (WHERE event_type = 'click') AS va, var_samp(value) FILTER (WHERE event_type = 'view') AS vb
      FROM events)
    SELECT na AS n_a, nb AS n_b, na + nb - 2 AS df,
      round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1.0 / na + 1.0 / nb)), 6) AS t FROM s""",
)
def t_test_ind(spark, sf_dir):
    row = e.t_test_ind(table(spark, sf_dir, "events"), "event_type", "value", "click", "view")
    return row.select("n_a", "n_b", "df", F.round("t", 6).alias("t"))


# Upper tails by Simpson's rule: from the statistic up to where the density has vanished.
_TAIL = """
(SELECT sum(f * CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * 40 / 20000 / 3
 FROM (SELECT i, {density} AS f FROM (SELECT i, {at} + i * 40 / 20000.0 AS x FROM generate_series(0, 20000) AS g(i))))"""
_P_U = _TAIL.format(at="z", density="exp(-x * x / 2) / sqrt(2 * pi())")
_P_T = _TAIL.format(
    at="t",
    density="exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0)) / sqrt(df * pi()) * (1 + x * x / df) ** (-(df + 1) / 2.0)",
)


@query(
    "significance_flag",
    f"""
    WITH u AS (SELECT z FROM ({_U.replace("round((u", "((u").replace(", 6) AS z", ") AS z")})),
    s AS (SELECT count(*) FILTER (WHERE event_type = 'click') AS na, count(*) FILTER (WHERE event_type = 'view') AS nb,
      avg(value) FILTER (WHERE event_type = 'click') AS ma, avg(value) FILTER (WHERE event_type = 'view') AS mb,
      var_samp(value) FILTER (WHERE event_type = 'click') AS va, var_samp(value) FILTER (WHERE event_type = 'view') AS vb
      FROM events),
    t AS (SELECT na + nb - 2 AS df,
      (ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1.0 / na + 1.0 / nb)) AS t FROM s),
    p AS (SELECT 'u' AS test, {_P_U} AS p FROM u UNION ALL SELECT 't', {_P_T} FROM t)
    SELECT test, round(p, 6) AS p_value, p < {e.ALPHA} AS reject FROM p""",
)
def significance_flag(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "value")
    both = [
        fn(events, "event_type", "value", "click", "view").select(F.lit(name).alias("test"), "p_value")
        for name, fn in (("u", e.mann_whitney), ("t", e.t_test_ind))
    ]
    flagged = e.significance_flag(both[0].unionAll(both[1]))
    return flagged.withColumn("p_value", F.round("p_value", 6))


@query(
    "group_curve",
    """
    SELECT event_type, date_diff('day', DATE '2024-01-01', ts::DATE) AS day, round(avg(value), 6) AS mean,
      round(stddev_samp(value), 6) AS sd, count(*) AS n FROM events GROUP BY 1, 2""",
)
def group_curve(spark, sf_dir):
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01")).cast("long")
    rows = table(spark, sf_dir, "events").select("event_type", day.alias("day"), "value")
    return e.group_curve(rows, "event_type", "day", "value").withColumns(
        {c: F.round(c, 6) for c in ("mean", "sd")}
    )


# ----------------------------------------------------------------- experiments

_SEEDS = [11, 22, 33]


@query(
    "experiment_grid",
    f"""
    SELECT s_name, seed::BIGINT AS seed, (si * (SELECT count(*) FROM supplier) + pos + 1)::BIGINT AS run_no,
      round({sql_draw("seed || ':' || s_name")} / 4294967296.0, 6) AS score
    FROM (SELECT s_name, row_number() OVER (ORDER BY s_name) - 1 AS pos FROM supplier),
      (SELECT unnest([0, 1, 2]) AS si, unnest({_SEEDS}) AS seed)""",
)
def experiment_grid(spark, sf_dir):
    configs = table(spark, sf_dir, "supplier").select("s_name")
    grid = e.experiment_grid(configs, "s_name", _SEEDS)
    return grid.select("s_name", F.col("seed").cast("long").alias("seed"), "run_no", F.round("score", 6).alias("score"))


@query(
    "select_champion",
    """
    SELECT s_suppkey, round((s_nationkey + 1) * ln(100) - 2 * ln(1 / ((s_acctbal + 2000) / 20000)), 6) AS criterion
    FROM supplier ORDER BY (s_nationkey + 1) * ln(100) - 2 * ln(1 / ((s_acctbal + 2000) / 20000)), s_suppkey LIMIT 1""",
)
def select_champion(spark, sf_dir):
    params, score = F.col("s_nationkey") + 1, (F.col("s_acctbal") + 2000) / 20000
    best = e.select_champion(table(spark, sf_dir, "supplier"), "s_suppkey", params, score)
    return best.select("s_suppkey", F.round("criterion", 6).alias("criterion"))


@query(
    "best_checkpoint",
    f"""
    WITH p AS (SELECT *, row_number() OVER w AS pos, max(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
      FROM {_DAILY} WINDOW w AS (PARTITION BY event_type ORDER BY day)),
    h AS (SELECT *, max(CASE WHEN best IS NULL OR value > best THEN pos END) OVER (PARTITION BY event_type ORDER BY day) AS hit FROM p),
    s AS (SELECT event_type, min(CASE WHEN pos - hit >= 3 THEN day END) AS stop_step FROM h GROUP BY 1),
    k AS (SELECT h.*, s.stop_step FROM h JOIN s USING (event_type) WHERE s.stop_step IS NULL OR day <= s.stop_step)
    SELECT event_type, arg_max(day, value * 1000000 - day * 0.0000001) AS best_step, max(value) AS best_metric,
      any_value(stop_step) AS stop_step FROM k GROUP BY 1""",
)
def best_checkpoint(spark, sf_dir):
    return e.best_checkpoint(daily(spark, sf_dir), "event_type", "day", "value", "max", 3)


# -------------------------------------------------------------------- features

_YEAR = "year(l_shipdate) < 1998"


@query(
    "standard_scaler",
    f"""
    WITH s AS (SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, avg(l_discount) AS dm, stddev_pop(l_discount) AS ds
      FROM lineitem WHERE {_YEAR})
    SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - qm) / qs, 6) AS l_quantity_scaled,
      round((l_discount - dm) / ds, 6) AS l_discount_scaled FROM lineitem, s""",
)
def standard_scaler(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    cols = ["l_quantity", "l_discount"]
    stats = f.fit_scaler(items.filter(F.year("l_shipdate") < 1998), cols)
    return f.apply_scaler(items, stats).select(
        "l_orderkey", "l_linenumber", "l_partkey", *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in cols]
    )


def _skew_sql(col: str) -> str:
    return f"""
    SELECT '{col}' AS feature, round(tm, 6) AS train_mean, round(ts, 6) AS train_sd, round(sm, 6) AS serve_mean,
      round(ss, 6) AS serve_sd, round(sm - tm, 6) AS mean_shift, round(ss / ts, 6) AS sd_ratio,
      round((sm - tm) / ts, 6) AS serve_scaled, round(0.0 - (sm - tm) / ts, 6) AS refit_error
    FROM (SELECT avg({col}) FILTER (WHERE {_YEAR}) AS tm, stddev_pop({col}) FILTER (WHERE {_YEAR}) AS ts,
      avg({col}) FILTER (WHERE NOT {_YEAR}) AS sm, stddev_pop({col}) FILTER (WHERE NOT {_YEAR}) AS ss FROM lineitem)"""


@query("skew_report", " UNION ALL ".join(_skew_sql(c) for c in ("l_quantity", "l_extendedprice")))
def skew_report(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    early = F.year("l_shipdate") < 1998
    report = f.skew_report(items.filter(early), items.filter(~early), ["l_quantity", "l_extendedprice"])
    return report.select("feature", *[F.round(c, 6).alias(c) for c in report.columns if c != "feature"])


@query(
    "schema_drift",
    """
    SELECT * FROM (VALUES
      ('c_custkey', 0, 1, 'bigint', 'bigint', 'reordered'), ('c_name', 1, 0, 'string', 'string', 'reordered'),
      ('c_nationkey', 2, 2, 'int', 'bigint', 'retyped'), ('c_acctbal', 3, 3, 'double', 'double', 'same'),
      ('c_mktsegment', 4, NULL, 'string', NULL, 'removed'), ('c_rich', NULL, 4, NULL, 'boolean', 'added'))
      AS t(name, old_pos, new_pos, old_type, new_type, change),
    LATERAL (SELECT CASE WHEN old_pos IS NOT NULL THEN (SELECT count(*) FROM customer) END AS old_filled,
      CASE WHEN name = 'c_rich' THEN (SELECT count(*) FROM customer WHERE c_acctbal > 0)
        WHEN new_pos IS NOT NULL THEN (SELECT count(*) FROM customer) END AS new_filled)""",
)
def schema_drift(spark, sf_dir):
    old = table(spark, sf_dir, "customer")
    new = old.select(
        "c_name",
        "c_custkey",
        F.col("c_nationkey").cast("long").alias("c_nationkey"),
        "c_acctbal",
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") > 5000).alias("c_rich"),
    )
    return f.schema_drift(old, new)


_SPLIT = """
SELECT doc_id, CASE WHEN rn <= {first} THEN 'train' {second} ELSE 'test' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn, count(*) OVER () AS n FROM documents)"""


@query(
    "split_rows",
    _SPLIT.format(
        first="floor(0.8 * n)", second="WHEN rn <= floor(0.8 * n) + floor(0.1 * n) THEN 'val'"
    ),
)
def split_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return f.split_rows(docs, {"train": 0.8, "val": 0.1}, "test", 42, "doc_id")


@query("split_rows_two_way", _SPLIT.format(first="n - ceil(0.3 * n)", second=""))
def split_rows_two_way(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return f.holdout_split(docs, 0.3, 42, "doc_id")


def _batches(order: str) -> str:
    return f"""
    SELECT i // 32 AS batch, count(*) AS n, string_agg(vec_id::VARCHAR, ',' ORDER BY i) AS ids
    FROM (SELECT vec_id, row_number() OVER (ORDER BY {order}) - 1 AS i FROM embeddings) GROUP BY 1"""


def _batched(spark, sf_dir, seed):
    rows = f.batch_rows(table(spark, sf_dir, "embeddings"), 32, "vec_id", ["vec_id"], seed)
    return rows.select("batch", "n", F.array_join(F.transform("rows", lambda x: x["vec_id"]), ",").alias("ids"))


@query("batch_rows", _batches("vec_id"))
def batch_rows(spark, sf_dir):
    return _batched(spark, sf_dir, None)


@query("batch_rows_shuffled", _batches("md5('5:' || vec_id), vec_id"))
def batch_rows_shuffled(spark, sf_dir):
    return _batched(spark, sf_dir, 5)


# ---------------------------------------------------------------------- models


@query(
    "linear_fit_predict",
    """
    WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, round(i + s * l_quantity, 4) AS predicted FROM lineitem, m""",
)
def linear_fit_predict(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    model = f.fit_linear(items, ["l_quantity"], "l_extendedprice")
    rows = f.predict_linear(items, model)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.round("predicted", 4).alias("predicted"))


# Least squares with three features by Cramer's rule on the centred normal equations.
_CROSS = ", ".join(
    f"covar_pop({x}, {y}) AS {n}"
    for n, x, y in (
        ("qq", "q", "q"), ("dd", "d", "d"), ("xx", "x", "x"), ("qd", "q", "d"), ("qx", "q", "x"), ("dx", "d", "x"),
        ("qy", "q", "y"), ("dy", "d", "y"), ("xy", "x", "y"),
    )
)


@query(
    "linear_fit_many",
    f"""
    WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_discount AS d, l_tax AS x, l_extendedprice AS y
      FROM lineitem),
    m AS (SELECT avg(q) AS mq, avg(d) AS md, avg(x) AS mx, avg(y) AS my, {_CROSS} FROM r),
    b AS (SELECT mq, md, mx, my,
      (qy * (dd * xx - dx * dx) - qd * (dy * xx - dx * xy) + qx * (dy * dx - dd * xy)) / det AS bq,
      (qq * (dy * xx - dx * xy) - qy * (qd * xx - dx * qx) + qx * (qd * xy - dy * qx)) / det AS bd,
      (qq * (dd * xy - dy * dx) - qd * (qd * xy - dy * qx) + qy * (qd * dx - dd * qx)) / det AS bx
      FROM (SELECT *, qq * (dd * xx - dx * dx) - qd * (qd * xx - dx * qx) + qx * (qd * dx - dd * qx) AS det FROM m))
    SELECT l_orderkey, l_linenumber, round(my + bq * (q - mq) + bd * (d - md) + bx * (x - mx), 3) AS predicted
    FROM r, b""",
)
def linear_fit_many(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    model = f.fit_linear(items, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    predicted = f.predict_linear(items, model).withColumn("predicted", F.round("predicted", 3))
    return predicted.select("l_orderkey", "l_linenumber", "predicted")


def _logistic_sql(features: list[str], rounds: int = 10) -> str:
    """Newton steps on the score equations; each solves its normal equations by elimination."""
    n = len(features) + 1
    every, pairs = range(n), [(i, j) for i in range(n) for j in range(i, n)]
    z = ["1.0::DOUBLE AS z0"]
    z += [
        f"(x.{c} - avg(x.{c}) FILTER (split = 'train') OVER ()) / stddev_samp(x.{c}) FILTER (split = 'train') OVER () AS z{i}"
        for i, c in enumerate(features, 1)
    ]
    steps = ["c0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS b{i}" for i in every) + ")"]
    margin = " + ".join(f"b{i} * z{i}" for i in every)
    old = ", ".join(f"b{i}" for i in every)
    for r in range(rounds):
        sums = [f"sum((quality - p) * z{i}) AS r{i}" for i in every]
        sums += [f"sum(p * (1 - p) * z{i} * z{j}) AS a{i}{j}" for i, j in pairs]
        steps.append(
            f"s{r}_0 AS (SELECT {', '.join(f'any_value(b{i}) AS b{i}' for i in every)}, {', '.join(sums)} "
            f"FROM (SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM z, c{r} WHERE split = 'train'))"
        )
        for k in range(n - 1):  # row k leaves the rows below it
            below = [f"r{i} - a{k}{i} * r{k} / a{k}{k} AS r{i}" if i > k else f"r{i}" for i in every]
            below += [f"a{i}{j} - a{k}{i} * a{k}{j} / a{k}{k} AS a{i}{j}" if i > k else f"a{i}{j}" for i, j in pairs]
            steps.append(f"s{r}_{k + 1} AS (SELECT {old}, {', '.join(below)} FROM s{r}_{k})")
        solved = []
        for i in reversed(every):
            known = "".join(f" - a{i}{j} * d{j}" for j in range(i + 1, n))
            solved.append(f"(r{i}{known}) / a{i}{i} AS d{i}")
        moved = ", ".join(f"b{i} + d{i} AS b{i}" for i in every)
        steps.append(f"c{r + 1} AS (SELECT {moved} FROM (SELECT {old}, {', '.join(solved)} FROM s{r}_{n - 1}))")
    newline = ",\n"
    return rf"""
    WITH x AS (
      SELECT doc_id, quality, n_chars::DOUBLE AS length, len(string_split_regex(text, '\s+'))::DOUBLE AS words,
             len(string_split(text, chr(10)))::DOUBLE AS lines,
             CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= count(*) OVER () - ceil(0.3 * count(*) OVER ())
               THEN 'train' ELSE 'test' END AS split
      FROM documents JOIN labels USING (doc_id)),
    z AS MATERIALIZED (SELECT doc_id, quality, split, {", ".join(z)} FROM x),
    {newline.join(steps)}
    SELECT doc_id, split, quality, ({margin} > 0)::INT::DOUBLE AS predicted FROM z, c{rounds}"""


@query("logistic_fit_predict", _logistic_sql(["length", "words", "lines"]))
def logistic_fit_predict(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("length"),
        F.size(F.split("text", r"\s+")).cast("double").alias("words"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"),
    )
    rows = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    split = f.holdout_split(rows, 0.3, 42, "doc_id")
    model = f.fit_logistic(split.filter(F.col("split") == "train"), ["length", "words", "lines"], "quality")
    return f.predict_logistic(split, model).select("doc_id", "split", "quality", "predicted")


# --------------------------------------------------------------------- vectors

_E = "list_transform(embedding, lambda x: x::DOUBLE)"


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v"), "label"
    )


@query(
    "projection_feature",
    f"""
    SELECT vec_id, round((list_dot_product(v, list_transform(v, lambda x, i: (i % 2)::DOUBLE)) / sqrt(list_dot_product(v, v))) ^ 2, 6) AS overlap
    FROM (SELECT vec_id, {_E} AS v FROM embeddings)""",
)
def projection_feature(spark, sf_dir):
    basis = F.transform("v", lambda _, i: ((i + 1) % 2).cast("double"))
    return _vectors(spark, sf_dir).select(
        "vec_id", F.round(a.projection(F.col("v"), basis), 6).alias("overlap")
    )


@query(
    "softmax_top1",
    f"""
    SELECT vec_id, (list_position(v, list_max(v)) - 1)::BIGINT AS label,
      round(1 / list_sum(list_transform(v, lambda x: exp(x - list_max(v)))), 6) AS confidence
    FROM (SELECT vec_id, {_E} AS v FROM embeddings)""",
)
def softmax_top1(spark, sf_dir):
    return _vectors(spark, sf_dir).select("vec_id", a.softmax_top1(F.col("v")).alias("t")).select(
        "vec_id", F.col("t.label").cast("long").alias("label"), F.round("t.confidence", 6).alias("confidence")
    )


_MEAN, _STD = [0.0, 0.25, -0.5], [1.0, 0.5, 2.0]  # components in turn count as three channels


@query(
    "channel_normalize",
    f"""
    SELECT vec_id, round(list_sum(n), 5) AS total, round(n[1], 6) AS first, round(n[3], 6) AS third
    FROM (SELECT vec_id, list_transform({_E}, lambda x, i: (x - {_MEAN}[(i - 1) % 3 + 1]) / {_STD}[(i - 1) % 3 + 1]) AS n FROM embeddings)""",
)
def channel_normalize(spark, sf_dir):
    rows = _vectors(spark, sf_dir).select(
        "vec_id", a.channel_normalize(F.col("v"), _MEAN, _STD).alias("n")
    )
    return rows.select(
        "vec_id",
        F.round(a.total(F.col("n")), 5).alias("total"),
        F.round(F.get("n", F.lit(0)), 6).alias("first"),
        F.round(F.get("n", F.lit(2)), 6).alias("third"),
    )


@query(
    "element_dropout",
    f"""
    SELECT vec_id, len(list_filter(d, lambda x: x = 0)) AS n_zero, round(list_sum(d), 6) AS total
    FROM (SELECT vec_id, list_transform({_E}, lambda x, i:
      CASE WHEN {sql_draw("'9:' || vec_id || ':' || (i - 1)")} < 1073741824 THEN 0 ELSE x END) AS d FROM embeddings)""",
)
def element_dropout(spark, sf_dir):
    kept = a.element_dropout(F.col("v"), 0.25, 9, F.col("vec_id"))
    rows = _vectors(spark, sf_dir).select("vec_id", kept.alias("d"))
    return rows.select(
        "vec_id",
        F.size(F.filter("d", lambda x: x == 0)).cast("long").alias("n_zero"),
        F.round(a.total(F.col("d")), 6).alias("total"),
    )


_FOCAL = f"""
(SELECT label, 0.25 * (1 - exp(-ce)) ^ 2 * ce AS loss FROM (SELECT label,
   list_max(v) + ln(list_sum(list_transform(v, lambda x: exp(x - list_max(v))))) - v[label + 1] AS ce
   FROM (SELECT label, {_E} AS v FROM embeddings)))"""


@query(
    "focal_loss",
    f"""
    SELECT label::BIGINT AS label, round(avg(loss), 6) AS mean_loss, round(sum(loss), 4) AS sum_loss, count(*) AS n
    FROM {_FOCAL} GROUP BY label""",
)
def focal_loss(spark, sf_dir):
    loss = lambda how: a.focal_loss(F.col("v"), F.col("label"), 0.25, 2.0, how)
    return _vectors(spark, sf_dir).groupBy(F.col("label").cast("long").alias("label")).agg(
        F.round(loss("mean"), 6).alias("mean_loss"),
        F.round(loss("sum"), 4).alias("sum_loss"),
        F.count(F.lit(1)).alias("n"),
    )
