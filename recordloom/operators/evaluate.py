"""Evaluation metrics, statistics and experiment tables."""

from __future__ import annotations

import math
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import HASH_RANGE, draw
from ..scale import (
    TASK_ROWS,
    global_index,
    materialize,
    running,
    running_blocks,
    running_window,
    split_groups,
)
from .relational import bounded_values

ALPHA = 0.05


# -------------------------------------------------------------- classification


def _cells(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(
    df: DataFrame, y: str, p: str, max_classes: int = 1000, dense: bool = True
) -> DataFrame:
    """(y, p, n) for every pair of classes, zero cells included unless `dense` is off.

    The dense form of many classes would be mostly zeros, so it fails beyond `max_classes`.
    """
    cells = _cells(df, y, p)
    if not dense:
        return cells
    classes = cells.select(F.explode(F.array("y", "p")).alias("c")).distinct()
    names = [r["c"] for r in bounded_values(classes, ["c"], max_classes)]
    every = F.array(*[F.lit(c) for c in names])
    zero = classes.select(F.col("c").alias("y"), F.explode(every).alias("p"), F.lit(0).cast("long").alias("n"))
    return cells.unionAll(zero).groupBy("y", "p").agg(F.sum("n").alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Per class precision, recall, f1 and support, then accuracy, macro and weighted rows."""
    hit = F.col("y") == F.col("p")
    sides = _cells(df, y, p).select(
        F.explode(
            F.array(
                F.struct(
                    F.col("y").cast("string").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(hit, F.col("n")).otherwise(0).alias("tp"),
                ),
                F.struct(
                    F.col("p").cast("string").alias("label"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("tp"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    per_class = sides.groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("support").alias("support")
    )
    scored = per_class.withColumns(
        {
            "precision": _ratio(F.col("tp"), F.col("predicted")),
            "recall": _ratio(F.col("tp"), F.col("support")),
        }
    ).withColumn(
        "f1",
        _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    )
    metrics = ["precision", "recall", "f1"]
    n = F.sum("support")

    def row(label: str, values: list[Column]) -> Column:
        named = [v.alias(c) for c, v in zip(metrics, values)]
        return F.struct(F.lit(label).alias("label"), *named, n.alias("support"))

    overall = _ratio(F.sum("tp"), n)
    weighted = [_ratio(F.sum(F.col(c) * F.col("support")), n) for c in metrics]
    totals = scored.agg(
        F.array(
            row("accuracy", [overall] * 3),
            row("macro avg", [F.avg(c) for c in metrics]),
            row("weighted avg", weighted),
        ).alias("t")
    ).select(F.inline("t"))
    return scored.select("label", *metrics, "support").unionAll(totals)


def accuracy(df: DataFrame, y: str, p: str, keys: list[str] = ()) -> DataFrame:
    """Share of equal labels, per group when keys are given."""
    return df.groupBy(*keys).agg(
        F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n")
    )


def phase_means(df: DataFrame, keys: list[str], loss: str, correct: str) -> DataFrame:
    """Mean loss and accuracy per phase and epoch."""
    return df.groupBy(*keys).agg(
        F.avg(loss).alias("mean_loss"), F.avg(F.col(correct).cast("double")).alias("accuracy")
    )


# ------------------------------------------------------------------ statistics


def auc(df: DataFrame, keys: list[str], x: str, y: str, limit: int = TASK_ROWS) -> DataFrame:
    """Trapezoid area under y over x per group; a single point has none.

    Equal points enclose no area, so they shrink to one before anything is ordered.
    """
    points = materialize(
        df.select(
            *keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
        ).distinct(),
        "points",
    )
    linked = running(points, keys, ["_x", "_y"], {"_before": ("lag", F.struct("_x", "_y"))}, limit)
    area = (F.col("_x") - F.col("_before._x")) * (F.col("_y") + F.col("_before._y")) / 2
    return linked.groupBy(*keys).agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("auc"))


# With no ties and at most so many values in the smaller group, p is exact.
EXACT_VALUES = 8


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


@lru_cache(maxsize=None)
def _part_numerator(a: int) -> tuple[int, list[int]]:
    """(L, N) with 1 / ((1-x)(1-x)(1-x^2)...(1-x^a)) = N(x) / (1-x^L)^(a+1), L = lcm(1..a)."""
    cycle = math.lcm(*range(1, a + 1))
    n = [1] + [0] * ((a + 1) * cycle - 1)
    for i in (1, *range(1, a + 1)):
        for v in range(i, len(n)):
            n[v] += n[v - i]
        for v in range(len(n) - 1, cycle - 1, -1):
            n[v] -= n[v - cycle]
    return cycle, n


def _exact_u_tail(u: float, n_a: int, n_b: int) -> float:
    """P(U >= u) without ties: the orderings with such a U over all orderings.

    By symmetry these are the orderings with U <= m = a * b - ceil(u). Orderings by U are the
    coefficients of the product of (1 - x^(b+i)) / (1 - x^i) over i = 1..a, so their running
    sum takes the terms of the numerator, at most 2^a, times a coefficient of a fixed series,
    which is a sum of a + 1 binomials. Whole numbers all along; the time depends on the
    smaller group alone, which has at most EXACT_VALUES values.
    """
    a, b = min(n_a, n_b), max(n_a, n_b)
    m = a * b - math.ceil(u)
    if m < 0:
        return 0.0
    cycle, numerator = _part_numerator(a)

    def up_to(v: int) -> int:
        return sum(
            numerator[j] * math.comb((v - j) // cycle + a, a)
            for j in range(v % cycle, min(v + 1, len(numerator)), cycle)
        )

    terms = {0: 1}
    for i in range(1, a + 1):
        for v, sign in list(terms.items()):
            if v + b + i <= m:
                terms[v + b + i] = terms.get(v + b + i, 0) - sign
    return min(1.0, sum(sign * up_to(m - v) for v, sign in terms.items()) / math.comb(a + b, a))


def _t_tail(t: float, df: float) -> float:
    """Upper tail of Student's t by the incomplete beta function.

    For many degrees of freedom, where that loses digits, by the normal tail at a
    corrected point; both agree to 1e-9 where they meet.
    """
    if df > 1e6:
        return _normal_tail(t * (1.0 - 1.0 / (4.0 * df)) / math.sqrt(1.0 + t * t / (2.0 * df)))
    x = df / (df + t * t)
    tail = 0.5 * _beta_share(df / 2.0, 0.5, x)
    return tail if t > 0 else 1.0 - tail


def _beta_share(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _beta_share(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny, c, d = 1e-300, 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), 1e-300)
    total = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / ((1.0 + num * d) or tiny)
            c = (1.0 + num / c) or tiny
            total *= c * d
        if abs(c * d - 1.0) < 1e-14:
            break
    return front * total / a


@F.pandas_udf(T.DoubleType())
def _u_p_value(u: pd.Series, z: pd.Series, a: pd.Series, b: pd.Series, ties: pd.Series) -> pd.Series:
    def one(u, z, a, b, ties):
        if a < 1 or b < 1:
            return None
        if ties == 0 and min(a, b) <= EXACT_VALUES:
            return _exact_u_tail(u, int(a), int(b))
        return None if pd.isna(z) else _normal_tail(z)

    return pd.Series([one(*row) for row in zip(u, z, a, b, ties)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(
        [None if pd.isna(x) else _t_tail(x, d) for x, d in zip(t, df)], dtype="float64"
    )


def mann_whitney(
    df: DataFrame, group: str, value: str, a: str, b: str, limit: int = TASK_ROWS
) -> DataFrame:
    """One row: U of group a, z (tie and continuity corrected), p for "a is greater".

    p is exact if no value is tied and one group has at most EXACT_VALUES values, else normal.

    Rows shrink to one per distinct value first; midranks follow from a running count.
    """
    is_a, is_b = F.col(group) == a, F.col(group) == b
    counts = (
        df.filter(is_a | is_b)
        .groupBy(F.col(value).alias("_v"))
        .agg(F.count_if(is_a).alias("_a"), F.count_if(is_b).alias("_b"))
    )
    values = materialize(counts, "values")
    ranked = running(values, [], ["_v"], {"_below": ("sum", F.col("_b"))}, limit)
    t = (F.col("_a") + F.col("_b")).cast("double")
    wins = F.col("_a").cast("double") * (F.col("_below") + F.col("_b") / 2.0)
    sums = ranked.agg(
        F.coalesce(F.sum("_a"), F.lit(0)).alias("n_a"),
        F.coalesce(F.sum("_b"), F.lit(0)).alias("n_b"),
        F.sum(wins).alias("u"),
        F.sum(t * t * t - t).alias("_ties"),
    )
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = na + nb
    variance = na * nb / 12.0 * ((n + 1) - F.try_divide(F.col("_ties"), n * (n - 1)))
    z = F.try_divide(F.col("u") - na * nb / 2.0 - 0.5, F.sqrt(variance))
    return (
        sums.withColumn("z", z)
        .withColumn("p_value", _u_p_value("u", "z", "n_a", "n_b", "_ties"))
        .drop("_ties")
    )


def t_test_ind(df: DataFrame, group: str, value: str, a: str, b: str) -> DataFrame:
    """One row: pooled-variance t of a over b, degrees of freedom, one-sided p."""

    def of(name: str, fn) -> Column:
        return fn(F.when(F.col(group) == name, F.col(value)))

    stats = df.filter(F.col(group).isin(a, b)).agg(
        of(a, F.count).alias("n_a"),
        of(b, F.count).alias("n_b"),
        of(a, F.avg).alias("_ma"),
        of(b, F.avg).alias("_mb"),
        of(a, F.var_samp).alias("_va"),
        of(b, F.var_samp).alias("_vb"),
    )
    df_ = F.col("n_a") + F.col("n_b") - 2
    pooled = ((F.col("n_a") - 1) * F.col("_va") + (F.col("n_b") - 1) * F.col("_vb")) / df_
    spread = F.sqrt(pooled * (1.0 / F.col("n_a") + 1.0 / F.col("n_b")))
    return (
        stats.withColumn("t", F.try_divide(F.col("_ma") - F.col("_mb"), spread))
        .withColumn("df", df_)
        .withColumn("p_value", _t_p_value("t", "df"))
        .drop("_ma", "_mb", "_va", "_vb")
    )


def significance_flag(df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Add `reject`: the p value lies below alpha."""
    return df.withColumn("reject", F.col("p_value") < F.lit(alpha))


def group_curve(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Mean and sample deviation of y per group and x."""
    return df.groupBy(group, x).agg(
        F.avg(y).alias("mean"), F.stddev_samp(y).alias("sd"), F.count(F.lit(1)).alias("n")
    )


# ----------------------------------------------------------------- experiments


def experiment_grid(
    configs: DataFrame, key: str, seeds: list[int], score: Column | None = None, **bounds
) -> DataFrame:
    """Every config under every seed, numbered seed by seed, with a seeded score."""
    indexed = global_index(configs, [key], "_pos", **bounds)
    n = indexed.count()
    grid = indexed.select("*", F.posexplode(F.array(*[F.lit(s) for s in seeds])).alias("_s", "seed"))
    value = score if score is not None else draw(F.col("seed"), F.col(key)) / F.lit(float(HASH_RANGE))
    run_no = (F.col("_s") * F.lit(n) + F.col("_pos") + 1).cast("long")
    return grid.withColumns({"run_no": run_no, "score": value}).drop("_pos", "_s")


def with_criterion(df: DataFrame, n_params: Column, score: Column) -> DataFrame:
    """Add `criterion`: parameters * ln(100) - 2 ln(1 / score)."""
    return df.withColumn(
        "criterion", n_params * F.log(F.lit(100.0)) - 2 * F.log(1 / score)
    )


def select_champion(df: DataFrame, key: str, n_params: Column, score: Column) -> DataFrame:
    """The row with the smallest criterion."""
    return with_criterion(df, n_params, score).orderBy("criterion", key).limit(1)


def best_checkpoint(
    df: DataFrame,
    run: str,
    step: str,
    metric: str,
    mode: str | None = None,
    patience: int = 3,
    limit: int = TASK_ROWS,
) -> DataFrame:
    """Per run: best step and metric until training stops, and the stop step if any.

    Better means strictly better than everything before; mode defaults to min for
    metrics named like a loss. Training stops at the first step with `patience` steps
    in a row that are not better.
    """
    mode = mode or ("min" if "loss" in metric else "max")
    rows = df.select(run, F.col(step).alias("_step"), F.col(metric).alias("_m"))
    short, long = split_groups(rows, [run], limit)
    seen = _tracked(short, run, mode, running_window)
    if long is not None:
        seen = seen.unionByName(_tracked(long, run, mode, running_blocks, materialize))
    late = F.col("_since") >= patience
    stop_pos = F.when(late, F.col("_pos"))
    return seen.groupBy(run).agg(
        F.coalesce(F.min_by("_at", stop_pos), F.max_by("_at", "_pos")).alias("best_step"),
        F.coalesce(F.min_by("_top", stop_pos), F.max_by("_top", "_pos")).alias("best_metric"),
        F.min(F.when(late, F.col("_step"))).alias("stop_step"),
    )


def _tracked(rows: DataFrame, run: str, mode: str, runner, between=lambda df: df) -> DataFrame:
    """Per row: position, best step and metric so far, steps since the last gain."""
    one = runner(
        rows, [run], ["_step"], {"_best": (mode, F.col("_m")), "_pos": ("sum", F.lit(1))}
    )
    gain = F.col("_m") > F.col("_best") if mode == "max" else F.col("_m") < F.col("_best")
    better = F.col("_best").isNull() | gain
    marked = between(
        one.withColumns(
            {
                "_hit": F.when(better, F.col("_pos")),
                "_hit_step": F.when(better, F.col("_step")),
            }
        )
    )
    two = runner(
        marked,
        [run],
        ["_step"],
        {"_hit0": ("max", F.col("_hit")), "_step0": ("max", F.col("_hit_step"))},
    )
    top = F.greatest if mode == "max" else F.least
    return two.select(
        run,
        "_step",
        "_pos",
        (F.col("_pos") - F.greatest("_hit0", "_hit")).alias("_since"),
        F.greatest("_step0", "_hit_step").alias("_at"),
        top("_best", "_m").alias("_top"),
    )
