"""Feature scaling, drift, splits, batches and simple models."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import digest
from ..scale import at_or_before, global_index, rows_at_ranks

# ----------------------------------------------------------------------- scaling


def fit_scaler(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column in one pass; a zero deviation becomes 1."""
    stats = [f(c).alias(f"{n}_{i}") for i, c in enumerate(cols) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = train.agg(*stats).first()
    return {c: (row[f"m_{i}"], row[f"s_{i}"] or 1.0) for i, c in enumerate(cols)}


def apply_scaler(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """Add `<column>_scaled` with the fitted statistics."""
    return df.withColumns(
        {f"{c}_scaled": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()}
    )


def _feature_stats(df: DataFrame, cols: list[str], tag: str) -> DataFrame:
    # one global aggregate (map-side combined), then one row per feature
    wide = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c)["m"].alias("m"), F.col(c)["s"].alias("s")) for c in cols])
    return wide.select(F.explode(rows).alias("r")).select(
        "r.feature", F.col("r.m").alias(f"{tag}_mean"), F.col("r.s").alias(f"{tag}_sd")
    )


def skew_report(train: DataFrame, serve: DataFrame, cols: list[str]) -> DataFrame:
    """Per feature: both statistics and the mean serving value under either scaler.

    `serve_scaled` uses the training statistics; refitting on the serving rows would
    always give 0, and `refit_error` is the difference that hides.
    """
    both = _feature_stats(train, cols, "train").join(_feature_stats(serve, cols, "serve"), "feature")

    def scale(c: str):
        return F.when(F.col(c) == 0, F.lit(1.0)).otherwise(F.col(c))

    served = (F.col("serve_mean") - F.col("train_mean")) / scale("train_sd")
    return both.withColumns(
        {
            "mean_shift": F.col("serve_mean") - F.col("train_mean"),
            "sd_ratio": F.col("serve_sd") / scale("train_sd"),
            "serve_scaled": served,
            "refit_error": F.lit(0.0) - served,
        }
    )


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per column name: place, type and filled values in both versions, and the change."""

    def described(df: DataFrame, tag: str) -> DataFrame:
        filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
        rows = F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("name"),
                    F.lit(i).cast("long").alias(f"{tag}_pos"),
                    F.lit(f.dataType.simpleString()).alias(f"{tag}_type"),
                    F.col(f"`{f.name}`").alias(f"{tag}_filled"),
                )
                for i, f in enumerate(df.schema.fields)
            ]
        )
        return filled.select(F.explode(rows).alias("r")).select("r.*")

    both = described(old, "old").join(described(new, "new"), "name", "full_outer")
    change = (
        F.when(F.col("old_pos").isNull(), "added")
        .when(F.col("new_pos").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
        .when(F.col("old_pos") != F.col("new_pos"), "reordered")
        .otherwise("same")
    )
    return both.withColumn("change", change)


# ------------------------------------------------------------------------ splits


def split_rows(
    df: DataFrame, sizes: dict[str, float], rest: str, seed: int, key: str
) -> DataFrame:
    """Seeded split with exact sizes: int(fraction * n) rows each, the rest to `rest`."""
    n = df.count()
    return _split_at(df, {part: int(share * n) for part, share in sizes.items()}, rest, seed, key)


def holdout_split(df: DataFrame, test_share: float, seed: int, key: str) -> DataFrame:
    """Seeded two-way split: the test part gets test_share * n rows, rounded up."""
    n = df.count()
    return _split_at(df, {"train": n - math.ceil(test_share * n)}, "test", seed, key)


def _split_at(df: DataFrame, counts: dict[str, int], rest: str, seed: int, key: str) -> DataFrame:
    """Rows in the order of the digest of (seed, unique key), cut at exact ranks.

    Only the digests at the cuts are looked up, then every row is assigned by
    comparison, so no row is shuffled.
    """
    hashed = df.withColumn("_h", digest(seed, F.col(key)))
    bucket = F.conv(F.substring("_h", 1, 4), 16, 10).cast("int")
    ranks = list(accumulate(counts.values()))
    cuts = rows_at_ranks(hashed.select("_h", key), bucket, ["_h", key], ranks)
    name = F.lit(rest)
    for part, cut in reversed(list(zip(counts, cuts))):
        name = F.when(at_or_before(["_h", key], cut), part).otherwise(name)
    return hashed.withColumn("split", name).drop("_h")


def batch_rows(
    df: DataFrame, size: int, order: str, items: list[str], seed: int | None = None, **bounds
) -> DataFrame:
    """(batch, n, rows): batches of `size` rows in order, or in a seeded shuffle."""
    keys = [order] if seed is None else [digest(seed, F.col(order)), F.col(order)]
    numbered = global_index(df.select(order, *[i for i in items if i != order]), keys, "_i", **bounds)
    return (
        numbered.groupBy(F.floor(F.col("_i") / size).cast("long").alias("batch"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array_sort(F.collect_list(F.struct("_i", *items))).alias("_l"),
        )
        .select("batch", "n", F.transform("_l", lambda r: F.struct(*[r[i] for i in items])).alias("rows"))
    )


# ------------------------------------------------------------------------ models


def fit_linear(df: DataFrame, features: list[str], target: str) -> dict[str, float]:
    """Least squares by column name: coefficients and `intercept`."""
    if len(features) == 1:
        row = df.agg(
            F.regr_slope(target, features[0]).alias("slope"),
            F.regr_intercept(target, features[0]).alias("intercept"),
        ).first()
        return {features[0]: row["slope"], "intercept": row["intercept"]}
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    ready = VectorAssembler(inputCols=features, outputCol="_x").transform(df)
    model = LinearRegression(featuresCol="_x", labelCol=target, solver="normal").fit(ready)
    return {**dict(zip(features, map(float, model.coefficients))), "intercept": model.intercept}


def predict_linear(df: DataFrame, model: dict[str, float], out: str = "predicted") -> DataFrame:
    value = F.lit(model["intercept"])
    for name, weight in model.items():
        if name != "intercept":
            value = value + F.lit(weight) * F.col(name)
    return df.withColumn(out, value)


def fit_logistic(train: DataFrame, features: list[str], label: str):
    """Scaler and logistic model as one pipeline, fitted on training rows only."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep"),
            StandardScaler(inputCol="_x", outputCol="_z", withMean=True, withStd=True),
            LogisticRegression(featuresCol="_z", labelCol=label, predictionCol="predicted"),
        ]
    ).fit(train)


def predict_logistic(df: DataFrame, model) -> DataFrame:
    return model.transform(df).drop("_x", "_z", "rawPrediction", "probability")
