"""Vector columns (array<double>), evaluated row by row inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import HASH_RANGE, draw


def total(col: Column) -> Column:
    return F.aggregate(col, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def unit(col: Column) -> Column:
    """Unit vector; the zero vector becomes the uniform one."""
    norm = F.sqrt(dot(col, col))
    flat = 1 / F.sqrt(F.size(col).cast("double"))
    return F.transform(col, lambda x: F.when(norm == 0, flat).otherwise(x / norm))


def projection(col: Column, basis: Column) -> Column:
    """Squared overlap of the normalised vector with a basis vector."""
    return F.pow(dot(unit(col), basis), F.lit(2.0))


def log_sum_exp(col: Column) -> Column:
    top = F.array_max(col)
    return top + F.log(total(F.transform(col, lambda x: F.exp(x - top))))


def softmax(col: Column) -> Column:
    top = F.array_max(col)
    scale = total(F.transform(col, lambda x: F.exp(x - top)))
    return F.transform(col, lambda x: F.exp(x - top) / scale)


def softmax_top1(col: Column) -> Column:
    """struct<label, confidence> of the largest score, first one on ties."""
    top = F.array_max(col)
    scale = total(F.transform(col, lambda x: F.exp(x - top)))
    return F.struct(
        (F.array_position(col, top) - 1).alias("label"), (1 / scale).alias("confidence")
    )


def channel_normalize(col: Column, means: list[float], stds: list[float]) -> Column:
    """(x - mean[i]) / std[i]; channels repeat when the vector is longer."""
    mean, std, n = F.array(*map(F.lit, means)), F.array(*map(F.lit, stds)), len(means)
    return F.transform(col, lambda x, i: (x - F.get(mean, i % n)) / F.get(std, i % n))


def element_dropout(col: Column, eps: float, seed: int, row_id: Column) -> Column:
    """Zero each element with probability eps, reproducibly per (seed, row, position)."""
    if not 0.0 <= eps <= 1.0:
        raise ValueError("eps must be in [0, 1]")
    if eps == 0.0:
        return col
    cut = math.floor(eps * HASH_RANGE)
    return F.transform(
        col, lambda x, i: F.when(draw(seed, row_id, i) < F.lit(cut), F.lit(0.0)).otherwise(x)
    )


def focal_loss(
    logits: Column, target: Column, alpha: float, gamma: float, reduction: str = "none"
) -> Column:
    """Loss per row, or the mean or sum of a group as an aggregate."""
    if reduction not in ("none", "mean", "sum"):
        raise ValueError("reduction must be none, mean or sum")
    ce = log_sum_exp(logits) - F.get(logits, target)
    loss = F.lit(alpha) * F.pow(1 - F.exp(-ce), F.lit(gamma)) * ce
    return {"none": loss, "mean": F.avg(loss), "sum": F.sum(loss)}[reduction]
