"""Scalar, map and array column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(a: Column, b: Column) -> Column:
    """Null on a zero divisor or an operand that is not a number."""
    return F.try_divide(a.try_cast("double"), b.try_cast("double"))


def bucketize(col: Column, cuts: list[tuple[float, str]], default: str) -> Column:
    """First label whose lower bound the value reaches; cuts go from high to low."""
    chain = None
    for bound, label in cuts:
        chain = F.when(col >= bound, label) if chain is None else chain.when(col >= bound, label)
    return chain.otherwise(default)


def op_dispatch(a: Column, b: Column, op: Column, as_float: bool = False) -> tuple[Column, Column]:
    """(result, error): add, subtract or multiply by name; other names are errors."""
    result = F.when(op == "add", a + b).when(op == "subtract", a - b).when(op == "multiply", a * b)
    error = F.when(
        ~F.coalesce(op.isin("add", "subtract", "multiply"), F.lit(False)),
        F.concat(F.lit("unknown operation: "), F.coalesce(op, F.lit("null"))),
    )
    return (result.cast("double") if as_float else result), error


def op_dispatch_strict(a: Column, b: Column, op: Column) -> Column:
    result, error = op_dispatch(a, b, op)
    return F.when(error.isNull(), result).otherwise(F.raise_error(error))


def map_get(col: Column, key: str, default=None) -> Column:
    """Value or default; a missing key is null without a default."""
    found = F.try_element_at(col, F.lit(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def map_set_default(col: Column, key: str, value) -> Column:
    added = F.map_concat(F.map_filter(col, lambda k, _: k != key), F.create_map(F.lit(key), F.lit(value)))
    return F.when(F.map_contains_key(col, key), col).otherwise(added)


def array_parts(col: Column) -> tuple[Column, Column, Column]:
    """(first, last, items 2 to 4)."""
    return F.try_element_at(col, F.lit(1)), F.try_element_at(col, F.lit(-1)), F.slice(col, 3, 3)


def is_integer(col: Column) -> Column:
    return F.coalesce(col.rlike(r"^\s*[+-]?\d+\s*$"), F.lit(False))
