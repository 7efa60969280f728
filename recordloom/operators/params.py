"""Parameter binding: uniform draws and full option grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import draw
from ..functions.template import VALUE
from ..scale import global_index, pin, unbroadcast

GRID_CHUNK = 65_536


def draw_patterns(
    attempts: DataFrame, catalog: DataFrame, seed: int, key: str, attempt: str = "attempt"
) -> DataFrame:
    """One uniform draw with replacement per attempt, joined on the pattern's position.

    Positions follow the unique `key`; an empty catalog yields no rows. Up to BROADCAST_ROWS
    patterns, which side is broadcast is left to the planner's size threshold.
    """
    indexed = global_index(catalog, [key], "pattern_pos")
    size = indexed.count()
    return with_draw(attempts, size, seed, attempt).join(unbroadcast(indexed, size), "pattern_pos")


def with_draw(attempts: DataFrame, size: int, seed: int, attempt: str = "attempt") -> DataFrame:
    """Add `pattern_pos`, uniform in [0, size)."""
    return pin(attempts, {"pattern_pos": draw(seed, F.col(attempt)) % max(size, 1)})


def _bool_value(flag: bool) -> Column:
    return F.struct(
        F.lit(str(flag)).alias("v"),
        F.lit("bool").alias("k"),
        F.lit(None).cast("array<string>").alias("items"),
    )


def option_list(param: Column, include_bools: bool = False) -> Column:
    """Values a parameter may take: its options if a choice, else only the default."""
    only_default = F.array(param["default"])
    listed = (param["type"] == "choice") & (F.size(param["options"]) > 0)
    options = F.when(listed, param["options"])
    if include_bools:
        both = F.array(_bool_value(True), _bool_value(False)).cast(f"array<{VALUE}>")
        options = options.when(param["type"] == "bool", both)
    return options.otherwise(only_default)


def option_entries(params: Column, include_bools: bool = False) -> Column:
    """array<struct<name, options>> in declared order."""
    return F.transform(
        F.map_entries(params),
        lambda e: F.struct(
            e["key"].alias("name"), option_list(e["value"], include_bools).alias("options")
        ),
    )


def _pick(options: Column, *key) -> Column:
    """Uniform option number; nothing to draw when there is only one."""
    n = F.size(options)
    return F.when(n == 1, 0).otherwise((draw(*key) % n).cast("int"))


def drawn_choice(entries: Column, seed: int, attempt: Column, pattern_id: Column) -> Column:
    """Chosen option number per parameter."""
    return F.transform(
        entries, lambda e: _pick(e["options"], seed, attempt, pattern_id, e["name"])
    )


def context_of(entries: Column, choice: Column) -> Column:
    """map<name, value> for one option number per parameter."""
    return F.map_from_entries(
        F.zip_with(entries, choice, lambda e, c: F.struct(e["name"], F.get(e["options"], c)))
    )


def default_context(params: Column) -> Column:
    return F.transform_values(params, lambda _, p: p["default"])


def bind_params(
    df: DataFrame, seed: int, attempt: str = "attempt", include_bools: bool = False
) -> DataFrame:
    """Add `ctx`: choices drawn uniformly, every other type keeps its default."""
    pattern, tries = F.col("pattern_id"), F.col(attempt)

    def bound(e: Column) -> Column:
        options = F.array(option_list(e["value"], include_bools))
        chosen = F.transform(
            options, lambda o: F.get(o, _pick(o, seed, tries, pattern, e["key"]))
        )
        return F.struct(e["key"], F.get(chosen, F.lit(0)))

    ctx = F.map_from_entries(F.transform(F.map_entries("parameters"), bound))
    return pin(df, {"ctx": ctx})


def expand_grid(df: DataFrame, include_bools: bool = False) -> DataFrame:
    """All option combinations of every row as `grid_no` and `ctx`, last one fastest.

    Combination numbers are decoded in mixed radix, so there is no join. Large
    grids are cut into chunks that spread over tasks before they are expanded.
    """
    sized = pin(df, {"_entries": option_entries(F.col("parameters"), include_bools)})
    sizes = F.transform("_entries", lambda e: F.size(e["options"]).cast("long"))
    one = F.lit(1).cast("long")

    def product(col: Column) -> Column:
        return F.aggregate(col, one, lambda acc, x: acc * x)

    n = F.size("_sizes")
    strides = F.transform(
        F.col("_sizes"), lambda _, i: product(F.slice(F.col("_sizes"), i + 2, n))
    )
    sized = sized.withColumn("_sizes", sizes).withColumns(
        {"_total": product(F.col("_sizes")), "_strides": strides}
    )
    chunk = F.lit(GRID_CHUNK).cast("long")
    chunks = sized.withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_total") - 1, chunk))
    ).repartition("pattern_id", "_from")
    last = F.least(F.col("_from") + chunk, F.col("_total")) - 1
    numbered = chunks.withColumn("grid_no", F.explode(F.sequence(F.col("_from"), last)))
    digits = F.zip_with(
        "_sizes",
        "_strides",
        lambda size, stride: (F.floor(F.col("grid_no") / stride).cast("long") % size).cast("int"),
    )
    return pin(numbered, {"ctx": context_of(F.col("_entries"), digits)}).drop(
        "_entries", "_sizes", "_total", "_strides", "_from"
    )
