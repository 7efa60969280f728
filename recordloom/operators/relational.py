"""Row, grouping, membership, coercion and ledger operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.values import is_integer
from ..scale import (
    TASK_ROWS,
    global_index,
    materialize,
    pin,
    running_blocks,
    split_groups,
)

# A key with more than this share of the rows is handled apart from the others.
HOT_SHARE = 0.001


def filter_map(df: DataFrame, keep: Column, value: Column, out: str) -> DataFrame:
    """Keep matching rows and add a mapped value; equal values stay."""
    return df.filter(keep).withColumn(out, value)


def build_map(df: DataFrame, key: Column, value: Column, order: Column) -> DataFrame:
    """(key, value) with the last value by `order` for equal keys."""
    return df.groupBy(key.alias("key")).agg(F.max_by(value, order).alias("value"))


def distinct_map(df: DataFrame, value: Column, out: str) -> DataFrame:
    return df.select(value.alias(out)).distinct()


def group_lists(
    df: DataFrame, key: str, value: str, order: str, max_items: int = TASK_ROWS
) -> DataFrame:
    """(key, part, items) in input order; groups beyond `max_items` come in several parts."""
    rows = df.select(key, F.col(order).alias("_o"), F.col(value).alias("_v"))
    small, large = split_groups(rows, [key], max_items)
    parts = small.withColumn("part", F.lit(0).cast("long"))
    if large is not None:
        placed = running_blocks(large, [key], ["_o"], {"_pos": ("sum", F.lit(1))})
        part = F.floor(F.col("_pos") / max_items).cast("long")
        parts = parts.unionAll(placed.select(key, "_o", "_v", part.alias("part")))
    lists = parts.groupBy(key, "part").agg(F.array_sort(F.collect_list(F.struct("_o", "_v"))).alias("_l"))
    return lists.select(key, "part", F.transform("_l", lambda x: x["_v"]).alias("items"))


def most_common(df: DataFrame, col: str, k: int, order: str) -> DataFrame:
    """Top-k values by count, ties by first appearance."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_at"))
    return counts.orderBy(F.desc("n"), "first_at", col).limit(k)


def bounded_values(df: DataFrame, cols: list[str], limit: int = 1000) -> list:
    """Rows of a small table; more than `limit` is an error, never a cut."""
    rows = df.select(*cols).orderBy(*cols).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows")
    return rows


def cartesian(df: DataFrame, options: dict[str, list]) -> DataFrame:
    """Every row with every combination of the given option lists (no join)."""
    out = df
    for name, values in options.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def array_pairs(df: DataFrame, col: str, max_items: int = 64) -> DataFrame:
    """Unordered pairs of a row's short option list, in list order; longer lists fail."""
    n = F.size(col)
    checked = F.when(n <= max_items, F.col(col)).otherwise(
        F.raise_error(F.lit(f"option lists hold at most {max_items} items"))
    )
    rows = df.withColumn("_items", checked).select("*", F.posexplode("_items").alias("_i", "first"))
    rest = F.slice("_items", F.col("_i") + 2, F.size("_items"))
    return rows.withColumn("second", F.explode(rest)).drop("_items", "_i")


def _hot_keys(df: DataFrame, key: str) -> DataFrame | None:
    """Keys with more than HOT_SHARE of the rows (so at most 1 / HOT_SHARE), or None."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.filter(F.col("_n") > F.lit(total * HOT_SHARE)).select(key)
    return None if hot.isEmpty() else hot


def _with_membership(df: DataFrame, key: str, members: DataFrame, member_key: str, how: str):
    """Semi or anti join: members reduced to distinct keys, hot probe keys never shuffled."""
    known = members.select(F.col(member_key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    probes = df.filter(F.col(key).isNotNull())
    hot = _hot_keys(probes, key)
    if hot is None:
        return probes.join(known, key, how).select(df.columns)
    settled = F.broadcast(hot.join(known, key, how))
    rare = probes.join(F.broadcast(hot), key, "left_anti")
    kept = probes.join(settled, key, "left_semi")
    return kept.unionAll(rare.join(known, key, how)).select(df.columns)


def membership(df: DataFrame, key: str, members: DataFrame, member_key: str) -> DataFrame:
    """Rows whose key occurs among the members."""
    return _with_membership(df, key, members, member_key, "left_semi")


def non_membership(df: DataFrame, key: str, members: DataFrame, member_key: str) -> DataFrame:
    """Rows whose key does not occur among the members; null keys never do."""
    without = df.filter(F.col(key).isNull())
    return without.unionAll(_with_membership(df, key, members, member_key, "left_anti"))


def membership_counts(df: DataFrame, key: str, members: DataFrame, member_key: str) -> DataFrame:
    """(n_in, n_out); both sides shrink to one row per key before they meet."""
    probes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = members.select(F.col(member_key).alias(key)).distinct().withColumn("_in", F.lit(True))
    return probes.join(known, key, "left").agg(
        F.coalesce(F.sum(F.when(F.col("_in"), F.col("_n"))), F.lit(0)).alias("n_in"),
        F.coalesce(F.sum(F.when(F.col("_in").isNull(), F.col("_n"))), F.lit(0)).alias("n_out"),
    )


def update_where(df: DataFrame, cond: Column, col: str, value: Column) -> DataFrame:
    """Set a column on matching rows, leave the others unchanged."""
    return df.withColumn(col, F.when(cond, value).otherwise(F.col(col)))


def with_total(df: DataFrame, price: str, quantity: str, out: str = "total_value") -> DataFrame:
    return df.withColumn(out, F.col(price) * F.col(quantity))


def enumerate_rows(df: DataFrame, order: list, item: str, **bounds) -> DataFrame:
    """0-based `index` and a line that shows index and item."""
    numbered = global_index(df, order, "index", **bounds)
    line = F.format_string("Index: %d, Item: '%s'", "index", item)
    return numbered.withColumn("line", line)


def sort_rows(df: DataFrame, *order) -> DataFrame:
    """Total order by range partitioning; large sorts spill."""
    return df.orderBy(*order)


def sum_squares(df: DataFrame, value: Column) -> DataFrame:
    """Exact sum of squared integers (38 digits)."""
    square = value.cast("decimal(19,0)") * value.cast("decimal(19,0)")
    return df.agg(F.sum(square).alias("sum_squares"))


def sum_squares_range(spark: SparkSession, n: int) -> DataFrame:
    return sum_squares(spark.range(n), F.col("id"))


# -------------------------------------------------------------------- coercion


def coerce(
    df: DataFrame, json_col: str, fields: dict[str, str], rules: dict[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Typed fields of a JSON column: (good rows, bad rows with `reason`).

    `fields` maps names to int, double, string or array<string>; `rules` maps a reason
    to a condition over the typed fields that must hold.
    """
    raw = F.from_json(F.col(json_col), "map<string,string>")
    text = {name: F.try_element_at(F.col("_raw"), F.lit(name)) for name in fields}

    def typed(name: str, kind: str) -> Column:
        if kind == "int":
            return F.when(is_integer(text[name]), F.trim(text[name]).try_cast("bigint"))
        if kind.startswith("array"):
            return F.from_json(text[name], kind)
        return text[name].try_cast(kind)

    values = {name: typed(name, kind) for name, kind in fields.items()}
    problems = [F.when(F.col("_raw").isNull(), F.lit("not a JSON object"))]
    for name in fields:
        problems.append(F.when(text[name].isNull(), F.lit(f"{name} is missing")))
        problems.append(F.when(F.col(name).isNull(), F.lit(f"{name} has the wrong type")))
    for reason, cond in (rules or {}).items():
        problems.append(F.when(~F.coalesce(cond, F.lit(False)), F.lit(reason)))
    parsed = pin(pin(df, {"_raw": raw}), values)
    judged = pin(parsed, {"reason": F.coalesce(*problems)})
    good = judged.filter(F.col("reason").isNull()).drop("_raw", "reason")
    bad = judged.filter(F.col("reason").isNotNull()).drop("_raw", *fields)
    return good, bad


def sum_numbers(df: DataFrame, col: str) -> DataFrame:
    """Sum of the texts that are numbers, and how many were skipped."""
    number = F.col(col).try_cast("double")
    return df.agg(F.sum(number).alias("total"), F.count_if(number.isNull()).alias("n_skipped"))


# ---------------------------------------------------------------------- ledger


def _fold(items: Column, entry: Column) -> Column:
    """Replay movements: deposits add, withdrawals need funds, others are rejected."""
    start = F.struct(
        entry.cast("double").alias("balance"),
        F.lit(0).cast("long").alias("n_accepted"),
        F.lit(0).cast("long").alias("n_rejected"),
    )

    def step(acc: Column, move: Column) -> Column:
        signed = F.when(move["kind"] == "deposit", move["amount"]).when(
            (move["kind"] == "withdraw") & (move["amount"] <= acc["balance"]), -move["amount"]
        )
        applied = F.when(move["amount"] > 0, signed)
        ok = applied.isNotNull()
        return F.struct(
            (acc["balance"] + F.coalesce(applied, F.lit(0.0))).alias("balance"),
            (acc["n_accepted"] + ok.cast("long")).alias("n_accepted"),
            (acc["n_rejected"] + (~ok).cast("long")).alias("n_rejected"),
        )

    return F.aggregate(items, start, step)


def ledger(
    df: DataFrame, key: str, order: str, amount: str, kind: str, block: int = TASK_ROWS
) -> DataFrame:
    """Balance and accepted/rejected counts per key after an ordered replay.

    Keys with at most `block` movements are folded at once. Longer histories are cut
    into blocks that are replayed in parallel from a guessed opening balance; blocks
    whose opening balance turns out different are replayed until none changes. The
    first block is right from the start, so the rounds end with the sequential result.
    """
    moves = df.select(
        key,
        F.col(order).alias("_o"),
        F.col(amount).cast("double").alias("amount"),
        F.col(kind).alias("kind"),
    )
    listed = F.array_sort(F.collect_list(F.struct("_o", "amount", "kind"))).alias("_moves")
    small, large = split_groups(moves, [key], block)
    done = (
        small.groupBy(key)
        .agg(listed)
        .select(key, _fold(F.col("_moves"), F.lit(0.0)).alias("_r"))
        .select(key, "_r.*")
    )
    return done if large is None else done.unionAll(_ledger_blocks(large, key, listed, block))


def _ledger_blocks(moves: DataFrame, key: str, listed: Column, block: int) -> DataFrame:
    placed = running_blocks(moves, [key], ["_o"], {"_pos": ("sum", F.lit(1))})
    blocks = materialize(
        placed.groupBy(key, F.floor(F.col("_pos") / block).cast("long").alias("_blk")).agg(listed),
        "ledger",
    )
    state = materialize(
        blocks.withColumn("_entry", F.lit(0.0)).select(
            key, "_blk", "_entry", _fold(F.col("_moves"), F.col("_entry")).alias("_r")
        ),
        "ledger",
    )
    chain = Window.partitionBy(key).orderBy("_blk")
    while True:
        opening = F.coalesce(F.lag("_r.balance").over(chain), F.lit(0.0))
        linked = state.withColumn("_open", opening)
        stale = linked.filter(F.col("_open") != F.col("_entry")).select(
            key, "_blk", F.col("_open").alias("_entry")
        )
        if stale.isEmpty():
            break
        redone = blocks.join(stale, [key, "_blk"]).select(
            key, "_blk", "_entry", _fold(F.col("_moves"), F.col("_entry")).alias("_r")
        )
        kept = state.join(stale.select(key, "_blk"), [key, "_blk"], "left_anti")
        state = materialize(kept.select(redone.columns).unionAll(redone), "ledger")
    return state.groupBy(key).agg(
        F.max_by("_r.balance", "_blk").alias("balance"),
        F.sum("_r.n_accepted").alias("n_accepted"),
        F.sum("_r.n_rejected").alias("n_rejected"),
    )
