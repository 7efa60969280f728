"""Building blocks that keep order-sensitive operators distributed.

A window with no partition key, or with one hot key, runs in one task. The
helpers here first measure (group sizes, row counts). Small inputs take the
plain window; beyond the bound the rows are range-partitioned on the full order
key, written once to the shared folder, and every block then needs only a carry
from the blocks before it (at most one row per block and key).
"""

from __future__ import annotations

import tempfile
import uuid
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows of one group that one task may order on its own: above this, block by block.
TASK_ROWS = 1_000_000
# Rows of a whole table that one task may number; what follows runs in that task too.
INDEX_ROWS = 10_000
# Buckets of the histograms that locate exact ranks; bounds what is collected.
RANK_BUCKETS = 65_536
# Rows a side may have to be broadcast or collected.
BROADCAST_ROWS = 100_000

_LOW_BITS = (1 << 33) - 1


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="recordloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below this application's own folder, to be deleted with it."""
    run = f"recordloom-{spark.sparkContext.applicationId}"
    return f"{shared_dir(spark)}/{run}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write once to the shared folder and read back: lineage ends, columns stay prunable."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan with fewer splits than cores out to all cores.

    For costly work per row on small or unsplittable files; a scan that already has
    enough splits is returned unchanged, so large inputs are never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def pin(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated once per row, however often they are used later.

    The one-element generator keeps the optimizer from inlining a costly expression
    into every place (filters above all) that refers to it.
    """
    made = F.struct(*[col.alias(name) for name, col in columns.items()])
    kept = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(made)))


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows of the biggest group; reads only the key columns, combined map-side."""
    if not keys:
        return df.select(F.lit(1)).count()
    top = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return top or 0


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def unbroadcast(df: DataFrame, rows: int) -> DataFrame:
    """`df` for the side of a join, joined by shuffle if it may have too many `rows` to be broadcast.

    Spark's size threshold goes by compressed files, where a million short rows look small; the
    driver would hold them all, many times larger.
    """
    return df.hint("merge") if rows > BROADCAST_ROWS else df


def range_blocks(df: DataFrame, order: list, blocks: int | None = None) -> DataFrame:
    """Rows split into ordered blocks: `_blk` grows with the order, `_idx` counts inside it."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = blocks or max(least, -(-df.count() // TASK_ROWS))  # a block holds about TASK_ROWS at most
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias("_blk"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS)).alias("_idx"),
        )
    )
    return materialize(ranged, "blocks")


def global_index(
    df: DataFrame,
    order: list,
    name: str = "idx",
    start: int = 0,
    limit: int = INDEX_ROWS,
    blocks: int | None = None,
) -> DataFrame:
    """Dense 0-based (plus `start`) position of every row under a unique order."""
    if is_small(df, limit):
        position = F.row_number().over(Window.orderBy(*order)).cast("long")
        return df.withColumn(name, position + F.lit(start - 1))
    rows = range_blocks(df, order, blocks)
    sizes = rows.groupBy("_blk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per block, so the broadcast is bounded by the partition count
    return (
        rows.join(F.broadcast(offsets), "_blk")
        .withColumn(name, F.col("_idx") + F.col("_off") + F.lit(start))
        .drop("_blk", "_idx", "_off")
    )


def split_groups(
    df: DataFrame, keys: list[str], limit: int
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups with at most `limit` rows, rows of larger groups or None)."""
    if largest_group(df, keys) <= limit:
        return df, None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    named = [F.col(k).alias(f"_large_{k}") for k in keys]
    large = materialize(counts.filter(F.col("_n") > limit).select(*named), "large-keys")
    if is_small(large):
        large = F.broadcast(large)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_large_{k}"))
    return df.join(large, same, "left_anti"), df.join(large, same, "left_semi")


def running(
    df: DataFrame,
    keys: list[str],
    order: list,
    aggs: dict[str, tuple[str, Column]],
    limit: int = TASK_ROWS,
    blocks: int | None = None,
) -> DataFrame:
    """Aggregates over the EARLIER rows of each group, exact for groups of any size.

    `aggs` maps an output name to (kind, column); kind is sum, max, min or lag
    (the previous row's value; pass a struct when the value itself may be null).
    Sums start at 0, the others at null. The order must be unique in a group. Groups
    of up to `limit` rows take a plain window, only larger ones the block path.
    """
    if not keys:
        if is_small(df, limit):
            return running_window(df, keys, order, aggs)
        return running_blocks(df, keys, order, aggs, blocks)
    small, large = split_groups(df, keys, limit)
    done = running_window(small, keys, order, aggs)
    if large is None:
        return done
    return done.unionByName(running_blocks(large, keys, order, aggs, blocks))


def running_window(df: DataFrame, keys: list[str], order: list, aggs: dict) -> DataFrame:
    """`running` for groups that each fit one task."""
    ordered = Window.partitionBy(*keys).orderBy(*order)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns(
        {name: _running_kind(kind, col, ordered, earlier) for name, (kind, col) in aggs.items()}
    )


def running_blocks(
    df: DataFrame, keys: list[str], order: list, aggs: dict, blocks: int | None = None
) -> DataFrame:
    """`running` for groups too large for one task: block-local windows plus carries."""
    inputs = {f"_in_{name}": col for name, (_, col) in aggs.items()}
    rows = range_blocks(df.withColumns(inputs), [*keys, *order], blocks)
    in_block = Window.partitionBy("_blk", *keys).orderBy("_idx")
    in_block_earlier = in_block.rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy("_blk")
    across_earlier = across.rowsBetween(Window.unboundedPreceding, -1)

    totals, carries, local, merged = [], {}, {}, {}
    for name, (kind, _) in aggs.items():
        col = F.col(f"_in_{name}")
        total = F.max_by(col, "_idx") if kind == "lag" else getattr(F, kind)(col)
        totals.append(total.alias(f"_tot_{name}"))
        carries[f"_carry_{name}"] = _running_kind(
            kind, F.col(f"_tot_{name}"), across, across_earlier
        )
        local[name] = _running_kind(kind, col, in_block, in_block_earlier)
        here, carried = F.col(name), F.col(f"_carry_{name}")
        merged[name] = {
            "sum": here + carried,
            "max": F.greatest(here, carried),
            "min": F.least(here, carried),
            "lag": F.coalesce(here, carried),
        }[kind]

    carry = (
        rows.groupBy("_blk", *keys)
        .agg(*totals)
        .withColumns(carries)
        .drop(*[f"_tot_{name}" for name in aggs])
    )
    carry = carry.withColumnsRenamed({k: f"_key_{k}" for k in ["_blk", *keys]})
    if not keys:
        carry = F.broadcast(carry)  # one row per block
    same = F.lit(True)
    for k in ["_blk", *keys]:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return (
        rows.withColumns(local)
        .join(carry, same)
        .withColumns(merged)
        .drop("_blk", "_idx", *inputs, *carries, *[f"_key_{k}" for k in ["_blk", *keys]])
    )


def _running_kind(kind: str, col: Column, ordered, earlier) -> Column:
    if kind == "lag":
        return F.lag(col).over(ordered)
    if kind == "sum":
        return F.coalesce(F.sum(col).over(earlier), F.lit(0))
    return getattr(F, kind)(col).over(earlier)


def rows_at_ranks(
    df: DataFrame, bucket: Column, order: list[str], ranks: list[int]
) -> list[tuple | None]:
    """Order keys of the rows at the given 1-based ranks, without sorting the table.

    `bucket` must grow with the order and take at most RANK_BUCKETS values. A
    histogram locates each rank's bucket; only that bucket is then ordered.
    """
    keyed = df.select(bucket.alias("_b"), *order)
    hist = sorted(keyed.groupBy("_b").count().limit(RANK_BUCKETS + 1).collect())
    if len(hist) > RANK_BUCKETS:
        raise ValueError(f"more than {RANK_BUCKETS} rank buckets")
    ends = list(accumulate(n for _, n in hist))
    wanted = {}  # rank -> (bucket, position inside it)
    for rank in ranks:
        if 1 <= rank <= (ends[-1] if ends else 0):
            at = bisect_left(ends, rank)
            wanted[rank] = (hist[at][0], rank - (ends[at] - hist[at][1]))
    if not wanted:
        return [None] * len(ranks)
    # all wanted buckets in one pass; each holds about 1 / RANK_BUCKETS of the rows
    inside = keyed.filter(F.col("_b").isin(sorted({b for b, _ in wanted.values()})))
    placed = inside.withColumn("_rn", F.row_number().over(Window.partitionBy("_b").orderBy(*order)))
    hit = F.lit(False)
    for bucket_no, place in set(wanted.values()):
        hit = hit | ((F.col("_b") == bucket_no) & (F.col("_rn") == place))
    rows = {(r["_b"], r["_rn"]): tuple(r[c] for c in order) for r in placed.filter(hit).collect()}
    return [rows[wanted[rank]] if rank in wanted else None for rank in ranks]


def at_or_before(order: list[str], key: tuple | None) -> Column:
    """True for rows whose order key is <= `key`; false everywhere when there is none."""
    if key is None:
        return F.lit(False)
    result = F.lit(True)
    for name, value in reversed(list(zip(order, key))):
        result = (F.col(name) < F.lit(value)) | ((F.col(name) == F.lit(value)) & result)
    return result
