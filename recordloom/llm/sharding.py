"""Contiguous shards whose largest one is as small as possible.

Rows with equal text form one atomic group. Groups are ordered by a hash of the text,
and the smallest capacity is searched with which cutting greedily yields at most the
wanted number of shards. The search runs on sums of hash ranges; only the ranges in
which a cut can fall are looked at more closely, until every cut is exact.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scale import materialize

KEY_BITS = 63
# The first look has 2**12 ranges; each closer look splits a range into 2**6.
FIRST_BITS, STEP_BITS = 12, 6
# Rows of one shard that one task numbers.
SLOT_ROWS = 50_000


@dataclass(frozen=True)
class Cell:
    """Groups whose key starts at `low` and agrees above `shift` bits."""

    low: int
    shift: int
    size: int
    groups: int
    largest: int


def shard_rows(
    docs: DataFrame,
    shards: int = 40,
    overhead: int = 16,
    doc: str = "doc_id",
    text: str = "text",
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per input row.

    `size` is the UTF-8 length of the text plus `overhead`. A group of at least the mean
    of what is left gets a shard of its own, first of all; the others share the remaining
    shards, contiguous in hash order, with the smallest possible largest size. `slot`
    counts from 0 within the shard. Null text counts as empty text. Rows that repeat are
    placed one by one; a null doc_id is carried along. An empty table gives no rows; other
    columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = materialize(
        docs.select(
            F.col(doc).alias("doc_id"),
            (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(body).cast("long").alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(body), 64 - KEY_BITS).alias("key"),
        ),
        "shard-rows",
    )
    groups = materialize(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    alone, cuts, _ = plan_cuts(groups, shards)
    placed = rows.withColumn("shard", _shard_of(F.col("key"), alone, cuts))
    return _with_slots(placed, shards, slot_rows).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def plan_cuts(groups: DataFrame, shards: int) -> tuple[list[int], list[int], int]:
    """(keys of groups with a shard of their own, first keys of later shards, capacity)."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    largest = groups.orderBy(F.desc("bytes"), "key").limit(shards).collect()  # at most `shards` rows
    alone: list[int] = []
    left = total
    for row in largest:
        if shards - len(alone) < 2 or row["bytes"] * (shards - len(alone)) < left:
            break
        alone.append(row["key"])
        left -= row["bytes"]
    rest = groups.filter(~F.col("key").isin(alone)) if alone else groups
    if not left:
        return alone, [], 0
    cells = _cells(rest, KEY_BITS - FIRST_BITS, None)
    while True:
        low, high = _bounds(cells, shards - len(alone))
        unsure = _unsure(cells, shards - len(alone), low, high)
        if not unsure:
            return alone, [cells[i].low for i in _cut_cells(cells, shards - len(alone), low)], low
        closer = []
        for shift in {cells[i].shift for i in unsure}:
            inside = [cells[i] for i in unsure if cells[i].shift == shift]
            closer += _cells(rest, max(0, shift - STEP_BITS), inside)
        kept = [c for i, c in enumerate(cells) if i not in unsure]
        cells = sorted(kept + closer, key=lambda c: c.low)


def _cells(groups: DataFrame, shift: int, inside: list[Cell] | None) -> list[Cell]:
    """Sums of key ranges of 2**shift keys: all of them, or those in the given ranges."""
    if inside is not None:
        above = inside[0].shift  # they all have the same
        wanted = [c.low >> above for c in inside]
        groups = groups.filter(F.shiftright("key", above).isin(wanted))
    sums = groups.groupBy(F.shiftright("key", shift).alias("cell")).agg(
        F.sum("bytes").alias("size"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("most")
    )
    found = [Cell(r["cell"] << shift, shift, r["size"], r["n"], r["most"]) for r in sums.collect()]
    return sorted(found, key=lambda c: c.low)


def _greedy(cells: list[Cell], ends: list[int], shards: int, capacity: int, sure: bool) -> list[int]:
    """Ends of the shards, as sums: at least reached (`sure`) or at most reachable."""
    out, at = [], 0
    for _ in range(shards):
        limit = at + capacity
        i = bisect_right(ends, limit)
        if i == len(ends):
            at = ends[-1]
        else:
            start = ends[i] - cells[i].size
            if cells[i].groups == 1:
                at = start
            elif sure:  # a group of this range ends above limit - largest
                at = max(start, limit - cells[i].largest + 1)
            else:
                at = limit
        out.append(at)
    return out


def _ends(cells: list[Cell]) -> list[int]:
    return list(accumulate(c.size for c in cells))


def _bounds(cells: list[Cell], shards: int) -> tuple[int, int]:
    """Smallest capacities that can be enough and that are surely enough."""
    ends = _ends(cells)
    least = max(-(-ends[-1] // shards), max(c.largest for c in cells))
    found = []
    for sure in (False, True):
        low, high = least, ends[-1]
        while low < high:
            middle = (low + high) // 2
            if _greedy(cells, ends, shards, middle, sure)[-1] >= ends[-1]:
                high = middle
            else:
                low = middle + 1
        found.append(low)
    return found[0], found[1]


def _unsure(cells: list[Cell], shards: int, low: int, high: int) -> set[int]:
    """Ranges of several groups in which a cut can fall for a capacity from low to high."""
    ends = _ends(cells)
    first = _greedy(cells, ends, shards, low, True)
    last = _greedy(cells, ends, shards, high, False)
    found = set()
    for a, b in zip(first, last):
        i = bisect_right(ends, a)
        while i < len(cells) and ends[i] - cells[i].size < b:
            if cells[i].groups > 1:
                found.add(i)
            i += 1
    return found


def _cut_cells(cells: list[Cell], shards: int, capacity: int) -> list[int]:
    """Index of the first range of each shard but the first."""
    ends = _ends(cells)
    starts = [bisect_right(ends, at) for at in _greedy(cells, ends, shards, capacity, True)]
    return sorted({i for i in starts if i < len(cells)})


def _shard_of(key: Column, alone: list[int], cuts: list[int]) -> Column:
    after = reduce(lambda a, b: a + b, [(key >= c).cast("int") for c in cuts], F.lit(len(alone)))
    for i, own in enumerate(alone):
        after = F.when(key == own, F.lit(i)).otherwise(after)
    return after.cast("int")


def _with_slots(rows: DataFrame, shards: int, slot_rows: int) -> DataFrame:
    """Gapless numbers per shard: blocks by hash of the id, each behind the blocks before it."""
    blocks = 1 + rows.count() // (shards * slot_rows)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "size"), F.lit(blocks)))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "block")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("shard", "block").orderBy("key", "doc_id", "size")
    return (
        rows.withColumn("slot", F.row_number().over(inside).cast("long") - 1)
        .join(offsets, ["shard", "block"])
        .withColumn("slot", F.col("slot") + F.col("offset"))
    )
