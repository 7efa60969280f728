"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint is cut into segments. Its segment values go into a table, the Hamming ball
around each segment value is looked up there, and what is found is verified by the
distance of the whole fingerprints. Equal fingerprints are one node throughout, so copies
never multiply.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import is_small, materialize
from .components import components
from .words import lower_blank_words, slices, utf8

SEED = 42
HOT_BUCKET = 256  # fingerprints in one table bucket that are matched without a finer key
_CHUNK = 1 << 16


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """XXH64 of every k words in a row, repeats included; of all words where there are fewer."""
    joined = b" ".join(words)
    if len(words) <= k:
        spans = [(0, len(joined))] if words else []
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        spans = zip([0, *ends], [e - 1 for e in ends[k - 1 :]])
    return np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits, as a signed number: 1 where over half the hashes have the bit. No hashes: zero."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp), one row per input row; null text has no words."""

    def scan(batches):
        for batch in slices(batches):
            fps = [fingerprint(shingle_hashes(lower_blank_words(t), words)) for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    own = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(scan, "doc_id long, fp long")


def _ball(bits: int, radius: int) -> list[int]:
    """All masks of `bits` bits with at most `radius` ones."""
    return [sum(1 << b for b in ones) for r in range(radius + 1) for ones in combinations(range(bits), r)]


def _keyed(rows: DataFrame, masks: list[int]) -> DataFrame:
    """(key, other, fp): both halves of a fingerprint, each xored with every mask."""
    low = F.col("fp").bitwiseAND(F.lit((1 << 32) - 1))
    high = F.shiftrightunsigned("fp", 32)
    half = lambda own, other, top: F.transform(
        F.array(*[F.lit(m).cast("long") for m in masks]),
        lambda m: F.struct(own.bitwiseXOR(m).bitwiseOR(F.lit(top)).alias("key"), other.alias("other")),
    )
    return rows.select("fp", F.inline(F.concat(half(low, high, 0), half(high, low, 1 << 32))))


def _finer(rows: DataFrame) -> DataFrame:
    """One row per byte of the other half, as part of the key."""
    return rows.select(
        "fp", "key", F.posexplode(F.array(*[F.shiftright("other", 8 * j).bitwiseAND(F.lit(255)) for j in range(4)])).alias("place", "byte")
    )


def links_within_3(nodes: DataFrame, hot: int = HOT_BUCKET) -> DataFrame:
    """(a, b) of all pairs of 64-bit fingerprints `fp` (distinct) that differ in 1 to 3 bits, a < b.

    Of two halves one differs in at most one bit, so the ball of radius 1 around each half
    meets the other fingerprint's half. In a bucket of more than `hot` fingerprints the key
    gets a byte of the other half as well: it differs in at most 3 bits, so one of its 4
    bytes is equal and no link is lost.
    """
    table, probes = _keyed(nodes, [0]), _keyed(nodes, _ball(32, 1))
    crowded = materialize(table.groupBy("key").count().filter(F.col("count") > hot).select("key"), "crowded")

    def match(left, right, on):
        right = right.select(F.col("fp").alias("b"), *on)
        near = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= 3
        return left.join(right, on).filter((F.col("fp") < F.col("b")) & near).select(F.col("fp").alias("a"), "b")

    if crowded.isEmpty():
        return match(probes, table, ["key"]).distinct()
    few = F.broadcast(crowded) if is_small(crowded) else crowded
    split = lambda rows, how: rows.join(few, "key", how)
    cold = match(split(probes, "left_anti"), split(table, "left_anti"), ["key"])
    warm = match(_finer(split(probes, "left_semi")), _finer(split(table, "left_semi")), ["key", "place", "byte"])
    return cold.unionByName(warm).distinct()


def duplicate_classes(docs: DataFrame, words: int = 3, doc: str = "doc_id", text: str = "text", hot: int = HOT_BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Fingerprints link at 3 or fewer differing bits; `component_id` is the smallest doc_id
    reachable. Null or empty text has fingerprint zero and links like any other. A null id
    gets a component but never names one (a component of null ids only has a null id).
    Rows that repeat are classified one by one, other columns ignored, no rows from an empty table.
    """
    rows = materialize(fingerprints(docs, words, doc, text), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links_within_3(nodes.select("fp"), hot))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(names, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its class by `duplicate_classes`, with the same columns.

    Rows that share an id are one document and stay or go together; a null id stays.
    """
    classes = duplicate_classes(docs, doc=doc, text=text, **options)
    # the smallest class of an id decides, should rows of one id have different texts
    gone = classes.groupBy("doc_id").agg(F.min("component_id").alias("to")).filter("to < doc_id")
    gone = gone.select(F.col("doc_id").alias("__near_id"))
    return docs.join(gone, F.col(doc) == F.col("__near_id"), "left_anti")
