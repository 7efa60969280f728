"""Mix sources towards target weights by weighted pivotal rounding.

Every document of a source wants the same fractional number of copies. Pairs of
fractions move word mass from one to the other until one of them is whole; each block
of documents leaves at most one fraction, and a tree of blocks settles those.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scale import global_index, materialize, running

WEIGHTS = (3, 1, 2)
BLOCK_ROWS = 50_000  # documents of one source that one task pairs
FAN_IN = 1_000  # left-over fractions that one task pairs
SPAN = 10_000  # rows of a repeated document that are numbered together
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, share: float = 1.5, weights: tuple = WEIGHTS, most: float = 2.0
) -> DataFrame:
    """(source, rank, source_size, target) from (source, source_size), one row per source.

    Sources rank by code point, null last, and take the weights in turn. Together they get
    `share` of all words; a target stops at `most` times its source's size and what is above
    is shared out again by weight.
    """
    ranked = global_index(sizes, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = materialize(
        ranked.withColumns({"weight": weight, "limit": F.lit(most) * F.col("source_size")}), "sources"
    )
    total, weighed = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = share * (total or 0)
    level = budget / weighed if weighed else 0.0
    full = F.col("limit") <= F.col("weight") * F.lit(level)
    while weighed:  # each round fills at least one more source
        full = F.col("limit") <= F.col("weight") * F.lit(level)
        taken, open_weight = rows.agg(
            F.coalesce(F.sum(F.when(full, F.col("limit"))), F.lit(0.0)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not open_weight or (budget - taken) / open_weight <= level:
            break
        level = (budget - taken) / open_weight
    target = F.when(full, F.col("limit")).otherwise(F.col("weight") * F.lit(level))
    return rows.select("source", "rank", "source_size", target.cast("double").alias("target"))


def settle(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Fractions with all but at most one made 0 or 1; the sum of size * fraction stays.

    In every pair, mass moves up or down the pair with the chances that keep each expected
    value, as far as the first of the two becomes whole.
    """
    p = p.copy()
    alive = np.flatnonzero((p > 0) & (p < 1))
    while len(alive) > 1:
        i, j = alive[: len(alive) // 2 * 2 : 2], alive[1::2]
        up = np.minimum(size[i] * (1 - p[i]), size[j] * p[j])
        down = np.minimum(size[i] * p[i], size[j] * (1 - p[j]))
        raises = rng.random(len(i)) * (up + down) < down
        fills = size[i] * (1 - p[i]) <= size[j] * p[j]  # raising makes i whole, else empties j
        empties = size[i] * p[i] <= size[j] * (1 - p[j])  # lowering empties i, else makes j whole
        pi = np.where(raises, p[i] + up / size[i], p[i] - down / size[i])
        pj = np.where(raises, p[j] - up / size[j], p[j] + down / size[j])
        pi = np.where(raises & fills, 1.0, np.where(~raises & empties, 0.0, pi))
        pj = np.where(raises & ~fills, 0.0, np.where(~raises & ~empties, 1.0, pj))
        p[i], p[j] = np.clip(pi, 0, 1), np.clip(pj, 0, 1)
        alive = alive[(p[alive] > 0) & (p[alive] < 1)]
    return p


def _pairing(seed: int, level: int, last: bool):
    """A task that settles one group of fractions, in the order of the ids."""

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "mass"], kind="stable", ignore_index=True)
        first = pdf.iloc[0]
        rng = np.random.default_rng([seed, level, int(first["rank"]), int(first["node"])])
        p = settle(pdf["p"].to_numpy(float), pdf["mass"].to_numpy(float), rng)
        if last:
            p = np.where((p > 0) & (p < 1), rng.random() < p, p).astype(float)
        return pdf.assign(p=p)

    return pair


def _settled(units: DataFrame, seed: int, blocks: int, fan_in: int) -> DataFrame:
    """`units` (rank, node, order, mass, p, ...) with p 0 or 1 throughout."""
    level, nodes = 0, blocks
    done = materialize(
        units.groupBy("rank", "node").applyInPandas(_pairing(seed, 0, nodes == 1), units.schema), "paired"
    )
    open_ = (F.col("p") > 0) & (F.col("p") < 1)
    results = None
    left = done.filter(open_).select("rank", "node", F.col("node").alias("block"), "order", "mass", "p")
    while nodes > 1:  # the tree has log(blocks) levels
        level, nodes = level + 1, -(-nodes // fan_in)
        left = left.withColumn("node", F.floor(F.col("node") / fan_in).cast("long"))
        paired = materialize(
            left.groupBy("rank", "node").applyInPandas(_pairing(seed, level, nodes == 1), left.schema), "tree"
        )
        settled = paired.filter(~open_).select("rank", "block", F.col("p").alias("settled"))
        results = settled if results is None else results.unionByName(settled)
        left = paired.filter(open_)
    if results is None:
        return done
    whole = done.join(results.withColumnRenamed("block", "node"), ["rank", "node"], "left")
    return whole.withColumn("p", F.when(open_, F.col("settled")).otherwise(F.col("p"))).drop("settled")


def mix_counts(
    docs: DataFrame,
    share: float = 1.5,
    weights: tuple = WEIGHTS,
    most: float = 2.0,
    seed: int = 17,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_rows: int = BLOCK_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """(doc_id, source, size, n_rows, source_size, target, copies, n_more) per distinct document.

    A document is (doc_id, source, size); of the rows that repeat it (`n_rows`), `n_more` get one copy
    more than the `copies` that each gets, which makes at most `most` rounded up. The fractions of equal
    rows settle among themselves, as in any pairing of equal masses, so that one fraction of
    one row is left for the pairing with others. A source's words in the mix differ from its target by
    less than its largest document. Null text has size 0 and a document without words no
    copies; null ids and sources count as values. Runs agree whatever the partitions. An
    empty table gives no rows.
    """
    units = materialize(
        docs.select(F.col(doc).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
        .groupBy("doc_id", "source", "size")
        .agg(F.count(F.lit(1)).alias("n_rows")),
        "mix-units",
    )
    mass = F.col("size") * F.col("n_rows")
    sizes = units.groupBy("source").agg(F.sum(mass).alias("source_size"), F.count(F.lit(1)).alias("n_units"))
    largest = sizes.agg(F.max("n_units")).first()[0] or 0
    blocks = 1 + largest // block_rows
    targets = source_targets(sizes.drop("n_units"), share, weights, most).withColumnRenamed("source", "name")
    same = F.col("source").eqNullSafe(F.col("name"))
    wanted = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = units.join(targets, same).select(
        "doc_id", "source", "size", "n_rows", "rank", "source_size", "target",
        F.floor(wanted).alias("whole"),
        ((wanted - F.floor(wanted)) * F.col("n_rows")).alias("more"),
        F.col("size").cast("double").alias("mass"),
        F.xxhash64("doc_id", "source", "size").alias("order"),
    )
    joined = joined.withColumn("settled_rows", F.floor("more")).withColumn("p", F.col("more") - F.col("settled_rows")).drop("more")
    numbered = joined.withColumn("node", F.pmod("order", F.lit(blocks)).cast("long"))
    done = _settled(numbered, seed, blocks, fan_in)
    return done.select(
        "doc_id", "source", "size", "n_rows", "source_size", "target",
        F.col("whole").cast("long").alias("copies"),
        (F.col("settled_rows") + F.col("p")).cast("long").alias("n_more"),
    )


def mix_rows(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per input row; see `mix_counts`."""
    counts = mix_counts(docs, **options)
    step = F.lit(SPAN).cast("long")
    # numbers of the rows of a document in spans, so that no array is as long as its repeats
    spans = counts.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_rows") - 1, step)))
    last = F.least(F.col("first") + step, F.col("n_rows")) - 1
    each = spans.withColumn("row", F.explode(F.sequence("first", last)))
    taken = F.col("size") * (F.col("copies") + (F.col("row") < F.col("n_more")).cast("long"))
    return each.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with the same columns."""
    counts = materialize(mix_counts(docs, text=text, **options).filter("copies + n_more > 0"), "mix-counts")
    counts = counts.select(
        F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("size").alias("__mix_size"),
        F.col("n_rows").alias("__mix_rows"), F.col("copies").alias("__mix_copies"), F.col("n_more").alias("__mix_more"),
    )
    doc, source = options.get("doc", "doc_id"), options.get("source", "source")
    same = (
        F.col(doc).eqNullSafe(F.col("__mix_id"))
        & F.col(source).eqNullSafe(F.col("__mix_source"))
        & (word_count(F.col(text)) == F.col("__mix_size"))
    )
    some = (F.col("__mix_more") > 0) & (F.col("__mix_more") < F.col("__mix_rows"))
    more = (F.col("__mix_more") > 0).cast("long")
    # a row per document has no size bound: both sides are shuffled and merged at every size, never broadcast
    taken = docs.join(counts.filter(~some).hint("merge"), same).withColumn("__mix_times", F.col("__mix_copies") + more)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    uneven = counts.filter(some)
    if not uneven.isEmpty():
        # equal documents of which only some get a copy more: the first by their content, equal rows by place
        content = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
        rows = materialize(
            docs.join(uneven, same).withColumn("__mix_content", content).withColumn("__mix_place", F.monotonically_increasing_id()),
            "uneven",
        )
        keys, order = ["__mix_id", "__mix_source", "__mix_size"], ["__mix_content", "__mix_place"]
        placed = running(rows, keys, [F.col(c) for c in order], {"__mix_before": ("sum", F.lit(1).cast("long"))})
        placed = placed.withColumn(
            "__mix_times", F.col("__mix_copies") + (F.col("__mix_before") < F.col("__mix_more")).cast("long")
        ).filter("__mix_times > 0")
        taken = taken.select(*columns, "__mix_times").unionAll(placed.select(*columns, "__mix_times"))
    again = F.explode(F.sequence(F.lit(1).cast("long"), "__mix_times")).alias("__mix_copy")
    return taken.select(*columns, again).select(*[f"`{c}`" for c in docs.columns])
