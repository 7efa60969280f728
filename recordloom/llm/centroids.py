"""Centroid clustering of integer vectors with a progressive search in the Walsh-Hadamard domain.

The transform H is exact on integers and stretches squared distances by the number of components,
so the squares of the first few coefficient differences are a lower bound of the distance and all
of them are the distance itself. Coefficients are taken coarse to fine; a centroid whose sum so far
exceeds the full sum of one that was finished is strictly worse and goes. Ties stay to the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import materialize
from .words import slices

PARTS, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
STEPS = (0, 4, 16, 64)  # coefficients added up together
MOST = 1 << 24  # components are held to this size, so that sums of squares are exact in 64 bits
_LONG = (1 << 63) - 1
_MADE = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid": "array<long>"}


def _sequency(n: int) -> np.ndarray:
    """Rows of the transform by their changes of sign: the coarsest first."""
    rows = transform(np.eye(n, dtype=np.int64))
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def transform(vectors: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row, without scaling: additions only."""
    rows, n = vectors.shape
    out, half = vectors.astype(np.int64), 1
    while half < n:
        pairs = out.reshape(rows, n // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, n)
        half *= 2
    return out


def nearest(vectors: np.ndarray, centroids: np.ndarray, steps=STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, smaller numbers first among equals; squared distance) per row."""
    n, parts = vectors.shape
    coarse = _sequency(parts)
    points, centres = transform(vectors)[:, coarse], transform(centroids)[:, coarse]

    def added(row, centre, low, high):
        return ((points[row, low:high] - centres[centre, low:high]) ** 2).sum(axis=1)

    row, centre = np.repeat(np.arange(n), len(centres)), np.tile(np.arange(len(centres)), n)
    total = added(row, centre, steps[0], steps[1])
    for low, high in zip(steps[1:-1], steps[2:]):
        # finish the row's best centroid so far: its sum bounds what the others may reach
        best = _least(row, total, n)
        bound = total[best] + added(row[best], centre[best], low, parts)
        stays = total <= bound[row]
        row, centre, total = row[stays], centre[stays], total[stays]
        total = total + added(row, centre, low, high)
    first = _least(row, total, n)
    return centre[first], total[first] // parts


def _least(row: np.ndarray, total: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows the first place with its least total; every row has places, all in order."""
    least = np.minimum.reduceat(total, np.searchsorted(row, np.arange(n))) if n else total
    places = np.flatnonzero(total == least[row])
    return places[np.searchsorted(row[places], np.arange(n))]


def _matrix(column, parts: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, parts).astype(np.int64)


def whole_vectors(rows: DataFrame, vec: str = "vec_id", embedding: str = "embedding", parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, parts array<long>): floor(scale * x) of vectors with `parts` finite components; others are left out.

    Components beyond 2^24 in size count as 2^24.
    """
    x = F.col(f"`{embedding}`").cast("array<double>")
    # NaN is larger than infinity in Spark's order
    good = (F.size(x) == parts) & F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
    held = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), v * F.lit(float(scale))))))
    kept = rows.filter(x.isNotNull() & good)
    return kept.select(F.col(f"`{vec}`").alias("vec_id"), held.cast("array<bigint>").alias("parts"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = 1) -> list[list[int]]:
    """The vectors with the smallest hashes of seed and id (null as empty; ties: by components), in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r["parts"] for r in vectors.orderBy(mark, "parts").limit(clusters).select("parts").collect()]


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    schema = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).schema
    centres = np.array(centroids, np.int64)

    def run(batches):
        for batch in slices(batches, 4096):
            cluster, distance = nearest(_matrix(batch.column(1), centres.shape[1]), centres)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    return vectors.select("vec_id", "parts").mapInArrow(run, schema)


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: the floor of each cluster's mean, empty clusters as they were.

    Every task adds up its own vectors; at most clusters x components sums reach the driver.
    """
    centres = np.array(centroids, np.int64)
    k, parts = centres.shape

    def run(batches):
        sums, counts = np.zeros((k, parts), np.int64), np.zeros(k, np.int64)
        for batch in slices(batches, 4096):
            values = _matrix(batch.column(0), parts)
            cluster, _ = nearest(values, centres)
            np.add.at(sums, cluster, values)
            counts += np.bincount(cluster, minlength=k)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(seen, parts)),
                pa.array(np.tile(np.arange(parts), len(seen))),
                pa.array(sums[seen].ravel()),
                pa.array(np.repeat(counts[seen], parts)),
            ],
            names=["cluster", "part", "total", "n"],
        )

    partial = vectors.select("parts").mapInArrow(run, "cluster long, part long, total long, n long")
    totals = partial.groupBy("cluster", "part").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    after = [list(c) for c in centroids]
    for r in totals.collect():
        after[r["cluster"]][r["part"]] = r["total"] // r["n"]
    return after


def cluster_vectors(
    rows: DataFrame,
    vec: str = "vec_id",
    embedding: str = "embedding",
    parts: int = PARTS,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = 1,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every vector kept by `whole_vectors`.

    Centroids start as the vectors with the smallest hashes, are moved `rounds` times and stay
    integers, so that results do not depend on the order of sums. Fewer vectors than `clusters` make as
    many centroids; repeated rows and null ids count as rows of their own; equal centroids give the
    smaller number; no vector left gives no rows. Inertias over 2^63 - 1 are shown as that.
    Components must be a power of two. Other columns are ignored.
    """
    vectors = materialize(whole_vectors(rows, vec, embedding, parts, scale), "vectors")
    centroids = first_centroids(vectors, clusters, seed)
    spark = rows.sparkSession
    if not centroids:
        schema = vectors.select("vec_id", *[F.lit(None).cast(t).alias(n) for n, t in _MADE.items()]).schema
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    assigned = materialize(assign(vectors, centroids), "assigned")
    by_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"))
    sums = {r["cluster"]: int(r["total"]) for r in by_cluster.collect()}  # one row a cluster
    whole = min(sum(sums.values()), _LONG)
    known = [(i, min(sums.get(i, 0), _LONG), whole, c) for i, c in enumerate(centroids)]
    table = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return assigned.join(F.broadcast(table), "cluster").select("vec_id", *_MADE)


def centroid_digests(rows: DataFrame) -> DataFrame:
    """The rows with centroid_sha256, the digest of the components joined by commas, instead of the centroid."""
    listed = F.concat_ws(",", F.col("centroid").cast("array<string>"))
    return rows.withColumn("centroid_sha256", F.sha2(listed, 256)).drop("centroid")
