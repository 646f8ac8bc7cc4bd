"""Exact nearest-centroid clustering in Walsh-Hadamard coefficients, searched coarse to fine."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import spread, stage

#: Clusters, rounds of the update, and the factor before components are rounded down.
CLUSTERS, ROUNDS, SCALE = 16, 3, 64
SIZE = 64
#: Rounded components beyond this count as this, so that 64-bit sums of squares stay exact.
LARGEST = 1 << 24
#: The search compares centroids after so many coefficients, and at the end after all of them.
STEPS = (4, 8, 16, 32)
#: Pairs of vector and centroid that are worked on together.
PAIRS = 1 << 16


@lru_cache(maxsize=4)
def sequency_order(size: int) -> np.ndarray:
    """The rows of the Hadamard matrix by their number of sign changes: coarse ones first."""
    matrix = np.ones((1, 1), np.int64)
    while len(matrix) < size:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return np.argsort((np.diff(matrix, axis=1) != 0).sum(axis=1))


def _butterflies(rows: np.ndarray) -> np.ndarray:
    out, half = rows, 1
    while half < rows.shape[1]:
        pairs = out.reshape(len(rows), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows.shape)
        half *= 2
    return out


def transformed(rows: np.ndarray) -> np.ndarray:
    """Exact integer coefficients of integer rows (a power of two wide), coarse to fine.

    The transform keeps distances: a squared distance of coefficients is
    ``width`` times that of the rows.
    """
    return _butterflies(rows)[:, sequency_order(rows.shape[1])]


def restored(coefficients: np.ndarray) -> np.ndarray:
    """``width`` times the rows (the transform is its own inverse but for that factor)."""
    plain = np.empty_like(coefficients)
    plain[:, sequency_order(coefficients.shape[1])] = coefficients
    return _butterflies(plain)


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row of coefficients (ties: the smaller number) and the squared distance.

    Sums over the first coefficients never exceed the whole sum. The centroid
    that is closest after the first step is finished for each row, and from then on a
    centroid whose sum so far is larger than that distance is out: it is strictly
    worse. Equal ones stay in, so ties are decided on whole sums.
    """
    width, rows = points.shape[1], np.arange(len(points))
    sums = np.zeros((len(points), len(centroids)), np.int64)
    first = STEPS[0]
    for place in range(first):
        sums += (points[:, place, None] - centroids[None, :, place]) ** 2
    leader = sums.argmin(axis=1)
    bound = sums[rows, leader] + ((points[:, first:] - centroids[leader, first:]) ** 2).sum(axis=1)
    alive = sums <= bound[:, None]
    for start, stop in zip(STEPS, (*STEPS[1:], width)):
        at, which = np.nonzero(alive)
        sums[at, which] += ((points[at, start:stop] - centroids[which, start:stop]) ** 2).sum(axis=1)
        alive[at, which] = sums[at, which] <= bound[at]
    sums[~alive] = np.iinfo(np.int64).max
    best = sums.argmin(axis=1)
    return best, sums[rows, best] // width


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of ``(vec_id, coefficients)`` with their rows of coefficients, clusters and distances."""
    step = max(1, PAIRS // max(1, len(centroids)))
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        points = np.frombuffer(b"".join(part.column(1).to_pylist()), "<i4").reshape(part.num_rows, -1).astype(np.int64)
        yield part, points, *nearest(points, centroids)


def coefficient_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = SIZE,
                     scale: int = SCALE) -> DataFrame:
    """``vec_id, coefficients`` (little-endian 32-bit) of the vectors with ``size`` finite components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            whole = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
            batch = batch.filter(whole)
            flat = batch.column(1).flatten()
            known = np.asarray(flat.is_valid()).reshape(-1, size).all(axis=1)
            numbers = flat.fill_null(0).cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)
            good = known & np.isfinite(numbers).all(axis=1)
            integers = np.clip(np.floor(scale * numbers[good]), -LARGEST, LARGEST).astype(np.int64)
            rows = transformed(integers).astype("<i4") if len(integers) else integers
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(good)), pa.array([row.tobytes() for row in rows], pa.binary())],
                names=["vec_id", "coefficients"])

    kind = dict(vectors.dtypes)[id_col]
    return vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector")) \
        .mapInArrow(run, f"vec_id {kind}, coefficients binary")


def first_centroids(rows: DataFrame, clusters: int, seed: int, size: int) -> np.ndarray:
    """The rows of smallest hash of seed and id, in order; rows without an id come last, equal ids by their vector."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = rows.select(drawn.alias("drawn"), "coefficients").orderBy(F.col("drawn").asc_nulls_last(), "coefficients") \
        .limit(clusters).collect()
    return np.array([np.frombuffer(r["coefficients"], "<i4") for r in chosen], np.int64).reshape(len(chosen), size)


def updated_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the exact mean of its rows, rounded down per component; those without rows stay.

    Tasks add up their own rows, so at most ``clusters`` rows leave a task, and the
    driver sees one row per cluster. Sums of coefficients are the
    coefficients of the sums, so the mean is taken after restoring them.
    """
    clusters, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((clusters, width), np.int64), np.zeros(clusters, np.int64)
        for batch in batches:
            for _, points, found, _ in _assigned(batch, centroids):
                for cluster in np.unique(found):
                    own = points[found == cluster]
                    sums[cluster] += own.sum(axis=0)
                    counts[cluster] += len(own)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int64()), pa.array(counts[held], pa.int64()), pa.array(list(sums[held]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    # Decimals: a sum over all tasks may exceed 64 bits.
    totals = rows.mapInArrow(run, "cluster long, n long, sums array<long>").groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.get("sums", i).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)])
    out = centroids.copy()
    for row in totals.collect():
        total = np.array([[int(row[f"s{i}"]) for i in range(width)]], object)
        means = np.array([[int(s) // width // row["n"] for s in restored(total)[0]]], np.int64)
        out[row["cluster"]] = transformed(means)[0]
    return out


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 1,
                    id_col: str = "vec_id", vector_col: str = "embedding", size: int = SIZE,
                    scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every kept vector, and the final centroids (integers, one row each).

    Kept are vectors of exactly ``size`` (a power of two) components, none null
    or non-finite; a component x becomes floor(scale * x). Centroids start as the vectors of
    smallest hash; with fewer vectors there are as many centroids as vectors. Each round
    assigns all vectors and replaces every centroid that has any by their mean,
    rounded down. Distances are squared and exact. Repeated rows count as often
    as they occur, rows without an id take part but start a centroid only after
    all others, ties go to the smaller number, an empty table gives no rows.
    Rounded components beyond 2^24 count as 2^24.

    Every vector is transformed once and written (4 bytes a component); no
    vector is ever shuffled, and the driver holds the centroids alone.
    """
    rows = stage(coefficient_rows(spread(vectors.select(id_col, vector_col), id_col), id_col, vector_col, size, scale),
                 "coefficients")
    centroids = first_centroids(rows, clusters, seed, size)
    kind = dict(rows.dtypes)["vec_id"]
    schema = f"vec_id {kind}, cluster int, distance long"
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], schema), centroids
    for _ in range(rounds):
        centroids = updated_centroids(rows, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, found, distances in _assigned(batch, centroids):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.int32()), pa.array(distances, pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    return stage(rows.mapInArrow(run, schema), "assigned"), restored(centroids) // size


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The assignment with ``cluster_inertia, inertia, centroid_sha256``; one row per cluster is broadcast.

    An inertia that does not fit into 64 bits is null.
    """
    spark = assigned.sparkSession
    totals = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}

    def fitting(number: int) -> int | None:
        return number if number < 1 << 63 else None

    everything = fitting(sum(totals.values()))
    rows = [(cluster, fitting(total), everything, hashlib.sha256(
        ",".join(map(str, centroids[cluster].tolist())).encode()).hexdigest()) for cluster, total in totals.items()]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
