"""Clustering in Walsh-Hadamard coefficients against plain sums over all components and centroids."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int, coefficients string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], SCHEMA)


def plain(rows, k=16, rounds=3):
    """The contract by brute force; rows are ``(id, vector)``."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]

    def drawn(row):
        return (row[0] is None, hashlib.sha256(f"1:{row[0]}".encode()).hexdigest())

    centroids = [v for _, v in sorted(kept, key=drawn)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), at) for at, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for at, own in groups.items():
            centroids[at] = [sum(column) // len(own) for column in zip(*own)]
    out = [(i, *reversed(nearest(v))) for i, v in kept]
    total = {c: sum(d for _, k, d in out if k == c) for _, c, _ in out}
    return sorted((repr(i), c, d, total[c], sum(total.values()),
                   hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in out)


def found(df):
    return sorted((repr(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
                  for r in clusters.with_inertia(*clusters.cluster_vectors(df)).collect())


def test_transform_keeps_distances_and_can_be_undone():
    rows = np.random.default_rng(0).integers(-1000, 1000, (50, 64))
    made = clusters.transformed(rows)
    assert (clusters.restored(made) == 64 * rows).all()
    assert ((made[0] - made[1]) ** 2).sum() == 64 * ((rows[0] - rows[1]) ** 2).sum()
    assert (made[:, 0] == rows.sum(axis=1)).all()
    signs = clusters.transformed(np.eye(64, dtype=np.int64)).T
    assert [(np.diff(row) != 0).sum() for row in signs] == list(range(64))


@pytest.mark.parametrize("spread", [1, 3, 1000])
def test_search_is_exact_with_ties(spread):
    draw = np.random.default_rng(spread)
    points, centroids = draw.integers(-spread, spread + 1, (300, 64)), draw.integers(-spread, spread + 1, (40, 64))
    centroids[7] = centroids[3]
    points[:20] = centroids[3]
    points[20:40] = (centroids[1] + centroids[2]) // 2
    every = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
    at, distance = clusters.nearest(clusters.transformed(points), clusters.transformed(centroids))
    assert (at == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_clusters_are_those_of_plain_sums(spark):
    draw = np.random.default_rng(5)
    rows = [(i, (draw.normal(size=64) * 0.2 + i % 5).tolist()) for i in range(120)]
    same = [0.25] * 64
    odd = [(None, same), (None, same), (7, same), (7, same), (200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65),
           (204, [None] + [1.0] * 63), (205, [math.nan] * 64), (206, [math.inf] + [0.0] * 63), (207, [-0.001] * 64), (208, same)]
    for chosen in (rows + odd, odd, rows[:3], [(1, same)] * 40, []):
        assert found(table(spark, chosen)) == plain(chosen)


def test_float_vectors_of_the_tables(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert found(vectors) == plain(rows) and len(rows) > 16


def test_huge_components_count_as_the_largest(spark):
    rows = [(i, [1e30 if i % 2 else -1e300] * 64) for i in range(20)]
    made, centroids = clusters.cluster_vectors(table(spark, rows), clusters=2)
    assert made.count() == 20 and abs(centroids).max() == clusters.LARGEST
    assert clusters.with_inertia(made, centroids).filter("inertia IS NULL").count() == 0


def test_repeated_rows_and_many_tasks_give_one_result(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert found(vectors.repartition(13, F.col("label"))) == found(vectors.repartition(2))
