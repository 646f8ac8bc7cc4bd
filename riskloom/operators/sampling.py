"""Folds, bags, splits and weights that any executor can recompute.

Every assignment is a function of the row's key, not of its place or of a
random stream: it needs no shuffle and comes out the same after a lost task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

HASH_RANGE = 1 << 32


def key_hash(key: Sequence[str], seed: int) -> Column:
    """A number in [0, 2^32) from the key and the seed."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def hash_fold(key: Sequence[str], folds: int, seed: int) -> Column:
    """Fold number 0 .. folds-1; about equal in every class."""
    return (key_hash(key, seed) % folds).cast("int")


def stratified_fold(df: DataFrame, key: Sequence[str], label: str, folds: int, seed: int,
                    name: str = "fold", buckets: int = 1 << 16) -> DataFrame:
    """Folds whose sizes differ by at most one within each class; null for a null class.

    Rows of a class are dealt out in the order of their hashed keys. The hash
    is uniform, so its range is cut into equal ``buckets``: each is ordered by
    itself, and the rows before it are known from one count per class and
    bucket. Two classes never mean two tasks. ``key`` identifies a row. The counts
    meet the rows where these already are, whatever the number of classes.
    """
    hashed = key_hash(key, seed)
    dealt = df.withColumns({"_hash": hashed, "_bucket": F.floor(hashed / (HASH_RANGE // buckets)).cast("int")})
    counts = dealt.filter(F.col(label).isNotNull()).groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(label, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(label, "_bucket").orderBy("_hash", *[F.col(c).cast("string") for c in key])
    placed = dealt.withColumn("_place", F.row_number().over(inside) - 1)
    return placed.join(before, [label, "_bucket"], "left").select(
        *df.columns, ((F.col("_before") + F.col("_place")) % folds).cast("int").alias(name))


def holdout_split(key: Sequence[str], test_share: float, seed: int) -> Column:
    """``test`` for about ``test_share`` of the keys, ``train`` for the others."""
    bound = int(test_share * HASH_RANGE)
    return F.when(key_hash(key, seed) < bound, "test").otherwise("train")


def time_window_split(df: DataFrame, timestamp: str, split: str, train_days: int = 3, test_days: int = 1,
                      name: str = "part") -> DataFrame:
    """``train``: the days before ``split``; ``test``: the days from it on; other rows are outside both.

    The outer bounds are plain comparisons with constants, so the scan skips
    what lies outside.
    """
    at = F.lit(split).cast("timestamp_ntz")
    first, end = at - F.make_dt_interval(F.lit(train_days)), at + F.make_dt_interval(F.lit(test_days))
    inside = df.filter((F.col(timestamp) >= first) & (F.col(timestamp) < end))
    return inside.withColumn(name, F.when(F.col(timestamp) < at, "train").otherwise("test"))


def negative_bags(df: DataFrame, key: Sequence[str], label: str, bags: int = 4, seed: int = 0,
                  leave_one_out: bool = False) -> DataFrame:
    """Re-balanced training bags as rows: a ``bag`` column, 0 .. bags-1.

    Each positive is in every bag. Each negative is in one bag, or, with
    ``leave_one_out``, in every bag but one. Rows multiply inside their own
    task; nothing is shuffled.
    """
    part = hash_fold(key, bags, seed)
    every = F.sequence(F.lit(0), F.lit(bags - 1))
    own = F.filter(every, lambda b: b != part) if leave_one_out else F.array(part)
    # Rows of no known class belong to neither side.
    return df.filter(F.col(label).isNotNull()).withColumn(
        "bag", F.explode(F.when(F.col(label) == 1, every).otherwise(own)))


def sample_weights(condition: Column, weight: int = 2, base: int = 1) -> Column:
    """``weight`` where the condition holds, ``base`` elsewhere."""
    return F.when(condition, weight).otherwise(base)


def bootstrap_counts(key: Sequence[str], fraction: float, seed: int) -> Column:
    """How often a row is drawn when sampling ``fraction`` with replacement.

    Poisson counts: the key's hash is compared with the cumulative
    probabilities, up to where they no longer fit the hash's resolution.
    """
    bounds, total, term, k = [], 0.0, math.exp(-fraction), 0
    while True:
        total += term
        bound = int(total * HASH_RANGE)
        if bound >= HASH_RANGE - 1 or (bounds and bound == bounds[-1]):
            break
        bounds.append(bound)
        k += 1
        term *= fraction / k
    hashed = key_hash(key, seed)
    return reduce(Column.__add__, [F.when(hashed >= bound, 1).otherwise(0) for bound in bounds])


def bootstrap_sample(df: DataFrame, key: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """A sample with replacement; drawn rows repeat with a ``draw`` number from 1."""
    times = bootstrap_counts(key, fraction, seed)
    return (
        df.withColumn("_times", times).filter("_times > 0")
        .withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")
    )
