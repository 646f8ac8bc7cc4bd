"""Joins: many-to-one attach, membership, and a lookup that spreads hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot when it holds more than 1/HOT_SLOTS of all rows. There can be at
# most HOT_SLOTS such keys, which is the bound on what the lookup broadcasts.
HOT_SLOTS = 256
# The share of rows whose keys are looked at to find the hot ones.
HOT_SAMPLE = 0.01


def attach(spine: DataFrame, tables: Sequence[DataFrame], key: Sequence[str],
           fill: Mapping[str, object] | None = None) -> DataFrame:
    """Left-join tables that are unique on ``key``; the row count never changes.

    The spine and every table are unique on the key, so no key is hot. All
    joins share one key: the spine is shuffled once, and a table that was
    grouped by the key is already in place. No broadcast is hinted; adaptive
    execution picks it when the measured side is small.
    """
    joined = reduce(lambda left, right: left.join(right, list(key), "left"), tables, spine)
    if not fill:
        return joined
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def with_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key columns are all present; the filter reaches the scan."""
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in key]))


def distinct_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The non-null keys of a table, each once."""
    return with_key(df, key).select(*key).distinct()


def membership_flags(spine: DataFrame, sets: Mapping[str, DataFrame], key: Sequence[str]) -> DataFrame:
    """One 0/1 column per key set, all through a single grouped join.

    ``sets`` maps a flag name to a table holding the key columns. Repeated
    keys change nothing; a null key never matches.
    """
    tagged = [with_key(df, key).select(*key, F.lit(flag).alias("_flag")) for flag, df in sets.items()]
    flags = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy(*key)
        .agg(*[F.max(F.when(F.col("_flag") == flag, 1).otherwise(0)).alias(flag) for flag in sets])
    )
    return attach(spine, [flags], key, fill={flag: 0 for flag in sets})


def lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], spread_by: Sequence[str],
           weight: str | None = None, how: str = "left", slots: int = HOT_SLOTS,
           sampled: float = HOT_SAMPLE) -> DataFrame:
    """Join many rows to a table that is unique on ``on``, whatever the skew.

    Hot keys are looked up in a broadcast of at most ``slots`` table rows. The
    rest is an ordinary equi-join in which hot and null-keyed rows, which need
    no partner any more, carry a salt taken from ``spread_by`` (the columns
    that identify a row) and so spread over all tasks.

    ``weight`` names a table column that already holds the number of rows per
    key. Without it, the keys of a sample of the rows show which keys are hot.
    That choice only decides where a row finds its partner: the equi-join keeps
    the whole table, so the result is the same for any choice.

    ``how`` is left, inner, left_semi or left_anti.
    """
    keys = list(on)
    row_types, table_types = dict(rows.dtypes), dict(table.dtypes)
    if any(row_types[k] != table_types[k] for k in keys):
        raise TypeError("cast the keys to one type first: equal values of two types hash differently")
    taken = [c for c in table.columns if c not in keys and c != weight]
    if weight:
        counts = table.select(*keys, F.col(weight).alias("_n"))
    else:
        seen = rows.select(*keys).sample(fraction=sampled, seed=0) if sampled < 1 else rows.select(*keys)
        counts = with_key(seen, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    hot_keys = counts.filter(F.col("_n") * slots > total).select(*keys)

    hot = table.join(F.broadcast(hot_keys), keys, "left_semi").select(
        *keys, *[F.col(c).alias(f"_hot_{c}") for c in taken], F.lit(1).alias("_found_hot"))
    # The salt is mixed into a hash of the key, because a join on a constant
    # salt would be rewritten to a filter and the rows placed by the key alone.
    cold = table.select(
        *keys, F.xxhash64(*keys, F.lit(0)).alias("_place"), *[F.col(c).alias(f"_cold_{c}") for c in taken],
        F.lit(1).alias("_found_cold"))

    spread = F.pmod(F.xxhash64(*spread_by), F.lit(slots)).cast("int") + 1
    null_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    salt = F.when(F.col("_found_hot").isNotNull() | null_key, spread).otherwise(0)
    placed = rows.join(F.broadcast(hot), keys, "left").withColumn("_place", F.xxhash64(*keys, salt))
    joined = placed.join(cold, ["_place", *keys], "left")
    found = F.coalesce(F.col("_found_hot"), F.col("_found_cold")).isNotNull()
    if how in ("inner", "left_semi"):
        joined = joined.filter(found)
    elif how == "left_anti":
        joined = joined.filter(~found)
    if how in ("left_semi", "left_anti"):
        return joined.select(*rows.columns)
    value = lambda c: F.when(F.col("_found_hot").isNotNull(), F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}"))
    return joined.select(*rows.columns, *[value(c).alias(c) for c in taken])
