"""Per-entity features, declared as data and computed in one grouping."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.operators.joins import with_key


@dataclass(frozen=True)
class Feature:
    """One aggregate of a detail table.

    ``kind`` is rows, rows_where, max, min, mean, std, distinct, distinct_incl_null
    or distinct_nullable. ``fill`` replaces null after the join to the spine.
    """

    name: str
    kind: str
    source: Column | None = None
    fill: object | None = None


def summary(prefix: str, source: Column) -> list[Feature]:
    """Maximum, minimum, mean and sample deviation; one value has no deviation."""
    return [Feature(f"{prefix}_{kind}", kind, source) for kind in ("max", "min", "mean", "std")]


def _expression(feature: Feature, approx: bool) -> Column:
    source = feature.source
    distinct = F.approx_count_distinct if approx else F.count_distinct
    if feature.kind == "rows":
        value = F.count(F.lit(1))
    elif feature.kind == "rows_where":
        value = F.nullif(F.count_if(source), F.lit(0))
    elif feature.kind in ("max", "min"):
        value = getattr(F, feature.kind)(source)
    elif feature.kind == "mean":
        value = F.avg(source)
    elif feature.kind == "std":
        value = F.stddev_samp(source)
    elif feature.kind == "distinct":
        value = distinct(source)
    elif feature.kind == "distinct_nullable":
        value = F.nullif(distinct(source), F.lit(0).cast("bigint"))
    elif feature.kind == "distinct_incl_null":
        value = distinct(source) + F.max(F.when(source.isNull(), 1).otherwise(0))
    else:
        raise ValueError(f"unknown feature kind {feature.kind!r}")
    return value.alias(feature.name)


def entity_features(df: DataFrame, key: Sequence[str], features: Sequence[Feature],
                    approx: bool = False) -> DataFrame:
    """All features of one table in one ``groupBy``; rows without a key are left out.

    Counts and statistics combine in the map tasks. A distinct count first
    groups by key *and* value, so a hot key spreads over its values; rows
    without a key never reach the shuffle. ``approx`` swaps exact distinct
    counts for sketches, which need no second grouping.
    """
    return with_key(df, key).groupBy(*key).agg(*[_expression(f, approx) for f in features])


def fills(features: Sequence[Feature]) -> dict[str, object]:
    """The fill values of the features that have one."""
    return {f.name: f.fill for f in features if f.fill is not None}


def vector_mean(df: DataFrame, key: Sequence[str], array: str, size: int, name: str) -> DataFrame:
    """Element-wise mean of equally long arrays per key, without exploding them."""
    means = [F.avg(F.get(F.col(array), F.lit(i))).alias(f"_m{i}") for i in range(size)]
    return df.groupBy(*key).agg(*means).select(*key, F.array(*[F.col(f"_m{i}") for i in range(size)]).alias(name))
