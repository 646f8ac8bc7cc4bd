"""One row per entity: first record, latest record, ordered unions.

A filter on ``row_number() = 1`` lets Spark keep only the best row per key
inside every map task (``WindowGroupLimit`` below the exchange), so even a key
that holds a third of the table sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.operators.joins import with_key


def _best(df: DataFrame, key: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*key).orderBy(*order)
    return (
        with_key(df, key)
        .withColumn("_row_rank", F.row_number().over(window))
        .filter("_row_rank = 1")
        .select(*key, *columns)
    )


def first_record(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The first row per key in the order of ``order`` (all ascending)."""
    return _best(df, key, [F.col(c).asc() for c in order], columns)


def latest_record(df: DataFrame, key: Sequence[str], by: str | Column, tie: Sequence[str],
                  columns: Sequence[str]) -> DataFrame:
    """The row with the greatest ``by``, nulls last; ties by ``tie`` ascending.

    ``by`` may be the raw text column (text order) or a parsed date.
    """
    by = F.col(by) if isinstance(by, str) else by
    return _best(df, key, [by.desc_nulls_last(), *[F.col(c).asc() for c in tie]], columns)


def stack_sources(parts: Sequence[tuple[DataFrame, int]], flag: str, rank: str) -> DataFrame:
    """Union by name; keeps where a row came from and which source goes first.

    ``parts`` holds ``(table, flag value)`` in order of precedence.
    """
    stacked = None
    for position, (df, value) in enumerate(parts):
        tagged = df.withColumns({flag: F.lit(value), rank: F.lit(position)})
        stacked = tagged if stacked is None else stacked.unionByName(tagged, allowMissingColumns=True)
    return stacked
