"""Exact global positions, ranks and prefix sums without a single-task window.

``Window.orderBy`` without a partition sends every row to one task. Here the
rows are first reduced to distinct values (no value can be hot any more), then
range-partitioned, so that each task orders only its own slice, and the slices
are put together with one offset per slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.session import stage


def ordered_values(df: DataFrame, group: Sequence[str], value: str,
                   measures: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per distinct non-null ``value`` in each ``group``, in order.

    Columns: the group, the value, ``n`` (its rows), each measure, ``position``
    (0-based place among the distinct values) and, for ``n`` and each measure,
    ``before_<name>``: the sum over all smaller values of the group.

    Groups are meant to be few (columns, models); values may be any number.
    The slice of a value is written down before it is used, because range
    boundaries come from sampling and a second run could draw them elsewhere.
    """
    group = list(group)
    sums = {"n": F.count(F.lit(1)), **(measures or {})}
    distinct = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(*[expr.alias(name) for name, expr in sums.items()])
    )
    sliced = distinct.repartitionByRange(*group, value).withColumn("_slice", F.spark_partition_id())
    values = stage(sliced, "ordered-values")

    inside = Window.partitionBy(*group, "_slice").orderBy(value)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = values.withColumns({
        "_position": F.row_number().over(inside).cast("bigint") - 1,
        **{f"_upto_{c}": F.sum(c).over(running) for c in sums},
    })

    # One row per group and slice: at most slices + groups rows, so both the
    # window over them and the broadcast stay small at any data size.
    slices = values.groupBy(*group, "_slice").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{c}") for c in sums])
    # Without a group this window has one partition, of one row per slice.
    earlier = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))) \
        .orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        *group, "_slice",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums])

    return local.join(F.broadcast(offsets), [*group, "_slice"]).select(
        *group, value, *sums,
        (F.col("_position") + F.col("_rows_before")).alias("position"),
        *[(F.col(f"_upto_{c}") - F.col(c) + F.col(f"_before_{c}")).alias(f"before_{c}") for c in sums])
