"""Null handling, flags and array elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The in-band marker of the raw feature tables for "no value",
# and the text of a set flag.
MISSING = -1
YES = "是"


def not_null_flag(value: Column) -> Column:
    """1 when a value is present, else 0."""
    return F.when(value.isNotNull(), 1).otherwise(0)


def fill_missing(df: DataFrame, columns: list[str], value: int | float = MISSING) -> DataFrame:
    """Null to the marker, in the named columns, for the model boundary only."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(str(value) if kind == "string" else value).cast(kind))
        for name, kind in df.dtypes if name in set(columns)
    })


def array_to_columns(array: Column, names: list[str]) -> dict[str, Column]:
    """One scalar column per position; null beyond the end of the array."""
    return {name: F.get(array, F.lit(i)) for i, name in enumerate(names)}
