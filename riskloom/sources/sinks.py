"""Writing tables and scores. Models are written by ``operators.models``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

SCORE_COLUMNS = ("EID", "FORTARGET1", "FORTARGET2")


def write_tables(tables: Mapping[str, DataFrame], root: str) -> None:
    """One-time ingest: raw tables to Parquet.

    ``split`` stays an ordinary column. Every join of the feature plan has it
    in its key, and as a folder name it would make the planner nest one pruning
    subquery per join. Each file still holds one split, so its statistics
    prune a filter on ``split`` all the same.
    """
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def write_features(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """The feature table, as Parquet (for the next step) or CSV with header."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.partitionBy("split").parquet(path)


def write_scores(df: DataFrame, path: str, key: str = "qymc") -> None:
    """The result: ``EID, FORTARGET1, FORTARGET2`` as CSV with header."""
    renamed = df.withColumnRenamed(key, "EID")
    renamed.select(*SCORE_COLUMNS).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
