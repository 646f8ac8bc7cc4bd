"""CSV files with quoted line breaks, read by many tasks.

A line alone does not tell whether it begins inside a quoted cell. But it tells
where it ends for either case, and these small functions of lines compose: first
within a block of a file, then over its blocks. With the state at its
beginning known, every block is read on its own; only blocks that hold a
broken cell are sorted, and only their lines are put together again.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.session import stage

# The inside of a quoted cell, and a complete cell with the comma behind it. A quote opens a cell only at its
# beginning. Repeats are possessive: they take no place on the matcher's stack.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CELLS = f'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?+,)*+'
#: Lines that end inside a quoted cell: of those that begin outside of one, and of those that begin inside.
ENDS_INSIDE_FROM_OUTSIDE = f'^{_CELLS}"{_INSIDE}$'
ENDS_INSIDE_FROM_INSIDE = f'^{_INSIDE}(?:$|"[^,]*+,{_CELLS}"{_INSIDE}$)'

_PLACE = ["_file", "_block"]
OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Every line with its place and where it ends, ``_out`` if it begins outside and ``_in`` if inside of a cell."""
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        F.col("value").rlike(ENDS_INSIDE_FROM_OUTSIDE).alias("_out"), F.col("value").rlike(ENDS_INSIDE_FROM_INSIDE).alias("_in"))


def _composed(df: DataFrame, window, out: str, inside: str) -> DataFrame:
    """Add ``_then_out`` and ``_then_in``: the functions of all rows of the window, one after the other.

    A row keeps the state, turns it round, or sets it. What counts is the last row that sets it, and the
    turns behind that.
    """
    turns = F.sum(((F.col(out)) & ~F.col(inside)).cast("int"))
    upto = df.withColumn("_turns", turns.over(window.rowsBetween(Window.unboundedPreceding, 0)))
    setting = F.when(F.col(out) == F.col(inside), F.struct(F.col(out).cast("int").alias("to"), F.col("_turns").alias("at")))
    marked = upto.withColumn("_set", F.last(setting, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)))

    def state(begin: int) -> Column:
        value = F.when(F.col("_set").isNotNull(), F.col("_set.to") + F.col("_turns") - F.col("_set.at")).otherwise(
            F.lit(begin) + F.col("_turns"))
        return value % 2 == 1

    return marked.withColumns({"_then_out": state(0), "_then_in": state(1)}).drop("_turns", "_set")


def csv_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``_file, _block, _row, record, first``: each record as one text; ``first`` marks the first one of a file.

    Place and row are those of a record's first line, so they follow file order. Blank records are left out.
    A quote that is never closed makes one record of the rest of its file, as it does for any reader.
    """
    lines = _lines(spark, paths)
    odd = lines.filter(F.col("_out") | ~F.col("_in")).select(*_PLACE, "_row", "_out", "_in")
    in_block = Window.partitionBy(*_PLACE).orderBy("_row")
    ends = _composed(odd, in_block, "_out", "_in").groupBy(*_PLACE).agg(
        F.max_by("_then_out", "_row").alias("end_out"), F.max_by("_then_in", "_row").alias("end_in"))
    blocks = lines.groupBy(*_PLACE).agg(F.min("_row").alias("first_row")).join(ends, _PLACE, "left") \
        .withColumns({"odd": F.col("end_out").isNotNull(), "end_out": F.coalesce("end_out", F.lit(False)),
                      "end_in": F.coalesce("end_in", F.lit(True))})
    # One row per block of a file.
    by_file = Window.partitionBy("_file").orderBy("_block")
    known = _composed(blocks, by_file, "end_out", "end_in")
    inside = F.coalesce(F.lag("_then_out").over(by_file), F.lit(False))
    blocks = stage(known.withColumn("inside", inside).select(*_PLACE, "first_row", "odd", "inside"), "csv-blocks")

    whole = blocks.filter(~F.col("odd") & ~F.col("inside")).select(*_PLACE, "first_row")
    plain = lines.select(*_PLACE, "_row", "value").join(whole, _PLACE).select(
        *_PLACE, "_row", F.col("value").alias("record"), ((F.col("_block") == 0) & (F.col("_row") == F.col("first_row"))).alias("first"))

    cut = lines.join(blocks.filter("odd OR inside").select(*_PLACE, "inside"), _PLACE)
    states = _composed(cut, in_block, "_out", "_in").withColumn(
        "_after", F.when(F.col("inside"), F.col("_then_in")).otherwise(F.col("_then_out")))
    begins = ~F.coalesce(F.lag("_after").over(in_block), F.col("inside"))
    numbered = states.withColumn("_begins", begins).withColumn(
        "_nth", F.sum(F.col("_begins").cast("int")).over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
    numbered = stage(numbered.select(*_PLACE, "_row", "value", "_nth"), "csv-cut-blocks")
    # Lines before the first record of a block go on with the last one begun in a block before.
    begun = numbered.groupBy(*_PLACE).agg(F.max("_nth").alias("last"))
    earlier = F.last(F.when(F.col("last") > 0, F.struct(F.col("_block").alias("block"), F.col("last").alias("nth"))), ignorenulls=True) \
        .over(by_file.rowsBetween(Window.unboundedPreceding, -1))
    begun = begun.withColumn("open", earlier).select(*_PLACE, "open")
    goes_on = F.col("_nth") == 0
    joined = numbered.join(begun, _PLACE).select(
        "_file", F.when(goes_on, F.col("open.block")).otherwise(F.col("_block")).alias("_of"),
        F.when(goes_on, F.col("open.nth")).otherwise(F.col("_nth")).alias("_nth"),
        F.struct("_block", "_row", "value").alias("line"))
    together = joined.groupBy("_file", "_of", "_nth").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    broken = together.select(
        "_file", F.col("_of").alias("_block"), F.col("lines")[0]["_row"].alias("_row"),
        F.array_join(F.col("lines.value"), "\n").alias("record"), ((F.col("_of") == 0) & (F.col("_nth") == 1)).alias("first"))
    broken = broken.sortWithinPartitions("_file", "_block", "_row")
    # Where a carriage return belongs to the end of a record, it belongs to its other line breaks too.
    record = F.when(F.col("record").endswith("\r"), F.regexp_replace(F.regexp_replace("record", "\r$", ""), "\r\n", "\n")) \
        .otherwise(F.col("record"))
    return plain.unionByName(broken).withColumn("record", record).filter((F.trim("record") != "") | F.col("first"))


def _names(record: str) -> list[str]:
    """Column names of a header, as Spark gives them: numbered where empty or repeated."""
    cells = next(csv.reader([record.removeprefix("﻿")], strict=False), [])
    lowered = [c.lower() for c in cells]
    return [f"_c{at}" if not c else f"{c}{at}" if lowered.count(c.lower()) > 1 else c for at, c in enumerate(cells)]


def read_broken_csv(spark: SparkSession, paths: str | Sequence[str], header: bool, schema: str | None = None) -> DataFrame:
    """The columns of CSV files with quoted line breaks, and ``_file, _block, _row``.

    Without a ``schema`` all columns are texts, named by the header of the first file (by path) or by number.
    """
    records = csv_records(spark, paths)
    if schema is None:
        first = records.filter("first").orderBy("_file").select("record").head()
        names = _names(first["record"]) if first else []
        names = names if header else [f"_c{at}" for at in range(len(names))]
        schema = ", ".join("`" + name.replace("`", "``") + "` string" for name in names)
        if not names:
            return records.select(*_PLACE, "_row").limit(0)
    text = F.when(F.col("first"), F.regexp_replace("record", "^﻿", "")).otherwise(F.col("record"))
    kept = records.filter(~F.col("first")) if header else records.withColumn("record", text).filter(F.trim("record") != "")
    return kept.select(F.from_csv("record", schema, OPTIONS).alias("_cells"), *_PLACE, "_row").select("_cells.*", *_PLACE, "_row")
