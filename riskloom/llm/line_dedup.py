"""Repeated passages of lines, found by overlapping three-line windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.texts import bound
from riskloom.session import stage

#: Consecutive lines of a window.
WINDOW = 3


def line_windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``(_a, _b, _row, pos)``: a 128-bit hash of each run of ``width`` lines and where it starts.

    Lines are hashed once, windows are hashes of ``width`` neighbouring hashes.
    """
    lines = F.split("text", "\n")
    hashed = docs.select("_row", F.transform(lines, lambda line: F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"))).alias("_h")).filter(F.size("_h") >= width)
    starts = F.sequence(F.lit(0), F.size("_h") - width)
    windows = F.transform(starts, lambda i: F.struct(
        F.xxhash64(*(F.get("_h", i + k)["a"] for k in range(width))).alias("_a"),
        F.xxhash64(*(F.get("_h", i + k)["b"] for k in range(width))).alias("_b"),
        i.cast("long").alias("pos")))
    return hashed.select("_row", F.explode(windows).alias("w")).select("_row", "w._a", "w._b", "w.pos")


def later_windows(windows: DataFrame) -> DataFrame:
    """``(_row, pos)`` of every occurrence but the first, by document and place.

    Counting combines in the map tasks, so a window that a third of all
    documents share arrives as one row a task. Only repeated windows enter the
    join; their rows are unique on the key, so adaptive execution can split a
    hot one.
    """
    repeated = windows.groupBy("_a", "_b").agg(
        F.min(F.struct("_row", "pos")).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1") \
        .select("_a", "_b", "first")
    return windows.join(repeated, ["_a", "_b"]).filter(F.struct("_row", "pos") != F.col("first")).select("_row", "pos")


def without_runs(lines: Column, starts: Column, width: int = WINDOW) -> Column:
    """The lines outside all windows that begin at ``starts`` (ascending, distinct).

    Windows that touch are merged into runs first; the lines between the runs
    are slices. Every array is computed once, so time is linear in lines and starts.
    """
    def begins(found: Column) -> Column:
        return F.filter(found, lambda s, i: (i == 0) | (s > F.get(found, i - 1) + width))

    def ends(found: Column) -> Column:
        last = F.filter(found, lambda s, i: (i == F.size(found) - 1) | (F.get(found, i + 1) > s + width))
        return F.transform(last, lambda s: s + width)

    def between(every: Column, first: Column, behind: Column) -> Column:
        gaps = F.transform(F.sequence(F.lit(0), F.size(first)), lambda j: F.struct(
            F.coalesce(F.when(j > 0, F.get(behind, j - 1)), F.lit(0)).alias("start"),
            F.coalesce(F.get(first, j), F.size(every)).alias("stop")))
        return F.flatten(F.transform(gaps, lambda g: F.slice(every, (g["start"] + 1).cast("int"),
                                                              (g["stop"] - g["start"]).cast("int"))))

    return bound(lines, lambda every: bound(starts, lambda found: bound(begins(found), lambda first: bound(
        ends(found), lambda behind: between(every, first, behind)))))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """``doc_id, text, n_lines, n_removed`` of every row, without passages that occurred before.

    A line goes if any window of ``width`` consecutive lines that covers it is
    not the first of its kind, in the order of id, then text hash, then place.
    Lines are compared exactly and split at line feeds. Documents of fewer
    lines than a window stay as they are. A null text stays null with no
    lines; an empty one has one empty line. Rows repeated with id and text are
    one document and are treated alike; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) \
        .withColumn("_row", F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")))
    later = stage(later_windows(line_windows(rows.filter(F.col("text").isNotNull()), width)), "later-windows")
    covered = later.groupBy("_row").agg(F.sort_array(F.collect_set(F.col("pos").cast("int"))).alias("_starts")) \
        .withColumn("_id", F.col("_row.id")).withColumn("_hash", F.col("_row.hash")).drop("_row")
    keyed = rows.withColumn("_this", F.xxhash64("text"))
    joined = keyed.join(covered, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_this") == F.col("_hash")), "left")
    lines = F.split("text", "\n")
    kept = F.when(F.col("_starts").isNotNull(), without_runs(lines, F.col("_starts"), width))
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    return joined.withColumn("_kept", kept).select(
        "doc_id", F.when(F.col("_kept").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n")).alias("text"),
        n_lines.alias("n_lines"),
        F.when(F.col("_kept").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size("_kept")).cast("long").alias("n_removed"))
