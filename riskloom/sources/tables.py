"""Reading raw and staged tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.operators.records import stack_sources
from riskloom.sources.broken_lines import read_broken_csv
from riskloom.sources.contracts import CONTRACTS, Contract

# The columns that stand for file order, most significant first.
ORDER = ("_source_rank", "_file", "_block", "_row")

# Cell texts that mean "no value" in the raw files.
NULL_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
              "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _csv(spark: SparkSession, multiline: bool):
    return spark.read.option("multiLine", multiline).option("quote", '"').option("escape", '"')


def _with_order(df: DataFrame) -> DataFrame:
    """Stamp each row with its place: file, block of the file, row of the block.

    The row number only orders rows of one block, and one block is read by one
    task from start to end, so the three columns follow file order however the
    files are split.
    """
    return df.withColumns({
        "_file": F.col("_metadata.file_path"),
        "_block": F.col("_metadata.file_block_start"),
        "_row": F.monotonically_increasing_id(),
    })


def _cell(name: str, kind: str):
    text = F.when(~F.col(f"`{name}`").isin(*NULL_TEXTS), F.col(f"`{name}`"))
    return text if kind == "string" else text.try_cast(kind)


def _files(spark: SparkSession, path: str) -> dict[str, tuple[bool, bool]]:
    """For each file with a line: whether some line has an odd number of quotes, and whether the file is split."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    files = spark.read.text(path).select(quotes.alias("quotes"), "_metadata.file_path", "_metadata.file_block_start") \
        .groupBy("file_path").agg(F.max(F.col("quotes") % 2 == 1).alias("broken"), F.max("file_block_start").alias("start"))
    return {row["file_path"]: (row["broken"], row["start"] > 0) for row in files.collect()}  # a row for each file


def files_with_line_breaks(spark: SparkSession, path: str) -> dict[str, bool]:
    """For each file with a line whether a quoted cell may run over a line break: some line has an odd number of quotes."""
    return {name: broken for name, (broken, _) in _files(spark, path).items()}


def _literal(uri: str) -> str:
    """A file's name as the readers take it, with signs of a pattern escaped."""
    return re.sub(r"([\[\]{}*?])", r"\\\1", unquote(uri))


def _per_file(spark: SparkSession, path: str, multiline: bool | None,
              read: Callable[[str | list[str], bool | None], DataFrame]) -> DataFrame:
    """``read(paths, multiline)`` of the files with line breaks and of all others, put together.

    Unless ``multiline`` says which have quoted line breaks, the lines are scanned first, in parallel. Files
    without any are read line by line. Of the others, those of a single split are one task in any case; ``read`` is
    told ``None`` for larger ones, whose blocks are read by a task each.
    """
    if multiline is not None:
        return read(path, multiline)
    kinds = {name: (None if split else True) if broken else False for name, (broken, split) in _files(spark, path).items()}
    if len(set(kinds.values())) < 2:
        return read(path, next(iter(kinds.values()), False))
    parts = [read(sorted(_literal(name) for name, kind in kinds.items() if kind is lines), lines)
             for lines in (False, True, None) if lines in kinds.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv(spark: SparkSession, path: str, contract: Contract, multiline: bool | None = None) -> DataFrame:
    """One raw file (or folder of files) under its contract.

    Columns are found by header, so their order in the file does not matter.
    Quoted line breaks are looked for, and large files that have some are read in parallel; ``multiline`` leaves
    them to Spark's own reader, which takes one task a file.
    """
    def read(paths: str | list[str], lines: bool | None) -> DataFrame:
        raw = read_broken_csv(spark, paths, True) if lines is None else _with_order(
            _csv(spark, lines).option("header", True).csv(paths))
        present = {name.lstrip("\ufeff"): name for name in raw.columns}
        if "企业名称" not in present:
            raise ValueError(f"{path}: no column 企业名称")
        kept = [(present[header], alias) for header, alias in contract.names.items() if header in present]
        return raw.select(
            *[_cell(name, "double" if alias in contract.numbers else "string").alias(alias) for name, alias in kept],
            "_file", "_block", "_row")

    return _per_file(spark, path, multiline, read)


def read_typed_csv(spark: SparkSession, path: str, schema: str, header: bool = True,
                   multiline: bool | None = None) -> DataFrame:
    """A CSV with a declared schema; nothing is inferred."""
    def read(paths: str | list[str], lines: bool | None) -> DataFrame:
        if lines is None:
            return read_broken_csv(spark, paths, header, schema).drop("_file", "_block", "_row")
        return _csv(spark, lines).option("header", header).schema(schema).csv(paths)

    return _per_file(spark, path, multiline, read)


def read_name_list(spark: SparkSession, path: str, name: str = "qymc", multiline: bool | None = None) -> DataFrame:
    """The first column of a headerless file, such as a bare list of names."""
    def read(paths: str | list[str], lines: bool | None) -> DataFrame:
        raw = read_broken_csv(spark, paths, False) if lines is None else _csv(spark, lines).option("header", False).csv(paths)
        return raw.select(_cell(raw.columns[0], "string").alias(name))

    return _per_file(spark, path, multiline, read)


def read_table(spark: SparkSession, root: str, contract: Contract, multiline: bool | None = None) -> DataFrame:
    """All rounds of a table: train and test in one frame, with ``split``,
    ``is_chusai`` (first round) and the order columns."""
    sides = []
    for split, folders in (("train", contract.train), ("test", contract.test)):
        if folders:
            parts = [(read_csv(spark, f"{root}/{folder}/{contract.file}.csv", contract, multiline), first)
                     for folder, first in folders]
            sides.append(stack_sources(parts, "is_chusai", "_source_rank").withColumn("split", F.lit(split)))
    table = sides[0]
    for side in sides[1:]:
        table = table.unionByName(side, allowMissingColumns=True)
    return table


def read_raw(spark: SparkSession, root: str, multiline: bool | None = None) -> dict[str, DataFrame]:
    """Every raw table below ``root``, by contract name."""
    return {name: read_table(spark, root, contract, multiline) for name, contract in CONTRACTS.items()}


def read_staged(spark: SparkSession, root: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The Parquet tables written by :func:`riskloom.sources.sinks.write_tables`."""
    return {name: spark.read.parquet(f"{root}/{name}") for name in (names or CONTRACTS)}


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Scores written by :func:`riskloom.sources.sinks.write_scores`."""
    return read_typed_csv(spark, path, "EID string, FORTARGET1 double, FORTARGET2 double", multiline=False)
