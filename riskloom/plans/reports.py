"""Reports on the raw tables: coverage, overlap with the targets, target rates, column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.text import prefix
from riskloom.operators.joins import with_key
from riskloom.operators.profile import (
    class_balance, key_overlap, profile_columns, same_meaning, table_coverage, target_rate, uninformative)
from riskloom.plans.features import KEY, TOPICS, build_spine, label
from riskloom.plans.scoring import PROVINCE

# Categories whose target rates the report shows, by table.
RATED = {
    "infringement": ("xzcfdzlhyj",), "inspection": ("njnd",), "tax": ("shdw",), "registration": ("sshymc",),
    "licence": ("sjly", "cjrID", "xxtgbmbm", "splb", "dfbm", "xkjg"),
}

# Columns that name the same thing once as a code and once in words.
CODE_AND_NAME = {"abnormal": (("xxtgbmbm", "xxtgbmmc"),), "tax": (("xxtgbmbm", "xxtgbmmc"),)}


def labelled_spine(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Enterprises with both targets; by membership in the lists of their own split."""
    return label(build_spine(tables["base"]), tables["dishonest"], tables["punished"])


def coverage(tables: Mapping[str, DataFrame], split: str = "train") -> DataFrame:
    """How many enterprises of a split each table knows."""
    side = {name: df.filter(F.col("split") == split) for name, df in tables.items() if name != "base"}
    return table_coverage(tables["base"].filter(F.col("split") == split), side, ["qymc"])


def overlap_with_targets(tables: Mapping[str, DataFrame], split: str = "train") -> DataFrame:
    """Per table, how many of its enterprises are in each label list, and in the list and the province."""
    side = {name: df.filter(F.col("split") == split) for name, df in tables.items()}
    first = build_spine(tables["base"]).filter(F.col("split") == split)
    side["province"] = first.filter(F.col("zsszdsf") == PROVINCE)
    topics = ["branch", "registration", *TOPICS]
    combinations: list[Sequence[str]] = [(t, target) for t in topics for target in ("dishonest", "punished")]
    combinations += [("province", t) for t in topics]
    combinations += [("province", "registration", "dishonest"), ("province", "registration", "punished", "tax")]
    return key_overlap(side, ["qymc"], combinations)


def target_rates(tables: Mapping[str, DataFrame], target: str = "is_shixin") -> DataFrame:
    """``table_name, category, value`` with the mean and sum of a target and the row count."""
    spine = labelled_spine(tables)
    reports = []
    for name, columns in RATED.items():
        for column in columns:
            if column in tables[name].columns:
                detail = tables[name].select(*KEY, F.col(column).cast("string").alias("value"))
                reports.append(target_rate(with_key(detail, KEY), spine, KEY, ["value"], target).select(
                    F.lit(name).alias("table_name"), F.lit(column).alias("category"), "value",
                    f"{target}_mean", f"{target}_sum", "n_rows"))
    return reduce(DataFrame.unionByName, reports)


def balance(tables: Mapping[str, DataFrame], target: str = "is_shixin") -> DataFrame:
    """Enterprises per split, province and class."""
    return class_balance(labelled_spine(tables), ["split", "zsszdsf"], target)


def branch_names(tables: Mapping[str, DataFrame], start: str) -> DataFrame:
    """Branches whose name begins with ``start``."""
    return tables["branch"].filter(prefix(F.col("fzqymc"), len(start)) == start)


def profile(tables: Mapping[str, DataFrame], name: str, approx: bool = False) -> DataFrame:
    """Column profile of one raw table, without the order columns."""
    df = tables[name]
    return profile_columns(df, [c for c in df.columns if not c.startswith("_")], approx)


def columns_to_drop(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Mostly empty, single-valued and doubly named columns of a raw table."""
    report = uninformative(profile(tables, name)).select("column", "reason")
    pairs = [p for p in CODE_AND_NAME.get(name, ()) if set(p) <= set(tables[name].columns)]
    if pairs:
        doubles = same_meaning(tables[name], pairs).filter("is_same = 1").select(
            F.col("left").alias("column"), F.lit("same meaning").alias("reason"))
        report = report.unionByName(doubles)
    return report
