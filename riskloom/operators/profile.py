"""Reports on tables: columns, coverage, overlap, target rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.operators.encode import melt
from riskloom.operators.joins import attach, distinct_keys, lookup, with_key
from riskloom.session import stage


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """``column, type, n_rows, n_present, n_distinct``, one row per column, of an empty table too.

    The exact form reduces ``(column, value)`` pairs in the map tasks and
    shuffles only distinct pairs; ``approx`` shuffles sketches alone.
    """
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    cells = melt(df, [], columns)
    if approx:
        profile = cells.groupBy("column").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_present"),
            F.approx_count_distinct("value").alias("n_distinct"))
    else:
        profile = (
            cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("column").agg(
                F.sum("n").alias("n_rows"),
                F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("n_present"),
                F.count("value").alias("n_distinct"))
        )
    named = df.sparkSession.createDataFrame([(c, types[c]) for c in columns], "column string, type string")
    none = F.lit(0).cast("bigint")
    return named.join(profile, "column", "left").select("column", "type", *[
        F.coalesce(n, none).alias(n) for n in ("n_rows", "n_present", "n_distinct")])


def uninformative(profile: DataFrame, max_null_share: float = 0.9) -> DataFrame:
    """Profile rows with the reason a column should go: ``sparse`` or ``constant``."""
    null_share = 1 - F.try_divide(F.col("n_present"), F.col("n_rows"))
    reason = F.when(null_share > max_null_share, "sparse").when(F.col("n_distinct") <= 1, "constant")
    return profile.withColumn("reason", reason).filter("reason IS NOT NULL")


def drop_uninformative(df: DataFrame, keep: Sequence[str] = (), max_null_share: float = 0.9) -> DataFrame:
    """Drop mostly empty and single-valued columns; the report has a row per column."""
    report = uninformative(profile_columns(df), max_null_share).select("column").collect()
    return df.drop(*[row["column"] for row in report if row["column"] not in set(keep)])


def same_meaning(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``left, right, is_same``: 1 when two columns name each other one to one."""
    names = [F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"),
                      F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")) for a, b in pairs]
    values = df.select(F.inline(F.array(*names))).filter("a IS NOT NULL AND b IS NOT NULL").distinct()
    counts = values.groupBy("left", "right").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("n_a"), F.count_distinct("b").alias("n_b"))
    same = (F.col("n") == F.col("n_a")) & (F.col("n") == F.col("n_b"))
    return counts.select("left", "right", F.when(same, 1).otherwise(0).alias("is_same"))


def discover_same_meaning(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``left, right``: all pairs of columns that name each other one to one, nulls included, left before right.

    Two such columns part the rows into the same groups. Each row gets a hash, each group of equal values the
    sum of its rows' hashes, and each column a sum over its groups, in whatever order: one pass over the melted
    table, combined in the map tasks, for any number of columns. Only columns with equal sums, one row each, are
    compared on their values. Columns of a single value are left out: they say nothing. An empty table has no pairs.
    """
    columns = list(columns or df.columns)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))
    groups = df.select(row.alias("row"), cells.alias("cell")).groupBy("cell.column", "cell.value").agg(
        F.sum("row").alias("sum"), F.count(F.lit(1)).alias("n"))
    mark = F.xxhash64(F.col("sum").cast("string"), "n").cast("decimal(38,0)")
    signatures = groups.groupBy("column").agg(F.sum(mark).alias("sum"), F.count(F.lit(1)).alias("n_groups")) \
        .filter("n_groups > 1").collect()  # a row for each column
    alike: dict[tuple, list[str]] = {}
    for signature in signatures:
        alike.setdefault((signature["sum"], signature["n_groups"]), []).append(signature["column"])
    known = []
    for names in alike.values():
        for other in names[1:]:
            # One pair for each further column of a set: being one to one carries over.
            pairs = df.select(F.struct(F.col(f"`{names[0]}`")).alias("a"), F.struct(F.col(f"`{other}`")).alias("b")).distinct()
            found = pairs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b")).head()
            if found["n"] == found["a"] == found["b"]:
                known.append((names[0], other))
    joined: dict[str, list[str]] = {}
    for first, other in known:
        joined.setdefault(first, [first]).append(other)
    out = [tuple(sorted(pair)) for names in joined.values() for pair in combinations(names, 2)]
    return df.sparkSession.createDataFrame(sorted(out), "left string, right string")


def _presence(tables: Mapping[str, DataFrame], key: Sequence[str]) -> DataFrame:
    """One row per key with one 0/1 column per table it occurs in."""
    tagged = [with_key(df, key).select(*key, F.lit(name).alias("_table")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy(*key).agg(*[
        F.max(F.when(F.col("_table") == name, 1).otherwise(0)).alias(name) for name in tables])


def key_overlap(tables: Mapping[str, DataFrame], key: Sequence[str],
                combinations: Sequence[Sequence[str]]) -> DataFrame:
    """``combination, n_keys``: distinct keys present in all tables of a combination.

    One shuffle of keys serves any number of two-, three- or four-way overlaps.
    """
    names = ["&".join(c) for c in combinations]
    both = [F.count_if(reduce(Column.__and__, [F.col(t) == 1 for t in c])).alias(n)
            for c, n in zip(combinations, names)]
    row = _presence(tables, key).agg(*both)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("combination"), F.col(f"`{n}`").alias("n_keys")) for n in names])))


def table_coverage(spine: DataFrame, tables: Mapping[str, DataFrame], key: Sequence[str]) -> DataFrame:
    """``table_name, n_entities, share``: how many spine entities each table knows."""
    present = attach(distinct_keys(spine, key), [_presence(tables, key)], key)
    row = present.agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(F.col(t) == 1).alias(t) for t in tables])
    return row.select("_all", F.inline(F.array(*[
        F.struct(F.lit(t).alias("table_name"), F.col(t).alias("n_entities")) for t in tables]))
    ).select("table_name", "n_entities", F.try_divide("n_entities", "_all").alias("share"))


def target_rate(detail: DataFrame, labels: DataFrame, key: Sequence[str], category: Sequence[str],
                label: str) -> DataFrame:
    """``category, label_mean, label_sum, n_rows`` over the labelled detail rows.

    Detail rows are counted per key and category first, so the join sees one
    row per pair; the counts are written, so that looking for hot keys does not
    count again. A key with very many categories is looked up without moving
    its rows into one task. ``labels`` is unique on ``key``.
    Rows without a label count in ``n_rows`` and not in the mean.
    """
    cells = stage(with_key(detail, category).groupBy(*key, *category).agg(F.count(F.lit(1)).alias("_n")), "category-cells")
    labelled = lookup(cells, labels.select(*key, label), key, spread_by=[*key, *category])
    hits = F.sum(F.col(label) * F.col("_n"))
    known = F.sum(F.when(F.col(label).isNotNull(), F.col("_n")))
    return labelled.groupBy(*category).agg(
        F.try_divide(hits, known).alias(f"{label}_mean"), hits.alias(f"{label}_sum"), F.sum("_n").alias("n_rows"))


def class_balance(df: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """Rows per group and class."""
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column."""
    return df.select(column).distinct()
