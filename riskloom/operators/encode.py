"""Category codes and target encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, functions as F

from riskloom.operators.joins import attach, lookup, with_key
from riskloom.operators.ordering import ordered_values
from riskloom.session import stage

# A column's dictionary is broadcast only if its measured size stays below this.
BROADCAST_BYTES = 8 * 1024 * 1024
# So many bytes of dictionaries are broadcast in one plan.
BROADCAST_TOTAL = 4 * BROADCAST_BYTES
# Dictionaries of at most this size together travel with the tasks.
INLINE_BYTES = 512 * 1024


def melt(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per input row and named column: ``keep``, ``column``, ``value`` (text)."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(*keep, F.inline(cells))


def ordinal_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, code, n)``: 0-based code-point order of the distinct values.

    All columns share one pass and one ordering. The table is staged by column,
    so that reading one column's dictionary reads only its own files.
    """
    values = ordered_values(melt(df, [], columns), ["column"], "value")
    return stage(values.select("column", "value", F.col("position").alias("code"), "n"),
                 "ordinal-dictionary", partition_by=("column",))


def _encode_inline(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], suffix: str) -> DataFrame:
    """Codes of columns whose whole dictionaries are small: looked up within the row, without a join.

    The indexer gives values it does not know the number after the last; as in
    the joined forms they have no code.
    """
    rows = dictionary.filter(F.col("column").isin(*columns)).select("column", "value", "code").collect()
    labels: dict[str, list[str]] = {c: [] for c in columns}
    for row in sorted(rows, key=lambda r: r["code"]):
        labels[row["column"]].append(row["value"])
    known = [c for c in columns if labels[c]]
    texts = df.withColumns({f"_text_{c}": F.col(c).cast("string") for c in known})
    indexed = StringIndexerModel.from_arrays_of_labels(
        [labels[c] for c in known], inputCols=[f"_text_{c}" for c in known],
        outputCols=[f"_code_{c}" for c in known], handleInvalid="keep").transform(texts) if known else texts
    code = {c: F.when(F.col(c).isNotNull() & (F.col(f"_code_{c}") < len(labels[c])), F.col(f"_code_{c}").cast("bigint")) if c in known
            else F.lit(None).cast("bigint") for c in columns}
    return indexed.select(*df.columns, *[code[c].alias(c + suffix) for c in columns])


def ordinal_encode(df: DataFrame, columns: Sequence[str], key: Sequence[str],
                   dictionary: DataFrame | None = None, suffix: str = "_encoder",
                   broadcast_bytes: int = BROADCAST_BYTES, inline_bytes: int = INLINE_BYTES,
                   broadcast_total: int = BROADCAST_TOTAL) -> DataFrame:
    """Add ``<column>_encoder`` for every named column; null and values missing in the dictionary have no code.

    ``df`` holds train and test together, one row per ``key``, so the codes are
    common. The bytes of each dictionary are measured. The smallest ones, up to
    ``inline_bytes`` together, are looked up within the row; those of at most
    ``broadcast_bytes`` each and ``broadcast_total`` together are broadcast;
    neither needs a shuffle. All the others together cost one melted, skew-safe lookup and one join back,
    however many columns there are.
    """
    dictionary = ordinal_dictionary(df, columns) if dictionary is None else dictionary
    sizes = (
        dictionary.groupBy("column")
        .agg((F.sum(F.octet_length("value")) + 64 * F.count(F.lit(1))).alias("bytes"))
        .collect()  # one row per encoded column
    )
    size_of = {row["column"]: row["bytes"] for row in sizes}
    inline, small, large, total = [], [], [], 0
    for name in sorted(columns, key=lambda c: size_of.get(c, 0)):
        size = size_of.get(name, 0)
        total += size
        if size > broadcast_bytes or total > inline_bytes + broadcast_total:
            large.append(name)
        else:
            (small if total > inline_bytes else inline).append(name)

    encoded = _encode_inline(df, dictionary, inline, suffix) if inline else df
    for name in small:
        codes = dictionary.filter(F.col("column") == name).select(
            F.col("value").alias("_value"), F.col("code").alias(name + suffix))
        encoded = encoded.join(F.broadcast(codes), F.col(name).cast("string") == F.col("_value"), "left").drop("_value")
    if large:
        cells = melt(df, key, large).filter("value IS NOT NULL")
        coded = lookup(cells, dictionary, ["column", "value"], spread_by=[*key, "column"], weight="n", how="inner")
        wide = coded.groupBy(*key).agg(*[
            F.max(F.when(F.col("column") == name, F.col("code"))).alias(name + suffix) for name in large])
        encoded = attach(encoded, [wide], key)
    return encoded.select(*df.columns, *[c + suffix for c in columns])


def out_of_fold_rate(df: DataFrame, key: Sequence[str], category: str, label: str, fold: str,
                     name: str) -> DataFrame:
    """Mean label of the row's category over the *other* folds.

    Null when the category occurs in no other fold. The input is reduced to
    one row per category and fold before anything is joined.
    """
    cells = (
        df.filter(F.col(category).isNotNull())
        .groupBy(category, fold)
        .agg(F.sum(label).alias("_hits"), F.count(label).alias("_labels"), F.count(F.lit(1)).alias("_n"))
    )
    totals = cells.groupBy(category).agg(F.sum("_hits").alias("_all_hits"), F.sum("_labels").alias("_all_labels"))
    rest = cells.join(totals, category).select(
        category, fold, "_n",
        F.try_divide(F.col("_all_hits") - F.coalesce("_hits", F.lit(0)),
                     F.col("_all_labels") - F.col("_labels")).alias(name))
    return lookup(df, stage(rest, "category-rates"), [category, fold], spread_by=key, weight="_n")


def category_code_stats(df: DataFrame, key: Sequence[str], column: str, prefix: str) -> DataFrame:
    """Max, min, mean and sample deviation of a text column's ordinal codes per key.

    Rows are reduced to one per key and value before the codes are looked up,
    and the statistics are put together from the counts. The reduced rows are
    written, so that looking for hot values does not count again.
    """
    codes = ordinal_dictionary(df, [column])
    cells = stage(with_key(df, [*key, column]).groupBy(*key, F.col(column).cast("string").alias("value"))
                  .agg(F.count(F.lit(1)).alias("_times")), "code-cells")
    coded = lookup(cells, codes.select("value", "code"), ["value"], spread_by=key, how="inner")
    code, times = F.col("code"), F.col("_times")
    sums = coded.groupBy(*key).agg(
        F.max(code).alias(f"{prefix}_max"), F.min(code).alias(f"{prefix}_min"),
        F.sum(times).alias("_n"), F.sum(code.cast("decimal(12,0)") * times.cast("decimal(13,0)")).alias("_s"),
        F.sum((code.cast("decimal(12,0)") * code.cast("decimal(12,0)") * times.cast("decimal(13,0)")).cast("decimal(38,0)")).alias("_q"))
    n = F.col("_n").cast("double")
    # n * sum(x^2) - (sum x)^2 is exact in integers, so nothing cancels; beyond 38 digits doubles must do.
    q, s, count = (F.col(c).cast("decimal(38,0)") for c in ("_q", "_s", "_n"))
    exact = F.try_subtract(F.try_multiply(q, count), F.try_multiply(s, s)).cast("double")
    spread = F.coalesce(exact, F.greatest(F.lit(0.0), q.cast("double") * n - s.cast("double") * s.cast("double")))
    return sums.select(
        *key, f"{prefix}_max", f"{prefix}_min",
        (F.col("_s").cast("double") / n).alias(f"{prefix}_mean"),
        F.sqrt(F.try_divide(spread, n * (n - 1))).alias(f"{prefix}_std"))
