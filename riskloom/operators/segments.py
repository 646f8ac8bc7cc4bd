"""Words of unspaced text: a lexicon learned from counts, and the best path through it."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from riskloom.functions.text import HAN, SEPARATORS
from riskloom.session import stage

#: Characters of the longest word, and words of a lexicon that tasks get to know (the most frequent ones).
LONGEST, WORDS = 4, 200_000
#: How often a word occurs at least, how much more often than its parts would meet by chance (natural
#: logarithm), and how freely its neighbours change on either side (entropy).
LEAST, COHESION, FREEDOM = 5, 2.0, 0.8


def _grams(letters: Column, longest: int) -> Column:
    """Every piece of up to ``longest`` letters with the letters next to it; an edge has an empty neighbour."""
    def pieces(i: Column) -> Column:
        sizes = F.sequence(F.lit(1), F.least(F.lit(longest), F.size(letters) - i))
        return F.transform(sizes, lambda n: F.struct(
            F.array_join(F.slice(letters, i + 1, n), "").alias("word"), n.alias("size"),
            F.coalesce(F.when(i > 0, F.get(letters, i - 1)), F.lit("")).alias("left"),
            F.coalesce(F.get(letters, i + n), F.lit("")).alias("right")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(letters) - 1), pieces))


def _freedom(grams: DataFrame, side: str) -> DataFrame:
    """Entropy of the neighbours on one side; every edge of a text counts as a neighbour of its own."""
    each = grams.groupBy("word", side).agg(F.count(F.lit(1)).alias("c"))
    spread = F.when(F.col(side) == "", F.lit(0.0)).otherwise(F.col("c") * F.log("c"))
    return each.groupBy("word").agg((F.log(F.sum("c")) - F.sum(spread) / F.sum("c")).alias(f"{side}_freedom"))


def learn_lexicon(df: DataFrame, column: str, longest: int = LONGEST, least: int = LEAST, cohesion: float = COHESION,
                  freedom: float = FREEDOM, letters: str = f"[{HAN}]") -> DataFrame:
    """``word, n, cost, cohesion, left_freedom, right_freedom`` of the words of two to ``longest`` letters in a text column.

    A word is a piece of a run of ``letters`` that occurs ``least`` times, whose parts meet far more often than by
    chance at whatever place it is cut, and whose neighbours change on both sides. ``cost`` is the
    negative logarithm of its share of all letters. Single letters are listed too, whatever their figures, so that every text
    has a path. Counting combines in the map tasks; rare pieces go before anything is joined.
    Null and empty texts have no pieces; repeated texts count as often as they occur.
    """
    runs = df.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(f"{letters}+"), F.lit(0))).alias("run"))
    single = runs.select(F.filter(F.split("run", ""), lambda c: c != "").alias("letters"))
    grams = single.select(F.explode(_grams(F.col("letters"), longest)).alias("g")).select("g.*")
    counts = stage(grams.groupBy("word", "size").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") >= least) | (F.col("size") == 1)),
                   "gram-counts")
    total = counts.filter("size = 1").agg(F.sum("n")).head()[0] or 0
    frequent = grams.filter("size > 1").join(counts.filter("size > 1").select("word"), "word", "left_semi")
    # Every part of a frequent piece is frequent, so the joins below lose none.
    cuts = counts.filter("size > 1").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "word", "n", F.substr("word", F.lit(1), F.col("cut")).alias("a"), F.substr("word", F.col("cut") + 1).alias("b"))
    parts = counts.select("word", "n")
    chance = cuts.join(parts.toDF("a", "n_a"), "a").join(parts.toDF("b", "n_b"), "b").groupBy("word").agg(
        F.min(F.log(F.col("n") * F.lit(float(total)) / (F.col("n_a") * F.col("n_b")))).alias("cohesion"))
    known = counts.filter("size > 1").select("word", "n").join(chance, "word") \
        .join(_freedom(frequent, "left"), "word").join(_freedom(frequent, "right"), "word") \
        .filter((F.col("cohesion") >= cohesion) & (F.least("left_freedom", "right_freedom") >= freedom))
    ones = counts.filter("size = 1").select("word", "n")
    return known.unionByName(ones, allowMissingColumns=True).select(
        "word", "n", (-F.log(F.col("n") / F.lit(float(total)))).alias("cost"), "cohesion", "left_freedom", "right_freedom")


def lexicon_costs(lexicon: DataFrame, words: int = WORDS) -> dict[str, float]:
    """``word -> cost`` of the ``words`` most frequent words (ties by word): the bounded table that tasks get to know."""
    chosen = lexicon.orderBy(F.col("n").desc(), "word").limit(words).select("word", "cost").collect()
    return {r["word"]: r["cost"] for r in chosen}


def best_path(text: str, costs: Mapping[str, float], longest: int, unknown: float) -> tuple[list[str], float]:
    """The cheapest words that make up the text, and their cost; of equal paths the one whose last word is longest.

    A letter that is no word costs ``unknown``. One pass over the text, ``longest`` steps a letter.
    """
    best, back = np.empty(len(text) + 1), np.zeros(len(text) + 1, np.int64)
    best[0] = 0
    get = costs.get
    for end in range(1, len(text) + 1):
        least, begin = None, end - 1
        for start in range(max(0, end - longest), end):
            cost = get(text[start:end], unknown if end - start == 1 else None)
            if cost is not None and (least is None or best[start] + cost < least):
                least, begin = best[start] + cost, start
        best[end], back[end] = least, begin
    out, end = [], len(text)
    while end:
        out.append(text[back[end]:end])
        end = int(back[end])
    return out[::-1], float(best[len(text)])


def with_best_path(df: DataFrame, column: str, costs: Mapping[str, float], words: str = "words", cost: str = "cost",
                   unknown: float | None = None) -> DataFrame:
    """``df`` with the words of a text column's best path, and its cost.

    Rows travel in Arrow batches, nothing is shuffled; the costs are sent to every executor once. ``unknown`` is the cost of a
    letter that is no word, by default twice that of the dearest one. A null text has neither words nor cost, an
    empty one has no words.
    """
    longest = max(map(len, costs), default=1)
    unknown = 2 * max(costs.values(), default=1.0) if unknown is None else unknown
    shared = df.sparkSession.sparkContext.broadcast(dict(costs))
    at = df.columns.index(column)
    schema = StructType([*df.schema.fields, StructField(words, ArrayType(StringType())), StructField(cost, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(None, None) if t is None else best_path(t, shared.value, longest, unknown) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.list_(pa.string())), pa.array([f[1] for f in found], pa.float64())],
                names=schema.names)

    return df.mapInArrow(run, schema)


def segment_tokens(df: DataFrame, column: str, costs: Mapping[str, float], name: str = "tokens", letters: str = f"[{HAN}]") -> DataFrame:
    """``df`` with the terms of a text: runs of ``letters`` cut by the best path, everything else between separators as it is.

    All runs of a text are cut in one go, parted by line breaks, which no run holds.
    """
    spaced = F.translate(F.col(column), SEPARATORS, " " * len(SEPARATORS))
    runs = F.regexp_extract_all(spaced, F.lit(f"{letters}+|[^ {letters[1:-1]}]+"), F.lit(0))
    is_run = f"^{letters}+$"
    columns = df.columns
    prepared = df.withColumn("_runs", runs).withColumn("_han", F.array_join(F.filter("_runs", lambda r: r.rlike(is_run)), "\n"))
    cut = with_best_path(prepared, "_han", {**costs, "\n": 0.0}, "_words", "_cost")
    # The words of run i of the Han runs stand between two line breaks.
    parts = F.split(F.array_join("_words", "\x00"), "\x00\n\x00")
    counted = F.transform(F.col("_runs"), lambda r, i: F.when(r.rlike(is_run), F.size(F.filter(
        F.slice("_runs", F.lit(1), i + 1), lambda q: q.rlike(is_run)))))
    terms = F.flatten(F.zip_with("_runs", "_nth", lambda run, nth: F.when(
        nth.isNull(), F.array(run)).otherwise(F.split(F.get("_parts", nth - 1), "\x00"))))
    return cut.withColumn("_parts", parts).withColumn("_nth", counted).withColumn(name, terms).select(*columns, name)
