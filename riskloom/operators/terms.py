"""Terms of a text column: frequencies, 0/1 indicators, word vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from riskloom.functions.text import tokenize
from riskloom.operators.word_vectors import Settings, train
from riskloom.session import delete_staged, staging_path

# Turns a text column into an array of terms.
Tokenizer = Callable[[Column], Column]

# Settings of the word-vector training.
VECTOR_SIZE = 10
WINDOW = 5
MIN_COUNT = 2
SEED = 0

# The least number of shares the texts are trained in, and the most terms of a text
# that form one context: fixed, so that the cluster does not change the vectors.
PARTITIONS = 8
SENTENCE = 1_000_000


def term_frequencies(df: DataFrame, text: Column, tokens: Tokenizer = tokenize) -> DataFrame:
    """``term, tf, df``: occurrences and texts of every term, in one grouping.

    A text's terms are sorted inside its row, so that the first of equal terms
    can be marked; tasks then add up occurrences and marks before the shuffle.
    """
    ordered = df.select(F.array_sort(tokens(text)).alias("_terms"))
    marked = F.transform("_terms", lambda term, i: F.struct(
        term.alias("term"),
        F.when((i > 0) & (F.get("_terms", i - 1) == term), 0).otherwise(1).alias("first")))
    return ordered.select(F.inline(marked)).groupBy("term").agg(
        F.count(F.lit(1)).alias("tf"), F.sum("first").alias("df"))


def top_terms(df: DataFrame, text: Column, k: int, tokens: Tokenizer = tokenize) -> DataFrame:
    """The ``k`` most frequent terms, ties by the term; the report is cut to ``k`` by design."""
    terms = df.select(F.explode(tokens(text)).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("tf")).orderBy(F.col("tf").desc(), "term").limit(k)


def term_indicators(df: DataFrame, keep: Sequence[str], text: Column, vocabulary: Sequence[str],
                    prefix: str = "has_", tokens: Tokenizer = tokenize) -> DataFrame:
    """One 0/1 column per vocabulary term; a missing text has none of them."""
    terms = df.select(*keep, tokens(text).alias("_terms"))
    return terms.select(*keep, *[
        F.when(F.array_contains("_terms", term), 1).otherwise(0).alias(f"{prefix}{i}")
        for i, term in enumerate(vocabulary)])


def term_vector(df: DataFrame, text: Column, vocabulary: Sequence[str], name: str, tokens: Tokenizer = tokenize) -> DataFrame:
    """The same indicators as one sparse ML vector, for linear models."""
    marked = df.withColumn("_terms", F.coalesce(tokens(text), F.array().cast("array<string>")))
    model = CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol="_terms", outputCol=name)
    return model.setBinary(True).transform(marked).drop("_terms")


def fit_word_vectors(df: DataFrame, text: Column, partitions: int = PARTITIONS, iterations: int = 5,
                     min_count: int = MIN_COUNT, tokens: Tokenizer = tokenize) -> WordVectors:
    """Train word vectors (skip-gram, hierarchical softmax) on every non-null text.

    Shares of the texts are trained on their own and the vectors averaged after each
    iteration: ``partitions`` shares, or more for a corpus of more terms than these can hold
    (``word_vectors.SHARE``). As many tasks as the cluster has cores, or more
    (``word_vectors.TASK``), train them and add up their vectors. One vector per
    word is kept on the driver: raise ``min_count`` for a corpus whose vocabulary does
    not fit there.
    """
    terms = df.filter(text.isNotNull()).select(tokens(text).alias("terms"))
    settings = Settings(VECTOR_SIZE, WINDOW, min_count, SEED, iterations, SENTENCE)
    vocabulary, vectors = train(terms, settings, partitions)
    return WordVectors(df.sparkSession, vocabulary, vectors, Word2Vec(
        vectorSize=VECTOR_SIZE, windowSize=WINDOW, minCount=min_count, seed=SEED, maxIter=iterations,
        numPartitions=partitions, maxSentenceLength=SENTENCE, inputCol="terms", outputCol="vector"))


class WordVectors:
    """Trained vectors: the words and a matrix. Whatever else is asked for is that of ``model``.

    A ``Word2VecModel`` takes several times the memory of the matrix on the driver, so it is made only when asked for.
    """

    def __init__(self, spark: SparkSession, vocabulary: pa.Array, vectors: np.ndarray, like: Word2Vec):
        self.spark, self.vocabulary, self.vectors, self.like = spark, vocabulary, vectors, like

    @cached_property
    def model(self) -> Word2VecModel:
        return _as_model(self.spark, self.vocabulary, self.vectors, self.like)

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        return getattr(self.model, name)

    def means(self, df: DataFrame, terms: str, name: str) -> DataFrame:
        """``df`` with the mean vector of an array of terms in its place, as ``Word2VecModel.transform`` has it."""
        others = [i for i, column in enumerate(df.columns) if column != terms]
        names = [*(df.columns[i] for i in others), name]
        schema = StructType([*(df.schema[i] for i in others), StructField(name, ArrayType(DoubleType()))])
        at = df.columns.index(terms)
        shared = self.spark.sparkContext.broadcast((self.vocabulary, self.vectors))

        def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary, vectors = shared.value
            for batch in batches:
                lists = batch.column(at)
                lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                found = pc.index_in(lists.flatten(), value_set=vocabulary)
                text = np.repeat(np.arange(len(lengths)), lengths)[found.is_valid().to_numpy(zero_copy_only=False)]
                ids = found.drop_null().to_numpy()
                sums = np.stack([np.bincount(text, column[ids], len(lengths)) for column in vectors.T], 1)
                sums *= (1 / np.maximum(lengths, 1))[:, None]
                ends = np.arange(len(lengths) + 1) * sums.shape[1]
                means = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sums.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in others), means], names)

        return df.mapInArrow(mean, schema)


def _as_model(spark: SparkSession, vocabulary: pa.Array, vectors: np.ndarray, like: Word2Vec) -> Word2VecModel:
    """The vectors as an ordinary Spark model: a saved model of one word, whose table of vectors is replaced."""
    path = staging_path(spark, "word-vectors")
    word = spark.range(1).select(F.array_repeat(F.lit("word"), like.getMinCount()).alias("terms"))
    like.fit(word, {like.maxIter: 1, like.numPartitions: 1}).write().save(path)
    table = pa.table({"word": vocabulary, "vector": pa.FixedSizeListArray.from_arrays(
        pa.array(vectors.ravel()), vectors.shape[1]).cast(pa.list_(pa.float32()))})
    spark.createDataFrame(table).write.mode("overwrite").parquet(f"{path}/data")
    model = Word2VecModel.load(path)  # reads all of it
    delete_staged(spark, path)
    return model


def document_vectors(df: DataFrame, model: WordVectors | Word2VecModel, text: Column, names: Sequence[str],
                     tokens: Tokenizer = tokenize) -> DataFrame:
    """Mean word vector of each text as scalar columns; no text gives zeros.

    Unknown words count as zero vectors: the sum is divided by all terms.
    """
    marked = df.withColumn("_terms", F.coalesce(tokens(text), F.array().cast("array<string>")))
    if isinstance(model, WordVectors):
        arrays = model.means(marked, "_terms", "_array")
    else:
        model = model.copy().setInputCol("_terms").setOutputCol("_vector")
        arrays = model.transform(marked).withColumn("_array", vector_to_array("_vector"))
    return arrays.withColumns({n: F.get("_array", F.lit(i)) for i, n in enumerate(names)}).drop(
        "_terms", "_vector", "_array")
