"""Frequent terms of the text columns, condensed to one out-of-fold score per enterprise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.text import tokenize
from riskloom.operators.models import out_of_fold
from riskloom.operators.sampling import hash_fold
from riskloom.operators.terms import Tokenizer, term_vector, top_terms
from riskloom.plans.features import KEY
from riskloom.session import stage


def term_stacking(features: DataFrame, label: str, name: str, texts: Sequence[str] = ("jyfw", "jgdzzs"),
                  terms: int = 2000, folds: int = 5, tokens: Tokenizer = tokenize) -> DataFrame:
    """``split, qymc`` and the score of a linear model on 0/1 term features.

    All text columns count as one text. The vocabulary is the ``terms`` most
    frequent terms over train and test. A train row is scored by the model that
    did not see it, a test row by the mean of all models, so the score can be
    joined to the feature table and fed to the tree models.
    """
    rows = features.select(*KEY, label, F.concat_ws(" ", *texts).alias("_text"))
    vocabulary = [row["term"] for row in top_terms(rows, F.col("_text"), terms, tokens).collect()]  # at most `terms` rows
    vectors = stage(
        term_vector(rows, F.col("_text"), vocabulary, "features", tokens).drop("_text")
        .withColumn("_fold", hash_fold(["qymc"], folds, 2018)), "term-vectors")
    model = LogisticRegression(labelCol=label, regParam=0.01)
    held, scored = out_of_fold(model.fit, vectors.filter("split = 'train'"), vectors.filter("split = 'test'"), KEY,
                               "_fold", folds, name)
    return held.unionByName(scored)
