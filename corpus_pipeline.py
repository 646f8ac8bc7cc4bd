"""From documents to packed training sequences, stage by stage.

Stages take and return the columns of documents, whatever others there are and whatever their names.
Null and empty texts, missing ids, repeated rows and an empty table have the results
that each stage states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import chosen_path, exact_dedup, language, packing, pii
from riskloom.llm.queries import TEST_KEY
from riskloom.llm.texts import fresh
from riskloom.session import stage

#: Below this score a text is in none of the learned languages.
LEAST_LANGUAGE_SCORE = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language; those without a letter or like none of the learned languages go.

    Null and empty texts have no letter. Rows are judged by their text alone, so repeated rows stay or go
    together. A table without any known language teaches nothing, and all its rows go.
    """
    model = language.fit_language_model(docs)
    return language.keep_determined(docs, model, LEAST_LANGUAGE_SCORE)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case) the row with the largest id stays.

    A null text equals an empty one. Rows without an id come after all others; of rows equal in id and text one stays.
    """
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that links of similarity 0.8 connect the one with the smallest id stays.

    Texts without words are linked to none. Rows without an id stay only where their class has no other; of two texts with the
    chosen id one stays, and rows equal to it in id and text stay with it.
    """
    return chosen_path.keep_one_of_each(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets pseudonyms; ``n_chars`` follows the text.

    Null and empty texts stay as they are, as does ``n_chars`` where the text stays. Rows do not depend on each other.
    The key is that of the session; only where it names none the key of the test tables is used.
    """
    before = fresh("before", docs.columns)
    done = pii.pseudonymise(docs.withColumn(before, F.col("text")), pii.configured_key(spark, TEST_KEY))
    length = F.when(F.col(before).eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.length("text"))
    return done.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences.

    Null and empty texts are one token long; repeated rows are packed as often as they occur.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_duplicates), ("ngram_jaccard_join", near_duplicates),
          ("pii", pseudonyms), ("packing", pack)]

#: SQL can express neither the language model nor the linear program.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
