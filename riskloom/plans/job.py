"""The whole job, as a command.

    spark-submit --py-files riskloom.zip riskloom/plans/job.py ingest   <raw folder> <tables folder>
    spark-submit ...                                           features <tables folder> <features folder>
    spark-submit ...                                           score    <tables folder> <features folder> <scores folder>
"""

from __future__ import annotations

import sys

from riskloom.plans.features import build_features, text_vectors
from riskloom.plans.scoring import Settings, score_enterprises
from riskloom.operators.models import save_model
from riskloom.session import build_session, clear_staged
from riskloom.sources.sinks import write_features, write_scores, write_tables
from riskloom.sources.tables import read_raw, read_staged


def ingest(spark, raw: str, tables: str) -> None:
    """Raw CSV to Parquet, with file order kept as columns."""
    write_tables(read_raw(spark, raw), tables)


def features(spark, tables: str, target: str) -> None:
    """Train the word vectors, keep them next to the features, build the feature table."""
    staged = read_staged(spark, tables)
    model = text_vectors(staged)
    save_model(model, f"{target}-word-vectors")
    write_features(build_features(staged, model), target)


def score(spark, tables: str, feature_table: str, target: str, settings: Settings = Settings()) -> None:
    """Train both models and write the final scores."""
    scores = score_enterprises(read_staged(spark, tables), spark.read.parquet(feature_table), settings)
    write_scores(scores, target)


STEPS = {"ingest": ingest, "features": features, "score": score}


def main(arguments: list[str]) -> None:
    spark = build_session()
    try:
        STEPS[arguments[0]](spark, *arguments[1:])
    finally:
        clear_staged(spark)


if __name__ == "__main__":
    main(sys.argv[1:])
