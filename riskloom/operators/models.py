"""Boosted trees, stacking and parameter search on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.values import MISSING
from riskloom.session import stage

#: Rounds of the first fit when a number of rounds is looked for; each further fit has twice as many.
FIRST_ROUNDS = 250
#: Models that are fitted at the same time.
PARALLEL_FITS = 4
#: Equal rows become one weighted row if that leaves less than one in so many.
FEWER = 4


@dataclass(frozen=True)
class Trees:
    """Settings of one boosted-tree model."""

    rounds: int
    step: float
    depth: int
    bins: int = 256
    rows_share: float = 1.0
    columns_share: float = 1.0
    min_rows: int = 1
    min_gain: float = 0.0
    patience: int = 100
    seed: int = 2018


# The settings of the two models that Spark's trees also have.
# A limit of 127 leaves corresponds to a depth of 7.
MODEL_A_TARGET1 = Trees(8000, 0.05, 6, rows_share=0.9, columns_share=0.95, min_rows=1)
MODEL_A_TARGET2 = Trees(8000, 0.03, 13, rows_share=0.9, columns_share=0.95, min_rows=3)
MODEL_B_TARGET1 = Trees(5000, 0.02, 7, bins=425, min_rows=5, patience=200)
MODEL_B_TARGET2 = Trees(5000, 0.05, 7, bins=425, min_rows=5)


def model_input(df: DataFrame, keep: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Features as doubles, with the missing-value marker in place of null.

    This is the only place where the marker is used; the tables keep null.
    """
    return df.select(*keep, *[
        F.coalesce(F.col(f).try_cast("double"), F.lit(float(MISSING))).alias(f) for f in features])


def _assembly(features: Sequence[str], categorical: Sequence[str], max_categories: int) -> list:
    """Stages that build ``features``; categorical columns of at most ``max_categories`` values are split as categories."""
    categorical = [c for c in features if c in set(categorical)]
    if not categorical:
        return [VectorAssembler(inputCols=list(features), outputCol="features")]
    numeric = [f for f in features if f not in set(categorical)]
    return [
        VectorAssembler(inputCols=categorical, outputCol="_categories"),
        VectorIndexer(inputCol="_categories", outputCol="_indexed", maxCategories=max_categories, handleInvalid="keep"),
        VectorAssembler(inputCols=["_indexed", *numeric], outputCol="features"),
    ]


def most_categories(df: DataFrame, columns: Sequence[str]) -> int:
    """The number of values of the column that has most; 0 without columns."""
    return max(df.agg(*[F.count_distinct(c) for c in columns]).head()) if columns else 0


def tree_pipeline(features: Sequence[str], label: str, trees: Trees, weight: str | None = None,
                  validation: str | None = None, categorical: Sequence[str] = (),
                  max_categories: int = 0) -> Pipeline:
    """A boosted-tree classifier on named columns.

    ``max_categories`` is what :func:`most_categories` counted for the
    ``categorical`` columns; the bins are raised to fit, so no column turns
    into a number because it has many values.
    ``validation`` names a boolean column: training stops once the loss on its
    true rows rises. A round that gains little still counts as one: with small
    steps every round gains little.
    """
    gbt = GBTClassifier(
        labelCol=label, featuresCol="features", maxIter=trees.rounds, stepSize=trees.step, maxDepth=trees.depth,
        maxBins=max(trees.bins, max_categories + 1), subsamplingRate=trees.rows_share,
        featureSubsetStrategy=str(trees.columns_share) if trees.columns_share < 1 else "all",
        minInstancesPerNode=trees.min_rows, minInfoGain=trees.min_gain, seed=trees.seed)
    if weight:
        gbt = gbt.setWeightCol(weight)
    if validation:
        gbt = gbt.setValidationIndicatorCol(validation)
        gbt.set(gbt.validationTol, 0.0)
    return Pipeline(stages=[*_assembly(features, categorical, max_categories), gbt])


def probability() -> Column:
    """Probability of class 1 in a transformed table."""
    return vector_to_array(F.col("probability"))[1]


def predict(model: Model, df: DataFrame, keep: Sequence[str], name: str) -> DataFrame:
    """``keep`` and the probability of class 1."""
    return model.transform(df).select(*keep, probability().alias(name))


def in_parallel(task: Callable[[int], object], number: int, at_once: int = PARALLEL_FITS) -> list:
    """``task(0) .. task(number - 1)``, some Spark jobs at a time."""
    with ThreadPool(min(at_once, number)) as pool:
        return pool.map(inheritable_thread_target(task), range(number), chunksize=1)


def stopping_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """The best round (from 1) before ``patience`` rounds without a better one, and whether these were seen."""
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def rounds_with_patience(losses: Callable[[int], Sequence[float]], trees: Trees, first: int = FIRST_ROUNDS) -> int:
    """The rounds at which training with patience ends; ``losses(n)`` trains ``n`` rounds.

    Spark cannot train on, so each fit starts anew with twice the rounds until
    the patience is used up. The first rounds of all fits are alike, so the
    result does not depend on ``first``.
    """
    rounds = min(first, trees.rounds)
    while True:
        best, stopped = stopping_round(losses(rounds), trees.patience)
        if stopped or rounds >= trees.rounds:
            return best
        rounds = min(2 * rounds, trees.rounds)


def held_out_losses(pipeline: Pipeline, train: DataFrame, held: DataFrame) -> list[float]:
    """Loss on ``held`` after each round of a model that learns from ``train``."""
    fitted = pipeline.fit(train)
    return fitted.stages[-1].evaluateEachIteration(PipelineModel(fitted.stages[:-1]).transform(held))


def merged(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> tuple[DataFrame, int] | None:
    """Rows equal in ``columns`` as one, with ``_rows`` and ``_weight``, and the number of rows; None if that saves little.

    A model without row sampling learns from them what it learns from the rows. Few codes have few rows however long the
    table; a table of numbers that hardly repeat stays as it is, after one pass that estimates how many differ.
    """
    columns = list(dict.fromkeys([*columns, *([weight] if weight else [])]))
    n, differ = df.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*columns))).head()
    if differ * FEWER > n:
        return None
    own = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_weight", own * F.col("_rows"))
    return stage(rows, "merged-rows"), n


def pieces(rows: DataFrame, n: int, least: int) -> DataFrame:
    """Merged rows as up to ``least`` pieces each, with their share of rows and weight, of ``n`` rows in all.

    Spark's trees count rows, not weights, against the least number of rows of a node: nodes have ``least`` pieces
    exactly if they have ``least`` rows. Where no two nodes can have so many, neither can they of whole merged rows.
    """
    if least <= 1 or 2 * least > n:
        return rows
    number = F.least(F.col("_rows"), F.lit(least))
    cut = rows.withColumns({"_piece": F.explode(F.sequence(F.lit(1), number.cast("int"))), "_number": number})
    return cut.withColumns({c: F.col(c) / F.col("_number") for c in ("_rows", "_weight")}).drop("_piece", "_number")


def best_rounds(df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int, trees: Trees,
                weight: str | None = None, first: int = FIRST_ROUNDS) -> int:
    """The number of rounds with the least mean validation loss over the folds, within the patience."""
    def mean_losses(rounds: int) -> list[float]:
        pipeline = tree_pipeline(features, label, replace(trees, rounds=rounds), weight)
        each = in_parallel(lambda i: held_out_losses(pipeline, df.filter(F.col(fold) != i), df.filter(F.col(fold) == i)), folds)
        return [sum(losses) / folds for losses in zip(*each)]

    return rounds_with_patience(mean_losses, trees, first)


def fit_with_patience(train: DataFrame, held: DataFrame, features: Sequence[str], label: str, trees: Trees,
                      weight: str | None = None, categorical: Sequence[str] = (), max_categories: int = 0,
                      first: int = FIRST_ROUNDS) -> PipelineModel:
    """A model of ``train`` that stops after ``trees.patience`` rounds without a smaller loss on ``held``."""
    def pipeline(rounds: int) -> Pipeline:
        return tree_pipeline(features, label, replace(trees, rounds=rounds), weight, categorical=categorical,
                             max_categories=max_categories)

    rounds = rounds_with_patience(lambda n: held_out_losses(pipeline(n), train, held), trees, first)
    return pipeline(rounds).fit(train)


def fit_with_best_rounds(df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int, trees: Trees,
                         weight: str | None = None) -> PipelineModel:
    """Choose the rounds by cross-validation, then fit on all rows."""
    found = merged(df, [*features, label, fold], weight) if trees.rows_share >= 1 else None
    if found:
        df, weight = stage(pieces(*found, trees.min_rows), "merged-pieces"), "_weight"
    rounds = best_rounds(df, features, label, fold, folds, trees, weight)
    return tree_pipeline(features, label, replace(trees, rounds=rounds), weight).fit(df)


def mean_score(models: Sequence[Model], df: DataFrame, keep: Sequence[str], name: str) -> DataFrame:
    """``keep`` and the mean score of the models, null without any; one column a model, so nothing is shuffled."""
    scored = df
    for i, model in enumerate(models):
        scored = model.transform(scored).select(*scored.columns, probability().alias(f"_p{i}"))
    total = sum((F.col(f"_p{i}") for i in range(1, len(models))), F.col("_p0")) if models else F.lit(None).cast("double")
    return scored.select(*keep, (total / max(len(models), 1)).alias(name))


def out_of_fold(fit: Callable[[DataFrame], Model], train: DataFrame, test: DataFrame, key: Sequence[str],
                fold: str, folds: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Stacking input: each train row scored by the model that did not see it,
    each test row by the mean of all models.

    The test models add one column each, so their mean needs no shuffle.
    """
    models = [fit(train.filter(F.col(fold) != i)) for i in range(folds)]
    held = None
    for i, model in enumerate(models):
        part = predict(model, train.filter(F.col(fold) == i), key, name)
        held = part if held is None else held.unionByName(part)
    return held, mean_score(models, test, key, name)


def search_one_at_a_time(df: DataFrame, pipeline: Pipeline, grids: Mapping[str, Sequence], label: str,
                         fold: str, folds: int, parallelism: int = 4, evaluator: Evaluator | None = None) -> DataFrame:
    """``parameter, value, metric``: each parameter varied alone, by cross-validated log loss.

    The report has one row per tried value. No model is fitted but those compared.
    """
    classifier = pipeline.getStages()[-1]
    found = None
    if evaluator is None and isinstance(classifier, GBTClassifier) and classifier.getSubsamplingRate() >= 1 \
            and "subsamplingRate" not in grids and not classifier.isSet("validationIndicatorCol"):
        # Columns that a stage makes are no columns of the table.
        used = [c for s in pipeline.getStages() if isinstance(s, VectorAssembler) for c in s.getInputCols() if c in df.columns]
        own = classifier.getWeightCol() if classifier.isSet("weightCol") else None
        found = merged(df, [*used, label, fold], own)
    tried = [(parameter, value) for parameter, values in grids.items() for value in values]
    evaluator = evaluator or MulticlassClassificationEvaluator(labelCol=label, metricName="logLoss")
    if found:
        evaluator = evaluator.copy({evaluator.weightCol: "_rows"})

    def metric(at: int) -> float:
        (parameter, value), i = tried[at // folds], at % folds
        set_ = {classifier.getParam(parameter): classifier.getParam(parameter).typeConverter(value)}
        train, held = df.filter(F.col(fold) != i), df.filter(F.col(fold) == i)
        if found:
            rows, n = found
            least = set_.get(classifier.minInstancesPerNode, classifier.getMinInstancesPerNode())
            train, held = pieces(rows.filter(F.col(fold) != i), n, least), rows.filter(F.col(fold) == i)
            set_[classifier.weightCol] = "_weight"
        return evaluator.evaluate(pipeline.fit(train, set_).transform(held))

    metrics = in_parallel(metric, folds * len(tried), parallelism)
    rows = [(parameter, str(value), float(sum(metrics[at * folds:(at + 1) * folds]) / folds))
            for at, (parameter, value) in enumerate(tried)]
    return df.sparkSession.createDataFrame(rows, "parameter string, value string, metric double")


def auc(df: DataFrame, label: str) -> float:
    """Area under the ROC curve of a transformed table."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction").evaluate(df)


def feature_order(model: PipelineModel) -> list[str]:
    """The features of a model in the order of its vector."""
    order = [f for stage in model.stages for f in (stage.getInputCols() if isinstance(stage, VectorAssembler) else [])]
    if "_indexed" in order:
        categories = list(model.stages[0].getInputCols())
        order = [*categories, *[f for f in model.stages[-2].getInputCols() if f != "_indexed"]]
    return order


def feature_importances(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, importance``: one row per feature of the model."""
    values = model.stages[-1].featureImportances.toArray()
    return df.sparkSession.createDataFrame(
        [(f, float(v)) for f, v in zip(feature_order(model), values)], "feature string, importance double")


def save_model(model: Model, path: str) -> None:
    """Write a fitted model, replacing an older one."""
    model.write().overwrite().save(path)


def load_tree_model(path: str) -> PipelineModel:
    """Read a pipeline written by :func:`save_model`."""
    return PipelineModel.load(path)
