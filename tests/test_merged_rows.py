"""Rows that are equal train as one weighted row: the same models, whatever the table's length."""

from dataclasses import replace

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from riskloom.operators import models
from riskloom.operators.models import Trees, fit_with_best_rounds, merged, pieces, predict, search_one_at_a_time, tree_pipeline

NUMBERS = Trees(rounds=4, step=0.3, depth=2, bins=16)


@pytest.fixture(scope="module")
def rows(spark):
    """Eight codes and a flag, a label that is noisy in both; some classes of equal rows are small."""
    df = spark.range(3000, numPartitions=2).select(
        "id", (F.pow(F.xxhash64("id") % 1000 / 1000, F.lit(2)) * 8).cast("int").cast("double").alias("code"),
        (F.xxhash64("id", F.lit(1)) % 2).cast("double").alias("flag"), (F.col("id") % 3).cast("int").alias("fold"),
        F.lit(2.0).alias("two"), (F.xxhash64("id", F.lit(2)) % 5).alias("noise"))
    return df.withColumn("y", (F.col("code") + 3 * F.col("flag") + F.col("noise") > 4).cast("double")).localCheckpoint()


def test_equal_rows_are_counted_and_cut(rows):
    found, n = merged(rows, ["code", "flag", "y"], "two")
    assert n == 3000 and found.agg(F.sum("_rows"), F.sum("_weight")).head() == (3000, 6000.0) and found.count() < 60
    cut = pieces(found, n, 9)
    assert cut.agg(F.round(F.sum("_rows")), F.round(F.sum("_weight"))).head() == (3000.0, 6000.0)
    want = found.select(F.sum(F.least("_rows", F.lit(9)))).head()[0]
    assert cut.count() == want
    assert pieces(found, n, 10**9).count() == found.count()
    assert merged(rows, ["id", "code"]) is None


@pytest.mark.parametrize("least, weight", [(1, None), (40, "two")])
def test_chosen_rounds_and_model_are_those_of_the_rows(rows, monkeypatch, least, weight):
    numbers = replace(NUMBERS, min_rows=least)
    seen, fit = [], models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, df, *a: seen.append(df.count()) or fit(self, df, *a))
    fast = fit_with_best_rounds(rows, ["code", "flag"], "y", "fold", 3, numbers, weight)
    assert max(seen) < 3000  # the last fit has all rows
    monkeypatch.setattr(models, "FEWER", 10**9)
    plain = fit_with_best_rounds(rows, ["code", "flag"], "y", "fold", 3, numbers, weight)
    both = [[r["p"] for r in predict(m, rows, ["id"], "p").sort("id").collect()] for m in (fast, plain)]
    assert len(fast.stages[-1].trees) == len(plain.stages[-1].trees)
    assert both[0] == pytest.approx(both[1], abs=1e-9)


def test_search_finds_the_same_losses_and_fits_nothing_else(rows, monkeypatch):
    grids = {"minInstancesPerNode": [1, 60, 10**9], "maxDepth": [1, 2]}
    pipeline = tree_pipeline(["code", "flag"], "y", NUMBERS)
    seen, fit = [], models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, df, *a: seen.append(1) or fit(self, df, *a))
    fast = search_one_at_a_time(rows, pipeline, grids, "y", "fold", 3).collect()
    assert len(seen) == 15
    plain = search_one_at_a_time(rows, pipeline, grids, "y", "fold", 3,
                                 evaluator=MulticlassClassificationEvaluator(labelCol="y", metricName="logLoss")).collect()
    assert [r[:2] for r in fast] == [r[:2] for r in plain] and len(fast) == 5
    assert [r["metric"] for r in fast] == pytest.approx([r["metric"] for r in plain], abs=1e-9)
