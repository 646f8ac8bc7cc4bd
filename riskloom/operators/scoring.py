"""Scores: rules, averages, blends, rank fusion, AUC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.operators.joins import lookup
from riskloom.operators.ordering import ordered_values
from riskloom.session import stage

# Divisors of the score adjustment rules.
ABNORMAL_DIVISOR = 1.5
BRANCH_DIVISOR = 3
INFRINGEMENT_DIVISOR = 2
RECRUITING_DIVISOR = 1.5

# Weights of the final blend.
BLEND_TARGET1 = {"a": 0.6, "b": 0.4}
BLEND_TARGET2 = {"a": 0.2, "b": 0.8}

# Fixed value: a fold counts only if its validation AUC is above this.
FOLD_AUC_GATE = 0.9


def rule_adjust(score: Column, zero_if: Sequence[Column], divide_if: Sequence[tuple[Column, float]]) -> Column:
    """0 where any zeroing rule holds, else the score divided by each rule that holds.

    A condition that is null does not hold. The rules commute, so their order
    does not matter.
    """
    divided = reduce(
        lambda value, rule: value / F.when(rule[0], F.lit(float(rule[1]))).otherwise(F.lit(1.0)), divide_if, score)
    zeroed = reduce(Column.__or__, [F.coalesce(c, F.lit(False)) for c in zero_if], F.lit(False))
    return F.when(zeroed, F.lit(0.0)).otherwise(divided)


def base_rules(score: Column, in_province: Column, revoked: Column, abnormal: Column, has_branch: Column,
               infringed: Column) -> Column:
    """Zero outside the province or with a revoked licence; divide for risk-free signs."""
    return rule_adjust(score, [in_province == 0, revoked == 1], [
        (abnormal == 1, ABNORMAL_DIVISOR), (has_branch == 1, BRANCH_DIVISOR), (infringed == 1, INFRINGEMENT_DIVISOR)])


def extended_rules(score: Column, recruiting: Column, credit_codes: Column, registrations: Column) -> Column:
    """On top of the base rules: recruiting divides, several identifiers zero."""
    return rule_adjust(score, [credit_codes > 1, registrations > 1], [(recruiting == 1, RECRUITING_DIVISOR)])


def bag_average(scores: DataFrame, key: Sequence[str], score: str, name: str) -> DataFrame:
    """Mean score per key over the bags (long form: one row per key and bag)."""
    return scores.groupBy(*key).agg(F.avg(score).alias(name))


def fold_gate_average(scores: DataFrame, metrics: DataFrame, key: Sequence[str], score: str, name: str,
                      gate: float = FOLD_AUC_GATE) -> DataFrame:
    """Mean score over the folds whose AUC is above the gate; null if there is none.

    ``metrics`` has one ``(fold, auc)`` row per fold, so it is broadcast: its
    size is the number of folds, whatever the data.
    """
    gated = scores.join(F.broadcast(metrics.select("fold", "auc")), "fold", "left")
    return gated.groupBy(*key).agg(F.avg(F.when(F.col("auc") > gate, F.col(score))).alias(name))


def blend(scores: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """Weighted sum of the models' scores."""
    return reduce(Column.__add__, [scores[m] * F.lit(float(w)) for m, w in weights.items()])


def blend_tables(a: DataFrame, b: DataFrame, key: str, target1: str, target2: str) -> DataFrame:
    """Join two models' score tables by key and blend both targets.

    Where one model has no score, as when none of its folds passed the gate,
    the other's stands alone.
    """
    left = a.select(key, F.col(target1).alias("_a1"), F.col(target2).alias("_a2"))
    right = b.select(key, F.col(target1).alias("_b1"), F.col(target2).alias("_b2"))
    both = right.join(left, key, "left")
    return both.select(
        key,
        F.coalesce(blend({"a": F.col("_a1"), "b": F.col("_b1")}, BLEND_TARGET1), "_a1", "_b1").alias(target1),
        F.coalesce(blend({"a": F.col("_a2"), "b": F.col("_b2")}, BLEND_TARGET2), "_a2", "_b2").alias(target2))


def rank_fusion(df: DataFrame, key: Sequence[str], weights: Mapping[str, float], name: str) -> DataFrame:
    """Weighted mean over the models of (ascending rank / rows); ties share a rank.

    All models are ranked in one distributed ordering of their distinct scores.
    """
    cells = df.select(*key, F.inline(F.array(*[
        F.struct(F.lit(m).alias("_model"), F.col(m).cast("double").alias("_score")) for m in weights])))
    values = stage(
        ordered_values(cells, ["_model"], "_score").select(
            "_model", "_score", "n", (F.col("before_n") + 1).alias("_rank")), "score-ranks")
    ranked = lookup(cells, values, ["_model", "_score"], spread_by=[*key, "_model"], weight="n", how="inner")
    # One row per model: the number of ranked rows.
    rows = values.groupBy("_model").agg(F.sum("n").alias("_rows"))
    weight = F.element_at(F.create_map(*[F.lit(part) for m, w in weights.items() for part in (m, float(w))]), F.col("_model"))
    share = weight * F.col("_rank") / F.col("_rows")
    return ranked.join(F.broadcast(rows), "_model").groupBy(*key).agg(
        (F.sum(share) / F.lit(float(sum(weights.values())))).alias(name))


def auc_exact(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve; tied scores count one half. One row, null without both classes.

    Works on distinct scores with their class counts, so ties cost nothing,
    and on exact integers until the last division.
    """
    known = df.filter(F.col(label).isNotNull())
    scored = ordered_values(known, [], score, {
        "pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) == 0)})
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    halves = F.sum(wide("pos") * (wide("before_neg") * 2 + wide("neg")))
    return scored.agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), halves.cast("double").alias("_halves")
    ).select("n_pos", "n_neg",
             F.try_divide(F.col("_halves"), F.col("n_pos").cast("double") * F.col("n_neg") * 2).alias("auc"))


def auc_by_group(df: DataFrame, group: Sequence[str], score: str, label: str) -> DataFrame:
    """``n_pos, n_neg, auc`` as in :func:`auc_exact`, one row per ``group`` (folds, models, rounds).

    All groups are ordered in one pass, so a hundred models cost one ordering. A group without
    a known label and score has no row, one without both classes a null.
    """
    known = df.filter(F.col(label).isNotNull())
    scored = ordered_values(known, group, score, {
        "pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) == 0)})
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    halves = F.sum(wide("pos") * (wide("before_neg") * 2 + wide("neg")))
    return scored.groupBy(*group).agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), halves.cast("double").alias("_halves")
    ).select(*group, "n_pos", "n_neg",
             F.try_divide(F.col("_halves"), F.col("n_pos").cast("double") * F.col("n_neg") * 2).alias("auc"))


def residual(prediction: Column, label: Column) -> Column:
    """Prediction minus label."""
    return prediction - label


def top_features(importances: DataFrame, k: int) -> DataFrame:
    """The ``k`` most important features, ties by name."""
    return importances.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)
