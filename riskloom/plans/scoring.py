"""From the feature table to the final scores: bags, models, rules, blend."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from riskloom.operators.aggregates import Feature, entity_features
from riskloom.operators.boosting import boost_folds, boost_with_best_rounds
from riskloom.operators.joins import attach, membership_flags
from riskloom.operators.models import (
    MODEL_A_TARGET1, MODEL_A_TARGET2, MODEL_B_TARGET1, MODEL_B_TARGET2, Trees, mean_score, model_input,
    most_categories, predict)
from riskloom.operators.sampling import negative_bags, sample_weights, stratified_fold
from riskloom.operators.scoring import (
    FOLD_AUC_GATE, auc_exact, bag_average, base_rules, blend_tables, extended_rules)
from riskloom.plans.features import KEY
from riskloom.session import stage

# Fixed value: the province whose enterprises can carry the first label.
PROVINCE = "江苏省"

# The groups of features the models are fed with.
NUMBERS = ("zczj", "fzjgsf", "fzjgzt", "fzhydm", "fzjgqx", "fzjglx", "sjly", "rwbh", "QYFZCHRD_yynx", "xzgh", "qyjd", "qywd")
COUNTS = ("QYBZRYXX_number", "QYFZCHRD_number", "QYSWDJXX_number", "FRXZXKZX_number", "SDBDJQQJMCF_number",
          "SGSFRXZXKXX_number", "XKZZNJXX_number", "ZPSJ_number", "ZZDJBGXX_number", "QYJL_number")
PEOPLE = ("QY_tzrgs", "QY_zwzls", "QY_fddbrbz_gs", "QY_sxdbbz_gs")
DATES = ("clrq_year", "clrq_month", "clrq_day", "hzrq_year", "hzrq_month", "hzrq_day", "clhz_deltaDay", "fzsw_deltaDay")
HEAD_COUNTS = ("ZPSJ_zprs_max", "ZPSJ_zprs_min", "ZPSJ_zprs_mean", "ZPSJ_zprs_std")
QUALIFICATION_GAPS = ("ZZDJBGXX_jzsx_deltaDay", "zzsxcl_deltaDay", "zzjzcl_deltaDay", "zzsxhz_deltaDay", "zzjzhz_deltaDay")
VECTORS = tuple(f"jyfw_array_{i}_fea" for i in range(10))

# The same for category codes.
BASE_CODES = (
    "sshydm_encoder", "zczbbzmc_encoder", "hymldm_encoder", "zsszdsf_encoder", "fzhyml_encoder",
    "xxtgbmmc_encoder", "zl_encoder", "sszj_encoder", "fzjgmc_encoder", "qyjglxmc_encoder", "qylxmc_encoder",
)
TEXT_CODES = (
    "jgdzzs_encoder", "jyfw_encoder", "sshymc_encoder",
)
PREFIX_CODES = (
    "jgdzzs_top3_encoder", "jgdzzs_top6_encoder",
)
ID_CODES = (
    "fzrq_encoder", "bghzrq_encoder", "gszch_encoder", "fddbrzjhm_encoder", "zzjgdm_encoder",
)
TAX_CODES = (
    "QYSWDJXX_fddbrzjmc_encoder", "QYSWDJXX_shdw_encoder", "QYSWDJXX_qy_encoder", "QYSWDJXX_shjg_encoder",
    "QYSWDJXX_djzclx_encoder",
)
TOPIC_CODES = (
    "QYFZCHRD_swglm_encoder", "QYFZCHRD_gljg_encoder", "QYFZCHRD_djzclx_encoder", "SGSFRXZXKXX_xknr_encoder",
    "SGSFRXZXKXX_xmmc_encoder", "SGSFRXZXKXX_splb_encoder", "SGSFRXZXKXX_xkjg_encoder",
    "SGSFRXZXKXX_xysyfw_encoder", "SGSFRXZXKXX_sjzt2_encoder", "XKZZNJXX_njnd_encoder",
    "XKZZNJXX_njjgmc_encoder", "XKZZNJXX_njsxmc_encoder", "ZZDJBGXX_zzmc_encoder", "ZZDJBGXX_zyfw_encoder",
    "ZZDJBGXX_rdjgqc_encoder", "ZZDJBGXX_zzzsbh_encoder", "SGSFRXZXKXX_dfbm",
)
ABNORMAL_CODES = (
    "QYFZCHRD_zcdz_encoder", "QYFZCHRD_rwbh_encoder", "QYFZCHRD_xxtgbmmc_encoder",
    "XKZZNJXX_xxtgbmmc_encoder",
)

_WIDE = (*NUMBERS, *COUNTS, *BASE_CODES, *TOPIC_CODES, *PEOPLE, *DATES, *TEXT_CODES, *TAX_CODES)
FEATURES_A1 = (*_WIDE, *HEAD_COUNTS, *QUALIFICATION_GAPS)
FEATURES_A2 = (*_WIDE, *ID_CODES, *VECTORS)
FEATURES_B1 = (*NUMBERS, *BASE_CODES, *DATES, *HEAD_COUNTS, *QUALIFICATION_GAPS, *TEXT_CODES, *PREFIX_CODES, *ABNORMAL_CODES)
FEATURES_B2 = (*FEATURES_A2, *PREFIX_CODES)

# Features model B treats as categories.
CATEGORICAL = (
    "zsszdsf_encoder", "qyjglxmc_encoder", "hymldm_encoder", "zczbbzmc_encoder", "fzhyml_encoder",
    "qylxmc_encoder", "sshydm_encoder", "zl_encoder", "fzjgmc_encoder", "fzjglx", "fzhydm", "fzjgzt",
    "fzjgsf", "xzgh",
)


@dataclass(frozen=True)
class Settings:
    """How much to train. The defaults are the full job; tests pass small numbers."""

    bags: int = 4
    folds: int = 10
    a1: Trees = MODEL_A_TARGET1
    a2: Trees = MODEL_A_TARGET2
    b1: Trees = MODEL_B_TARGET1
    b2: Trees = MODEL_B_TARGET2
    extended: bool = False


def model_tables(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with numeric features, labels and weights, staged once."""
    columns = sorted({*FEATURES_A1, *FEATURES_A2, *FEATURES_B1, *FEATURES_B2})
    weighted = features.withColumn("weight", sample_weights(F.col("is_chufa") == 1).cast("double"))
    rows = stage(model_input(weighted, [*KEY, "is_shixin", "is_chufa", "weight"], columns), "model-rows",
                 partition_by=("split",))
    return rows.filter("split = 'train'"), rows.filter("split = 'test'")


def score_a(train: DataFrame, test: DataFrame, settings: Settings) -> DataFrame:
    """Model A: rounds by cross-validation; target 1 over bags that leave one part out."""
    # A row has the same fold in every bag it is in.
    folded = stratified_fold(train, ["qymc"], "is_shixin", settings.folds, 1)
    bags = stage(negative_bags(folded, ["qymc"], "is_shixin", settings.bags, 2018, leave_one_out=True), "bags-a",
                 partition_by=("bag",))
    parts = None
    for bag in range(settings.bags):
        model = boost_with_best_rounds(bags.filter(F.col("bag") == bag), FEATURES_A1, "is_shixin", "fold",
                                       settings.folds, settings.a1).model
        part = predict(model, test, ["qymc"], "p")
        parts = part if parts is None else parts.unionByName(part)
    target1 = bag_average(parts, ["qymc"], "p", "FORTARGET1")
    folded = stage(stratified_fold(train, ["qymc"], "is_chufa", settings.folds, 1), "folds-a")
    model = boost_with_best_rounds(folded, FEATURES_A2, "is_chufa", "fold", settings.folds, settings.a2).model
    return stage(target1.join(predict(model, test, ["qymc"], "FORTARGET2"), "qymc"), "scores-a")


def _fold_models(train: DataFrame, features: Sequence[str], label: str, folds: int, trees: Trees) -> list[tuple]:
    """One weighted, category-aware model per fold, with its validation AUC, by which it was stopped."""
    categories = most_categories(train, [c for c in features if c in set(CATEGORICAL)])
    found = boost_folds(train, features, label, "fold", folds, trees, weight="weight", categorical=CATEGORICAL,
                        max_categories=categories)
    return [(b.model, b.aucs[b.rounds - 1] if b.aucs and b.rounds else None) for b in found]


def score_b(train: DataFrame, test: DataFrame, settings: Settings) -> DataFrame:
    """Model B: folds that validate well count for target 1, all folds for target 2."""
    folded = stratified_fold(train, ["qymc"], "is_shixin", settings.folds, 2018)
    bags = stage(negative_bags(folded, ["qymc"], "is_shixin", settings.bags, 0), "bags-b", partition_by=("bag",))
    parts = None
    for bag in range(settings.bags):
        models = _fold_models(bags.filter(F.col("bag") == bag).drop("bag"), FEATURES_B1, "is_shixin",
                              settings.folds, settings.b1)
        good = [model for model, auc in models if auc is not None and auc > FOLD_AUC_GATE]
        part = mean_score(good, test, ["qymc"], "p")
        parts = part if parts is None else parts.unionByName(part)
    target1 = bag_average(parts, ["qymc"], "p", "FORTARGET1")
    folded = stage(stratified_fold(train, ["qymc"], "is_chufa", settings.folds, 2018), "folds-b")
    models = [model for model, _ in _fold_models(folded, FEATURES_B2, "is_chufa", settings.folds, settings.b2)]
    return stage(target1.join(mean_score(models, test, ["qymc"], "FORTARGET2"), "qymc"), "scores-b")


def rule_flags(tables: Mapping[str, DataFrame], spine: DataFrame) -> DataFrame:
    """The test side's flags and identifier counts the rules ask for.

    The branch flag looks at the second round only.
    """
    test = {name: df.filter("split = 'test'") for name, df in tables.items() if "split" in df.columns}
    flags = membership_flags(spine.filter("split = 'test'").select("qymc", "zsszdsf"), {
        "is_fr": test["revocation"], "is_fzc": test["abnormal"],
        "is_fz": test["branch"].filter("is_chusai = 0"), "is_qq": test["infringement"], "is_zp": test["recruitment"],
    }, ["qymc"])
    many = entity_features(test["base"], ["qymc"], [
        Feature("is_tyshxydm_many", "distinct", F.col("tyshxydm")), Feature("is_zch_many", "distinct", F.col("zch"))])
    in_province = F.when(F.col("zsszdsf") == PROVINCE, 1).otherwise(0)
    return attach(flags, [many], ["qymc"]).withColumn("is_suzhou", in_province)


def apply_rules(scores: DataFrame, flags: DataFrame, extended: bool = False) -> DataFrame:
    """Adjust target 1 by the rules; target 2 stays."""
    rows = attach(scores, [flags], ["qymc"])
    score = base_rules(F.col("FORTARGET1"), F.col("is_suzhou"), F.col("is_fr"), F.col("is_fzc"), F.col("is_fz"), F.col("is_qq"))
    if extended:
        score = extended_rules(score, F.col("is_zp"), F.col("is_tyshxydm_many"), F.col("is_zch_many"))
    return rows.select("qymc", score.alias("FORTARGET1"), "FORTARGET2")


def score_enterprises(tables: Mapping[str, DataFrame], features: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``qymc, FORTARGET1, FORTARGET2`` of every test enterprise: both models, rules, blend."""
    train, test = model_tables(features)
    flags = rule_flags(tables, features)
    a = apply_rules(score_a(train, test, settings), flags, settings.extended)
    b = apply_rules(score_b(train, test, settings), flags, settings.extended)
    return blend_tables(a, b, "qymc", "FORTARGET1", "FORTARGET2")


def evaluate(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """``auc1, auc2, mean_auc`` of a score table against ``qymc, is_shixin, is_chufa``: the task's metric."""
    joined = scores.join(labels.select("qymc", "is_shixin", "is_chufa"), "qymc")
    first = auc_exact(joined, "FORTARGET1", "is_shixin").select(F.col("auc").alias("auc1"))
    second = auc_exact(joined, "FORTARGET2", "is_chufa").select(F.col("auc").alias("auc2"))
    each = first.unionByName(second, allowMissingColumns=True)
    both = each.agg(F.max("auc1").alias("auc1"), F.max("auc2").alias("auc2"))
    return both.withColumn("mean_auc", (F.col("auc1") + F.col("auc2")) / 2)
