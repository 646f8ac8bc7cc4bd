"""Learned models: their rows are checked, and what they must learn where a rule made the label."""

from dataclasses import replace

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from riskloom.checks import query, table
from riskloom.operators.boosting import GRIDS, Booster, boost, boost_folds, search_grids, split_counts
from riskloom.operators.encode import ordinal_encode
from riskloom.operators.models import (
    Trees, feature_importances, fit_with_best_rounds, fit_with_patience, load_tree_model, model_input, most_categories,
    out_of_fold, predict, probability, save_model, search_one_at_a_time, tree_pipeline)
from riskloom.operators.sampling import hash_fold, holdout_split, negative_bags, sample_weights
from riskloom.operators.scoring import bag_average
from riskloom.operators.terms import term_vector, top_terms
from riskloom.session import spread, stage, staging_path

FEATURES = ["n_chars", "lang_encoder", "source_encoder"]
CATEGORIES = ["lang_encoder", "source_encoder"]
SMALL = Trees(rounds=5, step=0.1, depth=3, bins=32)


def documents(spark, sf_dir):
    """All documents with category codes, labels where there are any, and a fold."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    coded = ordinal_encode(rows, ["lang", "source"], ["doc_id"]).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    folded = coded.withColumns({"fold": hash_fold(["doc_id"], 3, 2018),
                                "weight": sample_weights(F.col("toxic") == 1).cast("double")})
    return stage(model_input(folded, ["doc_id", "quality", "toxic", "fold", "weight"], FEATURES), "documents")


@query()
def gbt_score(spark, sf_dir):
    """Weighted, category-aware trees with a validation split, averaged over re-balanced bags."""
    rows = documents(spark, sf_dir)
    train = rows.filter("quality IS NOT NULL").withColumn(
        "is_validation", holdout_split(["doc_id"], 0.1, 1) == "test")
    bags = stage(negative_bags(train, ["doc_id"], "toxic", bags=2, seed=0), "bags")
    pipeline = tree_pipeline(FEATURES, "toxic", SMALL, weight="weight", validation="is_validation",
                             categorical=CATEGORIES, max_categories=most_categories(bags, CATEGORIES))
    scores = None
    for bag in range(2):
        part = predict(pipeline.fit(bags.filter(F.col("bag") == bag)), rows, ["doc_id"], "p")
        scores = part if scores is None else scores.unionByName(part)
    return bag_average(scores, ["doc_id"], "p", "score")


@query()
def gbt_cv_rounds_score(spark, sf_dir):
    """Rounds chosen by cross-validation, then a fit on all labelled rows."""
    rows = documents(spark, sf_dir)
    model = fit_with_best_rounds(rows.filter("quality IS NOT NULL"), FEATURES, "quality", "fold", 3, SMALL)
    return predict(model, rows, ["doc_id"], "score")


@query()
def gbt_importance(spark, sf_dir):
    """Importance of each feature of a fitted model."""
    rows = documents(spark, sf_dir).filter("quality IS NOT NULL")
    return feature_importances(tree_pipeline(FEATURES, "quality", SMALL).fit(rows), rows, FEATURES)


@query()
def parameter_search(spark, sf_dir):
    """Two parameters, one at a time, by cross-validated log loss."""
    rows = documents(spark, sf_dir).filter("quality IS NOT NULL")
    return search_one_at_a_time(rows, tree_pipeline(FEATURES, "quality", Trees(3, 0.1, 3, bins=32)),
                                {"maxDepth": [2, 3], "minInstancesPerNode": [1, 5]}, "quality", "fold", 3)


@query()
def term_stacking_score(spark, sf_dir):
    """Frequent terms as 0/1 features, a linear model, and its out-of-fold score for every text."""
    texts = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    vocabulary = [row["term"] for row in top_terms(texts, F.col("text"), 200).collect()]  # 200 rows by design
    rows = term_vector(texts, F.col("text"), vocabulary, "features").drop("text").withColumn(
        "fold", hash_fold(["doc_id"], 3, 2018))
    rows = stage(rows, "term-vectors")
    train, test = rows.filter("quality IS NOT NULL"), rows.filter("quality IS NULL")
    model = LogisticRegression(labelCol="quality", maxIter=10, regParam=0.1)
    held, scored = out_of_fold(model.fit, train, test, ["doc_id"], "fold", 3, "score")
    return held.unionByName(scored)


# Models of a label that a rule makes from a category must give the rule back.

RULE = Trees(rounds=20, step=0.5, depth=3, bins=32)
RULE_FEATURES = ["o_orderpriority_encoder", "constant"]
RULE_SQL = """
SELECT o_orderkey, CAST(o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') AS INTEGER) AS predicted FROM orders
"""


def rule_rows(spark, sf_dir):
    """All orders with the code of their priority and a label that two priorities have."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    coded = ordinal_encode(orders, ["o_orderpriority"], ["o_orderkey"]).withColumns({
        "label": F.col("o_orderpriority").isin("1-URGENT", "4-NOT SPECIFIED").cast("double"), "constant": F.lit(1),
        "fold": hash_fold(["o_orderkey"], 3, 2018)})
    return stage(model_input(coded, ["o_orderkey", "label", "fold"], RULE_FEATURES), "rule-rows")


def predicted_class(scores):
    return scores.select("o_orderkey", (F.col("score") > 0.5).cast("int").alias("predicted"))


@query(RULE_SQL)
def tree_rule_class(spark, sf_dir):
    """Category-aware trees that stop with patience."""
    rows = rule_rows(spark, sf_dir)
    category = RULE_FEATURES[:1]
    model = fit_with_patience(rows.filter("fold > 0"), rows.filter("fold = 0"), RULE_FEATURES, "label", RULE,
                              categorical=category, max_categories=most_categories(rows, category))
    return predicted_class(predict(model, rows, ["o_orderkey"], "score"))


@query(RULE_SQL)
def tree_rule_saved_model(spark, sf_dir):
    """A model that was written and read back."""
    rows = rule_rows(spark, sf_dir)
    path = staging_path(spark, "model")
    save_model(tree_pipeline(RULE_FEATURES, "label", RULE).fit(rows), path)
    return predicted_class(predict(load_tree_model(path), rows, ["o_orderkey"], "score"))


@query(RULE_SQL)
def tree_rule_cv_rounds(spark, sf_dir):
    """Rounds by cross-validation, then a fit on all rows."""
    rows = rule_rows(spark, sf_dir)
    model = fit_with_best_rounds(rows, RULE_FEATURES, "label", "fold", 3, RULE)
    return predicted_class(predict(model, rows, ["o_orderkey"], "score"))


@query(RULE_SQL)
def tree_rule_out_of_fold(spark, sf_dir):
    """Each row once: those of two folds by the model that did not see them, those of the third by the mean."""
    rows = rule_rows(spark, sf_dir)
    held, scored = out_of_fold(tree_pipeline(RULE_FEATURES, "label", RULE).fit, rows.filter("fold < 2"),
                               rows.filter("fold = 2"), ["o_orderkey"], "fold", 2, "score")
    return predicted_class(held.unionByName(scored))


@query("""
SELECT * FROM (VALUES ('o_orderpriority_encoder', CAST(1 AS DOUBLE)), ('constant', CAST(0 AS DOUBLE))) AS t (feature, importance)
""")
def tree_rule_importance(spark, sf_dir):
    """The only feature that tells anything has all the importance."""
    rows = rule_rows(spark, sf_dir)
    found = feature_importances(tree_pipeline(RULE_FEATURES, "label", RULE).fit(rows), rows, RULE_FEATURES)
    return found.select("feature", F.round("importance", 9).alias("importance"))


@query("""
SELECT * FROM (VALUES ('minInfoGain', '0.0', 1), ('minInfoGain', '1.0', 0), ('minInstancesPerNode', '1', 1),
                      ('minInstancesPerNode', '1000000000', 0)) AS t (parameter, value, learns)
""")
def tree_rule_search(spark, sf_dir):
    """Of each parameter, the value that forbids all splits must lose in the cross-validation."""
    rows = rule_rows(spark, sf_dir)
    found = search_one_at_a_time(rows, tree_pipeline(RULE_FEATURES, "label", replace(RULE, rounds=5)),
                                 {"minInfoGain": [0.0, 1.0], "minInstancesPerNode": [1, 1_000_000_000]}, "label", "fold", 3)
    return found.select("parameter", "value", (F.col("metric") < 0.1).cast("int").alias("learns"))


# Boosting that goes on: category splits that no threshold can replace, continued training, splits counted.

CODES = 64
PARITY = Trees(rounds=6, step=0.5, depth=1, bins=CODES, patience=4)
PARITY_FEATURES = ["code_encoder", "price"]
PARITY_SQL = f"SELECT o_orderkey, CAST(o_custkey % {CODES} % 2 AS INTEGER) AS predicted FROM orders"


def parity_rows(spark, sf_dir):
    """All orders with one of 64 codes; the label is the code's parity, so one split on a threshold tells next to nothing."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") % CODES).cast("string").alias("code"), F.col("o_totalprice").alias("price"),
        (F.col("o_custkey") % CODES % 2).cast("double").alias("label"))
    coded = ordinal_encode(orders, ["code"], ["o_orderkey"]).withColumn("fold", hash_fold(["o_orderkey"], 3, 2018))
    return stage(model_input(coded, ["o_orderkey", "label", "fold"], PARITY_FEATURES), "parity-rows")


@query(PARITY_SQL)
def boost_parity_class(spark, sf_dir):
    """Trees of one split, stopped on the held-out AUC: only a split by categories can part even from odd codes."""
    rows = parity_rows(spark, sf_dir)
    model = boost(rows.filter("fold > 0"), rows.filter("fold = 0"), PARITY_FEATURES, "label", PARITY,
                  categorical=PARITY_FEATURES[:1], max_categories=CODES).model
    return predicted_class(predict(model, rows, ["o_orderkey"], "score"))


@query("SELECT o_orderkey, true AS same FROM orders")
def boost_continued(spark, sf_dir):
    """Two rounds and, from the saved model, three more score like five rounds at once."""
    rows = parity_rows(spark, sf_dir)
    numbers = replace(PARITY, depth=3)
    path = staging_path(spark, "model")
    first = Booster(rows, PARITY_FEATURES, "label", numbers)
    first.advance(2)
    save_model(first.model(), path)
    more = Booster(rows, PARITY_FEATURES, "label", numbers, start=load_tree_model(path))
    more.advance(3)
    whole = Booster(rows, PARITY_FEATURES, "label", numbers)
    whole.advance(5)
    scored = predict(more.model(), whole.model().transform(rows).withColumn("once", probability())
                     .drop("features", "rawPrediction", "probability", "prediction"), ["o_orderkey", "once"], "later")
    return scored.select("o_orderkey", (F.abs(F.col("once") - F.col("later")) < 1e-9).alias("same"))


@query(f"""
SELECT * FROM (VALUES ('code_encoder', CAST({PARITY.rounds} AS BIGINT)), ('price', CAST(0 AS BIGINT))) AS t (feature, n_splits)
""")
def boost_split_counts(spark, sf_dir):
    """Every tree splits once, and on the code."""
    booster = Booster(parity_rows(spark, sf_dir), PARITY_FEATURES, "label", PARITY, categorical=PARITY_FEATURES[:1], max_categories=CODES)
    booster.advance(PARITY.rounds)
    return split_counts(booster.model(), spark).select("feature", "n_splits")


@query(PARITY_SQL)
def boost_fold_models(spark, sf_dir):
    """One model a fold, each stopped by its own fold; every order is scored by the one that did not see it."""
    rows = parity_rows(spark, sf_dir)
    models = boost_folds(rows, PARITY_FEATURES, "label", "fold", 3, replace(PARITY, rounds=3), categorical=PARITY_FEATURES[:1],
                         max_categories=CODES)
    parts = [predict(m.model, rows.filter(F.col("fold") == i), ["o_orderkey"], "score") for i, m in enumerate(models)]
    return predicted_class(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("SELECT * FROM (VALUES " + ", ".join(
    f"('{name}', CAST({value} AS DOUBLE), {1 if name != 'min_gain' or value <= 1 else 0})"
    for name, values in GRIDS.items() for value in values) + ") AS t (parameter, value, learns)")
def boost_grid_search(spark, sf_dir):
    """All grids, one round a value: only a least gain beyond what the one split gains keeps a model from learning."""
    rows = parity_rows(spark, sf_dir).withColumn("fold", F.col("fold").cast("int") % 2)
    found = search_grids(rows, PARITY_FEATURES, "label", "fold", 2, replace(PARITY, rounds=1),
                         categorical=PARITY_FEATURES[:1], max_categories=CODES)
    return found.select("parameter", "value", (F.col("auc") > 0.99).cast("int").alias("learns"))
