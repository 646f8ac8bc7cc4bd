"""Rules, averages, blends, fusion, AUC."""

from pyspark.sql import functions as F

from riskloom.checks import query, table
from riskloom.checks.aggregates import rounded
from riskloom.operators.scoring import (
    auc_by_group, auc_exact, bag_average, base_rules, blend_tables, extended_rules, fold_gate_average, rank_fusion, residual,
    top_features)

FLAG_SQL = """
  SELECT c_custkey, abs(c_acctbal) / 10000 AS score,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN 1 ELSE 0 END AS in_province,
         CASE WHEN c_nationkey = 3 THEN 1 ELSE 0 END AS revoked,
         CASE WHEN c_custkey IN (SELECT user_id FROM events) THEN 1 ELSE 0 END AS abnormal,
         CASE WHEN c_nationkey > 12 THEN 1 ELSE 0 END AS has_branch,
         CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 1 ELSE 0 END AS infringed,
         CASE WHEN c_nationkey % 2 = 0 THEN 1 ELSE 0 END AS recruiting
  FROM customer
"""
BASE_SQL = """CASE WHEN in_province = 0 OR revoked = 1 THEN 0.0::DOUBLE ELSE score
  / CASE WHEN abnormal = 1 THEN 1.5::DOUBLE ELSE 1 END / CASE WHEN has_branch = 1 THEN 3 ELSE 1 END
  / CASE WHEN infringed = 1 THEN 2 ELSE 1 END END"""


def flagged(spark, sf_dir):
    """Customers with a score and the flags the rules ask for."""
    from riskloom.operators.joins import membership_flags

    nation = F.col("c_nationkey")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.abs("c_acctbal") / 10000).alias("score"),
        F.when(F.col("c_mktsegment") != "BUILDING", 1).otherwise(0).alias("in_province"),
        F.when(nation == 3, 1).otherwise(0).alias("revoked"),
        F.when(nation > 12, 1).otherwise(0).alias("has_branch"),
        F.when(nation % 2 == 0, 1).otherwise(0).alias("recruiting"))
    return membership_flags(customers, {
        "abnormal": table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey")),
        "infringed": table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(
            F.col("o_custkey").alias("c_custkey"))}, ["c_custkey"])


def adjusted():
    return base_rules(F.col("score"), F.col("in_province"), F.col("revoked"), F.col("abnormal"), F.col("has_branch"),
                      F.col("infringed"))


@query(f"SELECT c_custkey, score, {BASE_SQL} AS adjusted FROM ({FLAG_SQL})", name="rule_adjust")
def rule_adjust_base(spark, sf_dir):
    return flagged(spark, sf_dir).select("c_custkey", "score", adjusted().alias("adjusted"))


@query(f"""
SELECT c_custkey, CASE WHEN n_statuses > 2 OR n_levels > 4 THEN 0.0::DOUBLE
       ELSE {BASE_SQL} / CASE WHEN recruiting = 1 THEN 1.5::DOUBLE ELSE 1 END END AS adjusted
FROM ({FLAG_SQL}) LEFT JOIN (
  SELECT o_custkey AS c_custkey, count(DISTINCT o_orderstatus) AS n_statuses, count(DISTINCT o_orderpriority) AS n_levels
  FROM orders GROUP BY 1) USING (c_custkey)
""", name="rule_adjust_ext")
def rule_adjust_extended(spark, sf_dir):
    """All rules; the identifier counts are joined on and null where there are none."""
    from riskloom.operators.aggregates import Feature, entity_features
    from riskloom.operators.joins import attach

    counts = entity_features(
        table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"], [
            Feature("n_statuses", "distinct", F.col("o_orderstatus")),
            Feature("n_levels", "distinct", F.col("o_orderpriority"))])
    rows = attach(flagged(spark, sf_dir), [counts], ["c_custkey"])
    # The identifier rules ask for more than one; here, for more than two and four.
    score = extended_rules(adjusted(), F.col("recruiting"), F.col("n_statuses") - 1, F.col("n_levels") - 3)
    return rows.select("c_custkey", score.alias("adjusted"))


@query(f"SELECT round(avg(score), 6) AS mean_before, round(avg({BASE_SQL}), 6) AS mean_after FROM ({FLAG_SQL})")
def score_drift(spark, sf_dir):
    """Mean score before and after the rules."""
    return flagged(spark, sf_dir).agg(
        F.round(F.avg("score"), 6).alias("mean_before"), F.round(F.avg(adjusted()), 6).alias("mean_after"))


@query("""
SELECT b.EID, a.t1 * 0.6::DOUBLE + b.t1 * 0.4::DOUBLE AS FORTARGET1, a.t2 * 0.2::DOUBLE + b.t2 * 0.8::DOUBLE AS FORTARGET2
FROM (SELECT c_custkey AS EID, abs(c_acctbal) / 10000 AS t1, c_nationkey / 25 AS t2 FROM customer) b
LEFT JOIN (SELECT o_custkey AS EID, count(*) / 100 AS t1, max(o_totalprice) / 1000000 AS t2 FROM orders GROUP BY 1) a USING (EID)
""")
def blend_scores(spark, sf_dir):
    """Two models' tables joined by key; an entity one model lacks has no blend."""
    b = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("EID"), (F.abs("c_acctbal") / 10000).alias("FORTARGET1"),
        (F.col("c_nationkey") / 25).alias("FORTARGET2"))
    a = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("EID")).agg(
        (F.count(F.lit(1)) / 100).alias("FORTARGET1"), (F.max("o_totalprice") / 1000000).alias("FORTARGET2"))
    return blend_tables(a, b, "EID", "FORTARGET1", "FORTARGET2")


@query("SELECT l_orderkey, round(avg(l_discount), 6) AS score FROM lineitem GROUP BY 1", name="bag_average")
def bag_averages(spark, sf_dir):
    return rounded(bag_average(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_discount", "score"), "score")


@query("""
WITH metrics AS (SELECT l_linenumber, count(*) FILTER (WHERE l_quantity > 5) / count(*)::DOUBLE AS auc FROM lineitem GROUP BY 1)
SELECT l_orderkey, round(avg(CASE WHEN auc > 0.9 THEN l_discount END), 6) AS score
FROM lineitem JOIN metrics USING (l_linenumber) GROUP BY 1
""", name="fold_gate_average")
def fold_gate_averages(spark, sf_dir):
    """Only folds above the gate count; an entity with none has no score."""
    scores = table(spark, sf_dir, "lineitem").withColumnRenamed("l_linenumber", "fold")
    metrics = scores.groupBy("fold").agg((F.count_if(F.col("l_quantity") > 5) / F.count(F.lit(1))).alias("auc"))
    return rounded(fold_gate_average(scores, metrics, ["l_orderkey"], "l_discount", "score"), "score")


@query("""
SELECT c_custkey, round((0.6::DOUBLE * ra / n + 0.4::DOUBLE * rb / n) / 1.0, 9) AS fused FROM (
  SELECT c_custkey, rank() OVER (ORDER BY c_acctbal) AS ra, rank() OVER (ORDER BY c_nationkey) AS rb,
         count(*) OVER () AS n FROM customer)
""", name="rank_fusion")
def rank_fusions(spark, sf_dir):
    """Weighted mean of relative ranks; the second model has only 25 distinct scores."""
    fused = rank_fusion(table(spark, sf_dir, "customer"), ["c_custkey"], {"c_acctbal": 0.6, "c_nationkey": 0.4}, "fused")
    return rounded(fused, "fused", digits=9)


AUC_SQL = """
WITH s AS ({rows}),
     g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s WHERE y IS NOT NULL GROUP BY 1),
     w AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score) - neg AS below FROM g)
SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
       round(CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * 2), 12) AS auc
FROM w
"""


@query(AUC_SQL.format(rows="SELECT n_chars AS score, quality AS y FROM documents JOIN labels USING (doc_id)"), name="auc_exact")
def auc_of_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    return rounded(auc_exact(rows, "n_chars", "quality"), "auc", digits=12)


@query(AUC_SQL.format(rows="SELECT l_quantity AS score, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS y FROM lineitem"))
def auc_with_ties(spark, sf_dir):
    """Fifty distinct scores over the whole table; rows without a class are left out."""
    label = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0)
    return rounded(auc_exact(table(spark, sf_dir, "lineitem").withColumn("y", label), "l_quantity", "y"), "auc", digits=12)


@query("""
SELECT doc_id, n_chars / (n_chars + 1000.0::DOUBLE) - quality AS residual FROM documents JOIN labels USING (doc_id)
""")
def residuals(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    prediction = F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))
    return rows.select("doc_id", residual(prediction, F.col("quality")).alias("residual"))


@query("SELECT p_brand AS feature, sum(l_quantity) AS importance FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def feature_topk(spark, sf_dir):
    sums = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("feature"))
    return top_features(sums.join(part, "l_partkey").groupBy("feature").agg(F.sum("q").alias("importance")), 10)


@query(AUC_SQL.replace("SELECT score, sum(y)", "SELECT fold, score, sum(y)").replace("GROUP BY 1)", "GROUP BY 1, 2)")
       .replace("SELECT pos, neg, sum(neg) OVER (ORDER", "SELECT fold, pos, neg, sum(neg) OVER (PARTITION BY fold ORDER")
       .replace("\nSELECT CAST(sum(pos) AS BIGINT)", "\nSELECT fold, CAST(sum(pos) AS BIGINT)").replace("FROM w\n", "FROM w GROUP BY fold\n")
       .format(rows="SELECT l_linenumber AS fold, l_quantity AS score, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS y FROM lineitem"))
def auc_by_fold(spark, sf_dir):
    """One AUC a group, all from one ordering."""
    label = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0)
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("fold"), "l_quantity", label.alias("y"))
    return rounded(auc_by_group(rows, ["fold"], "l_quantity", "y"), "auc", digits=12)
