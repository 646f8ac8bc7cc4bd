"""Folds, bags, splits, weights."""

import math

from pyspark.sql import functions as F

from riskloom.checks import query, table
from riskloom.checks.encoding import fold_sql
from riskloom.operators.sampling import (
    bootstrap_sample, hash_fold, holdout_split, negative_bags, sample_weights, stratified_fold, time_window_split)

HASH_SQL = "CAST('0x' || substr(md5(concat({key}, '|{seed}')), 1, 8) AS BIGINT)"


def labelled(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id")


@query(f"SELECT o_orderkey, {fold_sql('o_orderkey', 10, 2018)} AS fold FROM orders")
def hash_folds(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", hash_fold(["o_orderkey"], 10, 2018).alias("fold"))


@query(f"""
SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY
         {HASH_SQL.format(key='o_orderkey', seed=2018)}, CAST(o_orderkey AS VARCHAR)) - 1) % 10 AS INTEGER) AS fold
FROM orders
""")
def stratified_folds(spark, sf_dir):
    """Folds of equal size, to one row, within each class."""
    return stratified_fold(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"),
                           ["o_orderkey"], "o_orderstatus", 10, 2018)


@query(f"""
SELECT o_orderkey, CASE WHEN {HASH_SQL.format(key='o_orderkey', seed=7)} < 429496729 THEN 'test' ELSE 'train' END AS part
FROM orders
""", name="holdout_split")
def holdout_splits(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", holdout_split(["o_orderkey"], 0.1, 7).alias("part"))


@query(f"""
SELECT doc_id, lang, quality, toxic, CAST(b AS INTEGER) AS bag
FROM documents JOIN labels USING (doc_id), range(4) AS bags(b)
WHERE toxic = 1 OR b = {fold_sql('doc_id', 4, 0)}
""".replace("SELECT doc_id, lang", "SELECT doc_id, documents.lang"), name="negative_bags")
def negative_bags_one_part(spark, sf_dir):
    return negative_bags(labelled(spark, sf_dir), ["doc_id"], "toxic", bags=4, seed=0)


@query(f"""
SELECT doc_id, documents.lang, quality, toxic, CAST(b AS INTEGER) AS bag
FROM documents JOIN labels USING (doc_id), range(4) AS bags(b)
WHERE toxic = 1 OR b <> {fold_sql('doc_id', 4, 2018)}
""", name="negative_bags_loo")
def negative_bags_leave_one_out(spark, sf_dir):
    return negative_bags(labelled(spark, sf_dir), ["doc_id"], "toxic", bags=4, seed=2018, leave_one_out=True)


@query("SELECT doc_id, quality, CASE WHEN toxic = 1 THEN 2 ELSE 1 END AS weight FROM labels", name="sample_weights")
def sample_weights_by_label(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", "quality", sample_weights(F.col("toxic") == 1).alias("weight"))


@query("""
SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-12' AND ts < TIMESTAMP '2024-01-15' THEN 'train' ELSE 'test' END AS part
FROM events WHERE ts >= TIMESTAMP '2024-01-12' AND ts < TIMESTAMP '2024-01-16'
""", name="time_window_split")
def time_window_splits(spark, sf_dir):
    return time_window_split(table(spark, sf_dir, "events"), "ts", "2024-01-15 00:00:00").select("event_id", "part")


def poisson_sql(key: str, seed: int, fraction: float) -> str:
    """Poisson draw count as SQL: one comparison per cumulative probability."""
    tail = [sum(math.exp(-fraction) * fraction**i / math.factorial(i) for i in range(k + 1)) for k in range(40)]
    bounds = sorted({int(p * 2**32) for p in tail if int(p * 2**32) < 2**32 - 1})
    hashed = HASH_SQL.format(key=key, seed=seed)
    return " + ".join(f"CAST({hashed} >= {b} AS INTEGER)" for b in bounds)


@query(f"""
SELECT o_orderkey, CAST(draw AS INTEGER) AS draw FROM (
  SELECT o_orderkey, unnest(range(1, 1 + {poisson_sql('o_orderkey', 2018, 0.9)})) AS draw FROM orders)
""", name="bootstrap_sample")
def bootstrap_samples(spark, sf_dir):
    return bootstrap_sample(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 0.9, 2018)
