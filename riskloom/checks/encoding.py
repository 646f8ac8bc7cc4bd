"""Category codes and target encodings."""

from pyspark.sql import functions as F

from riskloom.checks import query, table
from riskloom.checks.aggregates import rounded
from riskloom.operators.encode import category_code_stats, ordinal_encode, out_of_fold_rate
from riskloom.operators.ordering import ordered_values
from riskloom.operators.sampling import hash_fold


def fold_sql(key: str, folds: int, seed: int) -> str:
    """The fold number as SQL."""
    return f"CAST(CAST('0x' || substr(md5(concat({key}, '|{seed}')), 1, 8) AS BIGINT) % {folds} AS INTEGER)"


@query("""
SELECT p_partkey, p_type, d.code AS p_type_encoder
FROM (SELECT p_partkey, nullif(p_type, 'ECONOMY') AS p_type FROM part) LEFT JOIN (
  SELECT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS code
  FROM (SELECT DISTINCT p_type FROM part WHERE p_type <> 'ECONOMY')) d USING (p_type)
""", name="ordinal_encode")
def ordinal_encode_one(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.nullif("p_type", F.lit("ECONOMY")).alias("p_type"))
    return ordinal_encode(part, ["p_type"], ["p_partkey"])


@query("""
SELECT p_partkey, p_brand, p_type, p_name, p_size,
       dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand_encoder,
       dense_rank() OVER (ORDER BY p_type) - 1 AS p_type_encoder,
       dense_rank() OVER (ORDER BY p_name) - 1 AS p_name_encoder,
       dense_rank() OVER (ORDER BY CAST(p_size AS VARCHAR)) - 1 AS p_size_encoder
FROM part
""")
def ordinal_encode_multi(spark, sf_dir):
    part = table(spark, sf_dir, "part").drop("p_retailprice")
    return ordinal_encode(part, ["p_brand", "p_type", "p_name", "p_size"], ["p_partkey"])


@query("""
SELECT o_orderkey, o_orderpriority, date_text,
       CASE WHEN o_orderpriority IS NOT NULL THEN dense_rank() OVER (ORDER BY o_orderpriority NULLS LAST) - 1 END AS o_orderpriority_encoder,
       dense_rank() OVER (ORDER BY date_text) - 1 AS date_text_encoder
FROM (SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') AS o_orderpriority,
             strftime(o_orderdate, '%Y-%m-%d') AS date_text FROM orders)
""")
def ordinal_encode_large(spark, sf_dir):
    """Dictionaries too large to broadcast: melted lookup with hot values and nulls spread."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("o_orderpriority"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"))
    return ordinal_encode(orders, ["o_orderpriority", "date_text"], ["o_orderkey"], broadcast_bytes=0)


@query("""
SELECT l_returnflag, l_quantity, count(*) AS n, dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) - 1 AS position,
       CAST(coalesce(sum(count(*)) OVER (PARTITION BY l_returnflag ORDER BY l_quantity
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_n
FROM lineitem GROUP BY 1, 2
""")
def ordered_positions(spark, sf_dir):
    """Positions and running counts of distinct values per group."""
    return ordered_values(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity")


@query("""
SELECT o_custkey, max(code) AS priority_max, min(code) AS priority_min, round(avg(code), 6) AS priority_mean,
       round(stddev_samp(code), 6) AS priority_std
FROM (SELECT o_custkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code FROM orders) GROUP BY 1
""", name="category_code_stats")
def category_code_statistics(spark, sf_dir):
    stats = category_code_stats(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "priority")
    return rounded(stats, "priority_mean", "priority_std")


@query(f"""
WITH d AS (SELECT doc_id, source, quality, {fold_sql('doc_id', 5, 2018)} AS fold
           FROM documents JOIN labels USING (doc_id)),
     cells AS (SELECT source, fold, sum(quality) AS hits, count(quality) AS n FROM d GROUP BY 1, 2),
     totals AS (SELECT source, sum(hits) AS hits, sum(n) AS n FROM cells GROUP BY 1)
SELECT d.doc_id, d.source, d.quality, d.fold,
       CAST(t.hits - c.hits AS DOUBLE) / nullif(CAST(t.n - c.n AS DOUBLE), 0) AS source_rate
FROM d JOIN cells c USING (source, fold) JOIN totals t USING (source)
""")
def oof_target_mean(spark, sf_dir):
    """Target rate of the category over the other folds."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    folded = rows.withColumn("fold", hash_fold(["doc_id"], 5, 2018))
    return out_of_fold_rate(folded, ["doc_id"], "source", "quality", "fold", "source_rate")
