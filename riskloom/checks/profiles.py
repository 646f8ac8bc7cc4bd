"""Reports."""

from itertools import combinations

from pyspark.sql import functions as F

from riskloom.checks import query, table
from riskloom.operators.profile import (
    class_balance, discover_same_meaning, distinct_values, key_overlap, profile_columns, same_meaning, table_coverage, target_rate,
    uninformative)


def keys(spark, sf_dir):
    """Key sets of three tables under one name."""
    orders = table(spark, sf_dir, "orders")
    events = table(spark, sf_dir, "events")
    return {
        "customer": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")),
        "orders": orders.select(F.col("o_custkey").alias("k")),
        "urgent": orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k")),
        "events": events.select(F.col("user_id").alias("k")),
        "errors": events.filter("event_type = 'error'").select(F.col("user_id").alias("k")),
    }


KEY_SQL = """
WITH customer_k AS (SELECT DISTINCT c_custkey AS k FROM customer),
     orders_k AS (SELECT DISTINCT o_custkey AS k FROM orders),
     urgent_k AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'),
     events_k AS (SELECT DISTINCT user_id AS k FROM events),
     errors_k AS (SELECT DISTINCT user_id AS k FROM events WHERE event_type = 'error')
"""


@query("""
SELECT d.source, CAST(sum(l.quality) AS DOUBLE) / count(l.quality) AS quality_mean,
       CAST(sum(l.quality) AS BIGINT) AS quality_sum, count(*) AS n_rows
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.source IS NOT NULL GROUP BY 1
""")
def target_rate_by_category(spark, sf_dir):
    return target_rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"], ["source"], "quality")


@query("""
SELECT l.l_returnflag, CAST(sum(o.hit) AS DOUBLE) / count(o.hit) AS hit_mean, CAST(sum(o.hit) AS BIGINT) AS hit_sum,
       count(*) AS n_rows
FROM lineitem l LEFT JOIN (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS hit FROM orders WHERE o_orderpriority <> '5-LOW') o
  ON o.o_orderkey = l.l_orderkey GROUP BY 1
""")
def target_rate_of_details(spark, sf_dir):
    """Labels of entities spread over their many detail rows; some rows have no label."""
    labels = table(spark, sf_dir, "orders").filter("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("hit"))
    return target_rate(table(spark, sf_dir, "lineitem"), labels, ["l_orderkey"], ["l_returnflag"], "hit")


@query("""
SELECT d.lang, l.quality, count(*) AS n_rows FROM documents d JOIN labels l USING (doc_id) GROUP BY 1, 2
""", name="class_balance")
def class_balance_by_group(spark, sf_dir):
    labelled = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    return class_balance(labelled, ["lang"], "quality")


PART_TYPES = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
              "p_retailprice": "double"}


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS n_rows, count({c}) AS n_present, count(DISTINCT {c}) AS n_distinct FROM part"
    for c, t in PART_TYPES.items()), name="profile_columns")
def profile_of_columns(spark, sf_dir):
    return profile_columns(table(spark, sf_dir, "part"))


@query("""
SELECT * FROM (
  SELECT 'rare' AS "column", count(CASE WHEN l_quantity > 48 THEN l_quantity END) AS n_present,
         CASE WHEN 1 - count(CASE WHEN l_quantity > 48 THEN l_quantity END)::DOUBLE / count(*) > 0.9 THEN 'sparse' END AS reason
  FROM lineitem
  UNION ALL
  SELECT 'same', count(*), CASE WHEN count(DISTINCT left(l_returnflag, 0)) <= 1 THEN 'constant' END FROM lineitem
  UNION ALL
  SELECT 'l_linestatus', count(*), CASE WHEN count(DISTINCT l_linestatus) <= 1 THEN 'constant' END FROM lineitem)
WHERE reason IS NOT NULL
""")
def column_elimination(spark, sf_dir):
    """Mostly empty and single-valued columns, with the reason to drop them."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_quantity") > 48, F.col("l_quantity")).alias("rare"),
        F.substring("l_returnflag", 1, 0).alias("same"), "l_linestatus")
    return uninformative(profile_columns(lines)).select("column", "n_present", "reason")


@query("""
SELECT 'o_orderpriority' AS "left", 'level' AS "right",
       CASE WHEN count(DISTINCT o_orderpriority) = count(DISTINCT left(o_orderpriority, 1)) THEN 1 ELSE 0 END AS is_same FROM orders
UNION ALL SELECT 'o_orderpriority', 'o_orderstatus',
       CASE WHEN count(DISTINCT (o_orderpriority, o_orderstatus)) = count(DISTINCT o_orderpriority)
             AND count(DISTINCT (o_orderpriority, o_orderstatus)) = count(DISTINCT o_orderstatus) THEN 1 ELSE 0 END FROM orders
""")
def columns_of_same_meaning(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("level", F.substring("o_orderpriority", 1, 1))
    return same_meaning(orders, [("o_orderpriority", "level"), ("o_orderpriority", "o_orderstatus")])


@query(KEY_SQL + """
SELECT 'orders' AS table_name, count(*) AS n_entities, count(*) / (SELECT count(*)::DOUBLE FROM customer_k) AS share
FROM orders_k SEMI JOIN customer_k USING (k)
UNION ALL SELECT 'events', count(*), count(*) / (SELECT count(*)::DOUBLE FROM customer_k) FROM events_k SEMI JOIN customer_k USING (k)
UNION ALL SELECT 'errors', count(*), count(*) / (SELECT count(*)::DOUBLE FROM customer_k) FROM errors_k SEMI JOIN customer_k USING (k)
""", name="table_coverage")
def coverage_of_tables(spark, sf_dir):
    sets = keys(spark, sf_dir)
    return table_coverage(sets["customer"], {n: sets[n] for n in ("orders", "events", "errors")}, ["k"])


@query(KEY_SQL + """
SELECT 'orders&events' AS combination, count(*) AS n_keys FROM orders_k SEMI JOIN events_k USING (k)
UNION ALL SELECT 'orders', count(*) FROM orders_k
UNION ALL SELECT 'events', count(*) FROM events_k
""", name="key_overlap")
def key_overlap_pair(spark, sf_dir):
    sets = keys(spark, sf_dir)
    return key_overlap({n: sets[n] for n in ("orders", "events")}, ["k"], [("orders", "events"), ("orders",), ("events",)])


@query(KEY_SQL + """
SELECT 'customer&urgent&events' AS combination, count(*) AS n_keys
FROM customer_k SEMI JOIN urgent_k USING (k) SEMI JOIN events_k USING (k)
UNION ALL SELECT 'customer&orders&urgent&errors', count(*)
FROM customer_k SEMI JOIN orders_k USING (k) SEMI JOIN urgent_k USING (k) SEMI JOIN errors_k USING (k)
""")
def key_overlap_multi(spark, sf_dir):
    return key_overlap(keys(spark, sf_dir), ["k"], [
        ("customer", "urgent", "events"), ("customer", "orders", "urgent", "errors")])


@query("SELECT DISTINCT o_orderpriority FROM orders", name="distinct_values")
def distinct_values_of_column(spark, sf_dir):
    return distinct_values(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_entities, round(avg(o_totalprice), 6) AS mean_price FROM orders")
def table_sizes(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_custkey").alias("n_entities"),
        F.round(F.avg("o_totalprice"), 6).alias("mean_price"))


# All columns, the planted renamings among them.
RENAMED = {"segment_initial": "substr(c_mktsegment, 1, 2)", "nation_text": "concat('N', c_nationkey)",
           "known_nation": "CASE WHEN c_nationkey = 3 THEN NULL ELSE c_nationkey END", "half_key": "c_custkey % 50"}
COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", *RENAMED]


@query("WITH c AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in RENAMED.items()) + " FROM customer)" + "\nUNION ALL".join(
    f"""
SELECT '{min(a, b)}' AS "left", '{max(a, b)}' AS "right" FROM (
    SELECT count(DISTINCT (struct_pack(x := {a}), struct_pack(x := {b}))) AS n, count(DISTINCT struct_pack(x := {a})) AS n_a,
           count(DISTINCT struct_pack(x := {b})) AS n_b FROM c) WHERE n = n_a AND n = n_b AND n > 1""" for a, b in combinations(COLUMNS, 2)))
def discovered_same_meaning(spark, sf_dir):
    """Every pair of columns that name each other one to one, without being told where to look."""
    customers = table(spark, sf_dir, "customer").select("*", *[F.expr(e).alias(n) for n, e in RENAMED.items()])
    return discover_same_meaning(customers, COLUMNS)
