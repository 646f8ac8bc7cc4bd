"""Per-entity features."""

from pyspark.sql import functions as F

from riskloom.checks import query, table
from riskloom.checks.entities import customers, events, orders
from riskloom.functions.dates import day_gap
from riskloom.functions.text import first_int
from riskloom.operators.aggregates import Feature, entity_features, fills, summary, vector_mean
from riskloom.operators.joins import attach, membership_flags
from riskloom.operators.records import latest_record


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("""
SELECT c.c_custkey AS custkey, coalesce(e.n, 0) AS event_number
FROM customer c LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e ON e.user_id = c.c_custkey
""")
def count_feature_fill0(spark, sf_dir):
    features = [Feature("event_number", "rows", fill=0)]
    return attach(customers(spark, sf_dir).select("custkey"),
                  [entity_features(events(spark, sf_dir), ["custkey"], features)], ["custkey"], fills(features))


@query("""
SELECT c.c_custkey AS custkey, coalesce(e.n, 0) AS event_number, coalesce(o.n, 0) AS order_number,
       coalesce(f.n, 0) AS finished_number
FROM customer c
LEFT JOIN (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1) e ON e.k = c.c_custkey
LEFT JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) o ON o.k = c.c_custkey
LEFT JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) f ON f.k = c.c_custkey
""")
def count_features_multi(spark, sf_dir):
    specs = {
        "event_number": events(spark, sf_dir),
        "order_number": orders(spark, sf_dir),
        "finished_number": orders(spark, sf_dir).filter("o_orderstatus = 'F'"),
    }
    features = {name: Feature(name, "rows", fill=0) for name in specs}
    counts = [entity_features(df, ["custkey"], [features[name]]) for name, df in specs.items()]
    return attach(customers(spark, sf_dir).select("custkey"), counts, ["custkey"], fills(list(features.values())))


@query("""
SELECT c.c_custkey AS custkey, e.n AS error_events, e.m AS purchase_events
FROM customer c LEFT JOIN (
  SELECT user_id, nullif(count(*) FILTER (WHERE event_type = 'error'), 0) AS n,
         nullif(count(*) FILTER (WHERE event_type = 'purchase'), 0) AS m FROM events GROUP BY 1) e ON e.user_id = c.c_custkey
""")
def flag_count(spark, sf_dir):
    flags = entity_features(events(spark, sf_dir), ["custkey"], [
        Feature("error_events", "rows_where", F.col("event_type") == "error"),
        Feature("purchase_events", "rows_where", F.col("event_type") == "purchase")])
    return attach(customers(spark, sf_dir).select("custkey"), [flags], ["custkey"])


@query("""
SELECT o_custkey AS custkey, max(o_totalprice) AS price_max, min(o_totalprice) AS price_min,
       round(avg(o_totalprice), 6) AS price_mean, round(stddev_samp(o_totalprice), 6) AS price_std
FROM orders GROUP BY 1
""")
def numeric_stats(spark, sf_dir):
    stats = entity_features(orders(spark, sf_dir), ["custkey"], summary("price", F.col("o_totalprice")))
    return rounded(stats, "price_mean", "price_std")


@query(r"""
SELECT user_id AS custkey, max(k) AS heads_max, min(k) AS heads_min, round(avg(k), 6) AS heads_mean,
       round(stddev_samp(k), 6) AS heads_std
FROM (SELECT user_id, TRY_CAST(regexp_extract(props, '\d+') AS BIGINT) AS k FROM events) GROUP BY 1
""")
def numeric_stats_regex(spark, sf_dir):
    stats = entity_features(events(spark, sf_dir), ["custkey"], summary("heads", first_int(F.col("props"))))
    return rounded(stats, "heads_mean", "heads_std")


@query("""
SELECT o_custkey AS custkey,
       count(DISTINCT nullif(o_orderpriority, '5-LOW')) + max(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END)
         AS priorities
FROM orders GROUP BY 1
""")
def distinct_incl_null(spark, sf_dir):
    return entity_features(orders(spark, sf_dir), ["custkey"], [
        Feature("priorities", "distinct_incl_null", F.nullif("o_orderpriority", F.lit("5-LOW")))])


@query("""
SELECT user_id AS custkey, nullif(count(DISTINCT event_type), 0) AS type_kinds,
       nullif(count(DISTINCT props), 0) AS props_kinds,
       nullif(count(DISTINCT CASE WHEN value > 100 THEN event_type END), 0) AS high_kinds
FROM events GROUP BY 1
""")
def distinct_kinds(spark, sf_dir):
    return entity_features(events(spark, sf_dir), ["custkey"], [
        Feature("type_kinds", "distinct_nullable", F.col("event_type")),
        Feature("props_kinds", "distinct_nullable", F.col("props")),
        Feature("high_kinds", "distinct_nullable", F.when(F.col("value") > 100, F.col("event_type")))])


@query("""
SELECT label, CAST(pos AS INTEGER) AS pos, round(avg(x), 6) AS mean FROM (
  SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY 1, 2
""", name="vector_mean")
def vector_mean_by_label(spark, sf_dir):
    means = vector_mean(table(spark, sf_dir, "embeddings"), ["label"], "embedding", 64, "mean")
    return rounded(means.select("label", F.posexplode("mean").alias("pos", "mean")), "mean")


SPINE_SQL = """
SELECT c.c_custkey AS custkey, c.c_mktsegment AS segment,
       coalesce(o.n, 0) AS order_number, o.price_max, o.price_min, round(o.price_mean, 6) AS price_mean,
       round(o.price_std, 6) AS price_std,
       l.o_orderstatus AS last_status, l.o_orderdate AS last_date,
       coalesce(e.n, 0) AS event_number, e.event_kinds,
       CAST(floor((epoch_us(o.last_order) - epoch_us(o.first_order)) / 86400000000.0) AS BIGINT) AS order_gap,
       CASE WHEN x.user_id IS NOT NULL THEN 1 ELSE 0 END AS is_error
FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS price_max, min(o_totalprice) AS price_min,
                  avg(o_totalprice) AS price_mean, stddev_samp(o_totalprice) AS price_std,
                  min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
           FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r
           FROM orders) l ON l.o_custkey = c.c_custkey AND l.r = 1
LEFT JOIN (SELECT user_id, count(*) AS n, nullif(count(DISTINCT event_type), 0) AS event_kinds FROM events GROUP BY 1) e
  ON e.user_id = c.c_custkey
LEFT JOIN (SELECT DISTINCT user_id FROM events WHERE event_type = 'error') x ON x.user_id = c.c_custkey
"""


@query(SPINE_SQL)
def entity_spine_features(spark, sf_dir):
    """The whole pattern at once: spine, counts, statistics, latest record, gap, label."""
    key = ["custkey"]
    order_features = [
        Feature("order_number", "rows", fill=0), *summary("price", F.col("o_totalprice")),
        Feature("first_order", "min", F.col("o_orderdate")), Feature("last_order", "max", F.col("o_orderdate"))]
    event_features = [
        Feature("event_number", "rows", fill=0), Feature("event_kinds", "distinct_nullable", F.col("event_type"))]
    latest = latest_record(orders(spark, sf_dir), key, "o_orderdate", ["o_orderkey"], ["o_orderstatus", "o_orderdate"])
    spine = customers(spark, sf_dir).select("custkey", F.col("c_mktsegment").alias("segment"))
    wide = attach(spine, [
        entity_features(orders(spark, sf_dir), key, order_features),
        latest.withColumnsRenamed({"o_orderstatus": "last_status", "o_orderdate": "last_date"}),
        entity_features(events(spark, sf_dir), key, event_features),
    ], key, fills([*order_features, *event_features]))
    wide = wide.withColumn("order_gap", day_gap(F.col("first_order"), F.col("last_order")))
    flagged = membership_flags(wide, {"is_error": events(spark, sf_dir).filter("event_type = 'error'")}, key)
    return rounded(flagged.drop("first_order", "last_order"), "price_mean", "price_std")
