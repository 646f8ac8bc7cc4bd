"""First and latest record, attach, membership, hot-key lookup."""

from pyspark.sql import functions as F

from riskloom.checks import query, table
from riskloom.functions.dates import parse_timestamp
from riskloom.operators.aggregates import Feature, entity_features
from riskloom.operators.joins import attach, distinct_keys, lookup, membership_flags
from riskloom.operators.records import first_record, latest_record

DATE_TEXT = """(CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR) || '/'
               || CAST(day(o_orderdate) AS VARCHAR))"""


def slash_text(date):
    """``Y/M/D`` without leading zeros, so that text order is not date order."""
    return F.concat_ws("/", F.year(date), F.month(date), F.dayofmonth(date))


def customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey")


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumnRenamed("user_id", "custkey")


@query("""
SELECT custkey, o_orderkey, o_orderstatus, o_totalprice FROM (
  SELECT o_custkey AS custkey, o_orderkey, o_orderstatus, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey
           ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderkey) AS r
  FROM orders) WHERE r = 1
""", name="first_record")
def first_record_per_entity(spark, sf_dir):
    ranked = orders(spark, sf_dir).withColumn("source_rank", F.when(F.col("o_orderstatus") == "F", 0).otherwise(1))
    return first_record(ranked, ["custkey"], ["source_rank", "o_orderkey"],
                        ["o_orderkey", "o_orderstatus", "o_totalprice"])


@query("""
SELECT custkey, o_orderkey, o_orderstatus, o_orderdate FROM (
  SELECT o_custkey AS custkey, o_orderkey, o_orderstatus, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS r
  FROM orders) WHERE r = 1
""", name="latest_record")
def latest_record_per_entity(spark, sf_dir):
    return latest_record(orders(spark, sf_dir), ["custkey"], "o_orderdate", ["o_orderkey"],
                         ["o_orderkey", "o_orderstatus", "o_orderdate"])


@query(f"""
SELECT custkey, o_orderkey, date_text FROM (
  SELECT o_custkey AS custkey, o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE {DATE_TEXT} END AS date_text,
         row_number() OVER (PARTITION BY o_custkey ORDER BY
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE {DATE_TEXT} END DESC NULLS LAST, o_orderkey) AS r
  FROM orders) WHERE r = 1
""")
def latest_record_text_order(spark, sf_dir):
    """Latest by the raw text of the date, missing dates last."""
    dated = orders(spark, sf_dir).withColumn(
        "date_text", F.when(F.col("o_orderpriority") != "5-LOW", slash_text(F.col("o_orderdate"))))
    return latest_record(dated, ["custkey"], "date_text", ["o_orderkey"], ["o_orderkey", "date_text"])


@query(f"""
SELECT custkey, o_orderkey, date_text FROM (
  SELECT o_custkey AS custkey, o_orderkey, {DATE_TEXT} AS date_text,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS r
  FROM orders) WHERE r = 1
""")
def latest_record_parsed_order(spark, sf_dir):
    """Latest by the parsed date of a ``Y/M/D`` text."""
    dated = orders(spark, sf_dir).withColumn("date_text", slash_text(F.col("o_orderdate")))
    return latest_record(dated, ["custkey"], parse_timestamp(F.col("date_text")), ["o_orderkey"],
                         ["o_orderkey", "date_text"])


@query("""
SELECT c.c_custkey AS custkey, c.c_name, o.o_orderkey, o.o_orderstatus
FROM customer c LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) o
  ON o.o_custkey = c.c_custkey AND o.r = 1
""")
def first_record_attach(spark, sf_dir):
    first = first_record(orders(spark, sf_dir), ["custkey"], ["o_orderkey"], ["o_orderkey", "o_orderstatus"])
    return attach(customers(spark, sf_dir).select("custkey", "c_name"), [first], ["custkey"])


@query("""
SELECT c.c_custkey AS custkey, e.event_rows, e.max_value
FROM customer c LEFT JOIN (
  SELECT user_id, count(*) AS event_rows, max(value) AS max_value FROM events GROUP BY user_id) e
  ON e.user_id = c.c_custkey
""")
def attach_left(spark, sf_dir):
    stats = entity_features(events(spark, sf_dir), ["custkey"], [
        Feature("event_rows", "rows"), Feature("max_value", "max", F.col("value"))])
    return attach(customers(spark, sf_dir).select("custkey"), [stats], ["custkey"])


@query("""
SELECT c_custkey AS custkey,
       CASE WHEN c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error') THEN 1 ELSE 0 END AS is_error,
       CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 1 ELSE 0 END AS is_urgent
FROM customer
""")
def membership_flag(spark, sf_dir):
    sets = {"is_error": events(spark, sf_dir).filter("event_type = 'error'"),
            "is_urgent": orders(spark, sf_dir).filter("o_orderpriority = '1-URGENT'")}
    return membership_flags(customers(spark, sf_dir).select("custkey"), sets, ["custkey"])


@query("""
SELECT o_orderkey, o_custkey AS custkey FROM orders
WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'error')
""")
def semi_filter(spark, sf_dir):
    keys = distinct_keys(events(spark, sf_dir).filter("event_type = 'error'"), ["custkey"])
    return lookup(orders(spark, sf_dir).select("o_orderkey", "custkey"), keys, ["custkey"],
                  spread_by=["o_orderkey"], how="left_semi")


@query("""
SELECT o_orderkey, o_custkey AS custkey FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')
""")
def anti_filter(spark, sf_dir):
    keys = distinct_keys(events(spark, sf_dir).filter("event_type = 'error'"), ["custkey"])
    return lookup(orders(spark, sf_dir).select("o_orderkey", "custkey"), keys, ["custkey"],
                  spread_by=["o_orderkey"], how="left_anti")


@query("""
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_quantity, f.rows_of_flag
FROM lineitem l LEFT JOIN (
  SELECT l_returnflag, count(*) AS rows_of_flag FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) f
  ON f.l_returnflag = l.l_returnflag
""")
def hot_key_lookup(spark, sf_dir):
    """A join in which three keys hold all rows: broadcast for the hot ones, salt for the rest."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    counts = entity_features(lines.filter("l_returnflag <> 'N'"), ["l_returnflag"], [Feature("rows_of_flag", "rows")])
    return lookup(lines, counts, ["l_returnflag"], spread_by=["l_orderkey", "l_linenumber"])


@query("""
SELECT o.o_orderkey, n.n_suppliers, n.n_parts,
       CASE WHEN n.n_suppliers > 1 OR n.n_parts > 1 THEN 1 ELSE 0 END AS has_many
FROM orders o LEFT JOIN (
  SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_partkey) AS n_parts
  FROM lineitem GROUP BY 1) n ON n.l_orderkey = o.o_orderkey
""")
def distinct_id_rule(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    counts = entity_features(lines, ["o_orderkey"], [
        Feature("n_suppliers", "distinct", F.col("l_suppkey")), Feature("n_parts", "distinct", F.col("l_partkey"))])
    many = (F.col("n_suppliers") > 1) | (F.col("n_parts") > 1)
    return attach(table(spark, sf_dir, "orders").select("o_orderkey"), [counts], ["o_orderkey"]).withColumn(
        "has_many", F.when(many, 1).otherwise(0))
