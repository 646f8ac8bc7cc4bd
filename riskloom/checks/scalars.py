"""Row-wise functions."""

from pyspark.sql import functions as F

from riskloom.checks import query, table
from riskloom.checks.entities import DATE_TEXT, slash_text
from riskloom.functions.dates import date_parts, day_gap, parse_slash_date, parse_timestamp
from riskloom.functions.text import prefix, region_code_parts
from riskloom.functions.values import array_to_columns, not_null_flag


@query("SELECT p_partkey, left(p_name, 2) AS top2, left(p_name, 6) AS top6 FROM part")
def string_prefix(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select("p_partkey", prefix(name, 2).alias("top2"), prefix(name, 6).alias("top6"))


@query("""
SELECT o_orderkey, substr(code, 1, 2) AS region_province, substr(code, 3, 2) AS region_city,
       substr(code, 5, 2) AS region_county, substr(code, 1, 4) AS region_province_city, substr(code, 1, 6) AS region_full
FROM (SELECT o_orderkey, lpad(CAST(o_custkey * 211 AS VARCHAR), 6, '0') AS code FROM orders)
""")
def region_code_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", *[
        c.alias(n) for n, c in region_code_parts(F.col("o_custkey") * 211, "region").items()])


@query("""
SELECT event_id, CAST(year(ts) AS INTEGER) AS ts_year, CAST(month(ts) AS INTEGER) AS ts_month,
       CAST(day(ts) AS INTEGER) AS ts_day FROM events
""", name="date_parts")
def date_parts_of_text(spark, sf_dir):
    """Year, month and day of a timestamp that arrives as text."""
    at = parse_timestamp(F.col("ts").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in date_parts(at, "ts").items()])


@query("""
SELECT event_id,
       CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')) / 86400000000.0) AS BIGINT) AS gap_after,
       CAST(floor((epoch_us(TIMESTAMP '2024-01-15 12:00:00') - epoch_us(ts)) / 86400000000.0) AS BIGINT) AS gap_before,
       CASE WHEN event_type = 'error' THEN NULL ELSE
         CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '1024-01-15 12:00:00')) / 86400000000.0) AS BIGINT) END AS gap_long
FROM events
""")
def day_gaps(spark, sf_dir):
    """Gaps round down, also before the start; null in, null out."""
    at = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    ts = F.col("ts")
    old = F.when(F.col("event_type") != "error", F.lit("1024-01-15 12:00:00").cast("timestamp_ntz"))
    return table(spark, sf_dir, "events").select(
        "event_id", day_gap(at, ts).alias("gap_after"), day_gap(ts, at).alias("gap_before"),
        day_gap(old, ts).alias("gap_long"))


@query(f"""
SELECT o_orderkey, CAST(try_strptime(CASE WHEN o_orderpriority = '5-LOW' THEN 'bad' ELSE {DATE_TEXT} END, '%Y/%m/%d')
       AS TIMESTAMP) AS parsed
FROM orders
""", name="parse_slash_date")
def parse_slash_dates(spark, sf_dir):
    text = F.when(F.col("o_orderpriority") == "5-LOW", "bad").otherwise(slash_text(F.col("o_orderdate")))
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_slash_date(text).alias("parsed"))


@query("""
SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'O') IS NULL THEN 0 ELSE 1 END AS is_closed FROM orders
""", name="not_null_flag")
def not_null_flags(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", not_null_flag(F.nullif("o_orderstatus", F.lit("O"))).alias("is_closed"))


@query(f"""
SELECT vec_id, {", ".join(f"embedding[{i + 1}] AS array_{i}_fea" for i in range(10))}, embedding[66] AS beyond FROM embeddings
""", name="array_to_columns")
def array_to_scalar_columns(spark, sf_dir):
    names = [f"array_{i}_fea" for i in range(10)]
    array = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", *[
        c.alias(n) for n, c in array_to_columns(array, names).items()], F.get(array, F.lit(65)).alias("beyond"))
