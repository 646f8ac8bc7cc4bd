"""Sources, sinks, projection, renaming, null markers."""

from pyspark.sql import functions as F

from riskloom.checks import query, table
from riskloom.functions.text import normalise_synonyms
from riskloom.functions.values import fill_missing
from riskloom.operators.models import model_input
from riskloom.operators.records import stack_sources
from riskloom.session import staging_path
from riskloom.sources.broken_lines import read_broken_csv
from riskloom.sources.contracts import Contract
from riskloom.sources.sinks import write_features, write_scores
from riskloom.sources.tables import read_csv, read_name_list, read_scores, read_typed_csv


@query("""
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
""")
def scan_typed_csv(spark, sf_dir):
    """CSV with awkward headers, read with a declared schema."""
    names = {"p_partkey": "注册资本(金)", "p_name": "企业(机构)名称", "p_brand": "品牌&型号", "p_type": "类型",
             "p_size": "规模", "p_retailprice": "价格"}
    path = staging_path(spark, "typed-csv")
    part = table(spark, sf_dir, "part")
    part.withColumnsRenamed(names).write.option("header", True).option("escape", '"').csv(path)
    schema = ", ".join(f"`{names[c]}` {t}" for c, t in part.dtypes)
    return read_typed_csv(spark, path, schema, multiline=False).withColumnsRenamed({v: k for k, v in names.items()})


@query("""
SELECT c_name AS qymc, c_mktsegment AS zsszdsf, c_acctbal AS czbl,
       CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS hymldm
FROM customer
""")
def scan_contract_csv(spark, sf_dir):
    """CSV found by header under a contract: own names, kept columns, null texts."""
    path = staging_path(spark, "contract-csv")
    table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("无关列"), F.col("c_mktsegment").alias("住所所在地省份"), F.col("c_name").alias("企业名称"),
        F.col("c_acctbal").alias("出资比例"),
        F.when(F.col("c_nationkey") % 5 == 0, "NaN").otherwise(F.col("c_nationkey").cast("string")).alias("行业门类代码"),
    ).write.option("header", True).csv(path)
    contract = Contract("any", {"住所所在地省份": "zsszdsf", "出资比例": "czbl", "行业门类代码": "hymldm"}, numbers=("czbl",))
    return read_csv(spark, path, contract, multiline=False).select("qymc", "zsszdsf", "czbl", "hymldm")


@query("""
SELECT c_custkey, c_name || CASE WHEN c_custkey % 3 = 0 THEN chr(10) || 'second "line", of ' || c_mktsegment || chr(10) ELSE '' END AS note,
       c_acctbal
FROM customer
""")
def scan_broken_csv(spark, sf_dir):
    """Every third record runs over three lines; files are split all the same."""
    path = staging_path(spark, "broken-csv")
    note = F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, F.concat(
        F.lit('\nsecond "line", of '), "c_mktsegment", F.lit("\n"))).otherwise(F.lit("")))
    table(spark, sf_dir, "customer").select("c_custkey", note.alias("note"), "c_acctbal") \
        .write.option("header", True).option("escape", '"').option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_broken_csv(spark, path, True, "c_custkey bigint, note string, c_acctbal double").select("c_custkey", "note", "c_acctbal")


@query("SELECT c_name AS qymc FROM customer")
def scan_name_list(spark, sf_dir):
    """First column of a headerless file."""
    path = staging_path(spark, "name-list")
    table(spark, sf_dir, "customer").select("c_name", "c_mktsegment").write.csv(path)
    return read_name_list(spark, path)


@query("SELECT p_partkey, p_name, p_size, p_retailprice, CASE WHEN p_size > 25 THEN 'train' ELSE 'test' END AS split FROM part")
def feature_round_trip(spark, sf_dir):
    """Feature table written as Parquet by split and read back."""
    path = staging_path(spark, "features")
    part = table(spark, sf_dir, "part")
    write_features(
        part.select("p_partkey", "p_name", "p_size", "p_retailprice",
                    F.when(F.col("p_size") > 25, "train").otherwise("test").alias("split")), path)
    return spark.read.parquet(path).withColumn("split", F.col("split").cast("string"))


@query("""
SELECT c_name AS EID, c_acctbal / 10000 AS FORTARGET1, CAST(c_nationkey AS DOUBLE) AS FORTARGET2 FROM customer
""")
def score_round_trip(spark, sf_dir):
    """Score file written and read back."""
    path = staging_path(spark, "scores")
    write_scores(
        table(spark, sf_dir, "customer").select(
            F.col("c_name").alias("qymc"), (F.col("c_acctbal") / 10000).alias("FORTARGET1"),
            F.col("c_nationkey").cast("double").alias("FORTARGET2")), path)
    return read_scores(spark, path)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, 1 AS is_first_round, 0 AS source_rank FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, 0, 1 FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'
""")
def ordered_union_provenance(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return stack_sources(
        [(orders.filter("o_orderstatus = 'F'"), 1), (orders.filter("NOT o_orderstatus <=> 'F'"), 0)],
        "is_first_round", "source_rank")


@query("SELECT p_partkey AS zch, p_name AS qymc, p_type AS hymldm FROM part")
def project_rename(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.drop("p_size", "p_retailprice", "p_brand").withColumnsRenamed(
        {"p_partkey": "zch", "p_name": "qymc", "p_type": "hymldm"})


@query("""
SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), '-1') AS priority,
       coalesce(nullif(o_custkey % 7, 0), -1) AS code
FROM orders
""")
def null_sentinel(spark, sf_dir):
    holes = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.nullif(F.col("o_custkey") % 7, F.lit(0).cast("bigint")).alias("code"))
    return fill_missing(holes, ["priority", "code"])


@query("""
SELECT o_orderkey, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '5-LOW' WHEN '1-URGENT' THEN '2-HIGH'
       ELSE o_orderpriority END AS priority
FROM orders
""")
def synonym_normalise(spark, sf_dir):
    names = {"4-NOT SPECIFIED": "5-LOW", "1-URGENT": "2-HIGH"}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", normalise_synonyms(F.col("o_orderpriority"), names).alias("priority"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 20")
def page_slice(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy("o_orderkey").offset(20).limit(10)


@query("""
SELECT o_orderkey, o_totalprice, coalesce(TRY_CAST(left(o_orderpriority, 1) AS DOUBLE), -1) AS level,
       -1.0::DOUBLE AS o_orderstatus
FROM orders
""")
def numeric_model_input(spark, sf_dir):
    """Text that is a number becomes one; other text becomes the missing marker."""
    orders = table(spark, sf_dir, "orders").withColumn("level", F.substring("o_orderpriority", 1, 1))
    return model_input(orders, ["o_orderkey"], ["o_totalprice", "level", "o_orderstatus"])
