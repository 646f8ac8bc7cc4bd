"""What the physical plans must and must not contain."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskloom.operators.aggregates import Feature, entity_features
from riskloom.operators.joins import attach, lookup
from riskloom.operators.records import first_record, latest_record
from riskloom.session import spread, stage, staging_root

FOLDER = "/root/testdata/sf0.001"
LEARNED = set(entry.queries()) - set(entry.oracle_sql())

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as for large tables: nothing is small enough to broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - LEARNED))
def test_no_query_pairs_all_rows_or_uses_python_rows(no_broadcast, name):
    text = plan(entry.queries()[name](no_broadcast, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    if name != "tokenize_with_user_function":
        assert "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - LEARNED))
def test_windows_are_partitioned(no_broadcast, name):
    """A window over a single partition is only allowed over per-slice sums."""
    text = plan(entry.queries()[name](no_broadcast, FOLDER))
    for match in re.finditer(r"Window \[[^\n]*?\], \[\]|Window \[[^\n]*windowspecdefinition\(0, ", text):
        assert "_sum_" in match.group(0) or "_rows" in match.group(0)


def test_best_record_is_limited_before_the_shuffle(no_broadcast):
    orders = no_broadcast.read.parquet(f"{FOLDER}/orders.parquet")
    for df in (first_record(orders, ["o_custkey"], ["o_orderkey"], ["o_orderstatus"]),
               latest_record(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], ["o_orderstatus"])):
        text = plan(df)
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")
        assert "PushedFilters: [IsNotNull(o_custkey)]" in text and "o_totalprice" not in text


def test_time_window_reaches_the_scan(spark):
    text = plan(entry.queries()["time_window_split"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts,2024-01-12" in text and "LessThan(ts,2024-01-16" in text


def test_star_of_tables_shuffles_each_table_once(no_broadcast):
    orders = no_broadcast.read.parquet(f"{FOLDER}/orders.parquet")
    spine = first_record(orders, ["o_custkey"], ["o_orderkey"], [])
    tables = [entity_features(orders.filter(F.col("o_orderkey") > i), ["o_custkey"], [Feature(f"n{i}", "rows")]) for i in range(4)]
    text = plan(attach(spine, tables, ["o_custkey"]))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 5


def test_lookup_places_rows_by_key_and_salt(no_broadcast):
    lines = no_broadcast.read.parquet(f"{FOLDER}/lineitem.parquet")
    orders = no_broadcast.read.parquet(f"{FOLDER}/orders.parquet").withColumnRenamed("o_orderkey", "l_orderkey")
    text = plan(lookup(lines, orders.select("l_orderkey", "o_custkey"), ["l_orderkey"], ["l_linenumber"]))
    assert re.search(r"SortMergeJoin \[_place#\d+L, l_orderkey#\d+L\]", text)
    with pytest.raises(TypeError):
        lookup(lines, orders.select(F.col("l_orderkey").cast("string"), "o_custkey"), ["l_orderkey"], ["l_linenumber"])


def test_hot_rows_spread_over_tasks(no_broadcast):
    """A third of the rows has one key; after the lookup's shuffle no partition holds a third."""
    rows = no_broadcast.range(30000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    table = stage(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("v")), "hot-test")
    no_broadcast.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup(rows, table, ["k"], ["id"], weight="n")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        no_broadcast.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 30000 and max(sizes) < 6000


def test_spread_leaves_wide_inputs_alone(spark):
    assert spread(spark.range(100, numPartitions=64), "id").rdd.getNumPartitions() == 64
    assert spread(spark.range(100, numPartitions=1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_staging_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        assert staging_root(spark) == named
    path = stage(spark.range(3), "x").inputFiles()[0]
    assert staging_root(spark).removeprefix("file:") in path


def test_staged_tables_go_and_nothing_else(spark, tmp_path):
    from riskloom.session import application_folder, clear_staged

    kept = tmp_path / "kept"
    spark.range(3).write.parquet(str(kept))
    folder = application_folder(spark).removeprefix("file:")
    stage(spark.range(3), "x")
    assert os.path.isdir(folder) and spark.sparkContext.applicationId in folder
    clear_staged(spark)
    assert not os.path.exists(folder) and os.path.isdir(os.path.dirname(folder)) and spark.read.parquet(str(kept)).count() == 3
