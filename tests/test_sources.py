"""Reading, file order and writing."""

import csv

import pytest
from pyspark.sql import functions as F

from riskloom.operators.records import first_record
from riskloom.session import stage
from riskloom.sources.broken_lines import read_broken_csv
from riskloom.sources.contracts import CONTRACTS, Contract
from riskloom.sources.sinks import write_features, write_scores, write_tables
from riskloom.sources.tables import (
    ORDER, files_with_line_breaks, read_csv, read_name_list, read_raw, read_scores, read_staged, read_typed_csv)


def test_contract_reading(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("﻿备注,企业名称,注册号,出资比例\nx,甲,007,1.5\ny,\"乙\n公司\",NaN,abc\nz,,\"\",\n", encoding="utf-8")
    contract = Contract("t", {"注册号": "zch", "出资比例": "czbl"}, numbers=("czbl",))
    rows = read_csv(spark, str(path), contract).select("qymc", "zch", "czbl").collect()
    assert [tuple(r) for r in rows] == [("甲", "007", 1.5), ("乙\n公司", None, None), (None, None, None)]


def test_missing_key_column(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "t.csv"), Contract("t"))


@pytest.mark.parametrize("multiline", [True, False, None])
def test_file_order_survives_splitting(spark, tmp_path, multiline):
    path = tmp_path / "t.csv"
    names = [f"e{i % 100}" for i in range(20000)]
    with open(path, "w", newline="", encoding="utf-8") as handle:
        out = csv.writer(handle)
        out.writerow(["企业名称", "注册号"])
        out.writerows([n, i] for i, n in enumerate(names))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = read_csv(spark, str(path), Contract("t", {"注册号": "zch"}), multiline)
        if multiline is not True:
            assert df.rdd.getNumPartitions() > 4
        got = first_record(df, ["qymc"], ORDER[1:], ["zch"]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["qymc"]: int(r["zch"]) for r in got} == {f"e{i}": i for i in range(100)}


def test_name_list_without_header(spark, tmp_path):
    (tmp_path / "n.csv").write_text("甲,1\n乙,2\n", encoding="utf-8")
    assert [r["qymc"] for r in read_name_list(spark, str(tmp_path / "n.csv")).collect()] == ["甲", "乙"]


def test_typed_csv(spark, tmp_path):
    (tmp_path / "n.csv").write_text("注册资本(金),b\n1.5,007\n", encoding="utf-8")
    df = read_typed_csv(spark, str(tmp_path / "n.csv"), "`注册资本(金)` double, b string")
    assert [tuple(r) for r in df.collect()] == [(1.5, "007")]


def test_all_raw_tables_to_parquet_and_back(spark, raw, tmp_path):
    root, written = raw
    tables = read_raw(spark, root)
    write_tables(tables, str(tmp_path / "tables"))
    staged = read_staged(spark, str(tmp_path / "tables"))
    for name in CONTRACTS:
        counts = {r["split"]: r["count"] for r in staged[name].groupBy("split").count().collect()}
        assert counts == {s: len(rows) for (t, s), rows in written.items() if t == name}, name
    assert set(staged["branch"].filter("split = 'test'").select("is_chusai").distinct().toPandas()["is_chusai"]) == {0, 1}


def test_score_and_feature_files(spark, tmp_path):
    df = spark.createDataFrame([("甲,乙", 0.25, 0.5), ("丙", 0.1, None)], "qymc string, FORTARGET1 double, FORTARGET2 double")
    write_scores(df, str(tmp_path / "s"))
    assert sorted(tuple(r) for r in read_scores(spark, str(tmp_path / "s")).collect()) == [("丙", 0.1, None), ("甲,乙", 0.25, 0.5)]
    write_features(df, str(tmp_path / "f"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "f")).count() == 2


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    folder = tmp_path / "some rows 表"
    folder.mkdir()
    (folder / "plain [1].csv").write_text("k,v\n" + "".join(f"p{i},{'x' * 50}\n" for i in range(2000)))
    (folder / "broken two.csv").write_text('k,v\nb1,"one\ntwo"\nb2,three\n')
    path = str(tmp_path / "some rows*")
    assert sorted(files_with_line_breaks(spark, path).values()) == [False, True]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = read_typed_csv(spark, path, "k string, v string")
        assert found.rdd.getNumPartitions() > 4
        rows = dict(map(tuple, found.collect()))
        names = {r["k"] for r in read_name_list(spark, path, "k").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 2002 and rows["b1"] == "one\ntwo" and rows["b2"] == "three"
    assert names == {*rows, "k"}


def written_csv(path, rows, newline="\n"):
    with open(path, "w", newline="", encoding="utf-8") as handle:
        csv.writer(handle, lineterminator=newline).writerows(rows)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [64, 700, 100_000])
def test_quoted_line_breaks_are_read_in_blocks_of_any_size(spark, tmp_path, size, newline):
    """Cells longer than a block, quotes in and at the ends of cells, blank lines, and what a plain reader gives."""
    rows = [["k", "v", "w"]]
    for i in range(300):
        odd = ["x", f"a{newline}b", 'say ""', '"', "", f"{newline}{newline}", 'q" in the middle', f'",{newline}"', "y" * 90 + newline + "z" * 90,
               f"tail{newline}", "comma, here", "é日本"][i % 12]
        rows.append([f"r{i}", odd, "" if i % 5 else f"w{i}"])
    written_csv(tmp_path / "t.csv", rows, newline)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        found = read_broken_csv(spark, str(tmp_path / "t.csv"), True)
        got = [(r["k"], r["v"], r["w"]) for r in found.sort("_file", "_block", "_row").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = spark.read.option("multiLine", True).option("header", True).option("quote", '"').option("escape", '"').csv(str(tmp_path / "t.csv"))
    assert got == [tuple(r) for r in whole.collect()]
    assert len(got) == 300


def test_quotes_inside_plain_cells_do_not_open_a_cell(spark, tmp_path):
    (tmp_path / "t.csv").write_text('k,v\na,5" pipe\nb,"one\ntwo"\nc,say "x" and "\nd,"e""f"\n\n   \ng,h\n')
    found = read_broken_csv(spark, str(tmp_path / "t.csv"), True).sort("_block", "_row").collect()
    assert [(r["k"], r["v"]) for r in found] == [("a", '5" pipe'), ("b", "one\ntwo"), ("c", 'say "x" and "'), ("d", 'e"f'), ("g", "h")]


def test_a_large_file_with_one_broken_cell_is_read_by_many_tasks(spark, tmp_path):
    rows = [["k", "v"]] + [[f"r{i}", "x" * 90] for i in range(40_000)]
    rows[20_000][1] = "one\ntwo, \"three\"\n\nfour"
    written_csv(tmp_path / "t.csv", rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        found = stage(read_broken_csv(spark, str(tmp_path / "t.csv"), True).withColumn("task", F.spark_partition_id()), "broken")
        sizes = [r["count"] for r in found.groupBy("task").count().collect()]
        blocks = found.groupBy("_block").count().count()
        got = [(r["k"], r["v"]) for r in found.sort("_block", "_row").collect()]
        typed = read_typed_csv(spark, str(tmp_path / "t.csv"), "k string, v string").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [tuple(r) for r in rows[1:]] and typed == 40_000
    assert blocks > 30 and len(sizes) > 8 and max(sizes) < 10_000


def test_broken_files_without_header_and_empty_ones(spark, tmp_path):
    (tmp_path / "n.csv").write_text('\ufeff"甲\n乙",1\n丙,2\n', encoding="utf-8")
    named = read_broken_csv(spark, str(tmp_path / "n.csv"), False).sort("_block", "_row").collect()
    assert [r["_c0"] for r in named] == ["甲\n乙", "丙"]
    (tmp_path / "e.csv").write_text("")
    assert read_broken_csv(spark, str(tmp_path / "e.csv"), True).collect() == []
    (tmp_path / "open.csv").write_text('k,v\na,b\nc,"never closed\nd,e\n')
    rows = read_broken_csv(spark, str(tmp_path / "open.csv"), True).sort("_block", "_row").collect()
    assert [r["k"] for r in rows] == ["a", "c"]
