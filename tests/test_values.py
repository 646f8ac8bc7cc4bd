"""Edge cases the test tables do not contain: nulls, ties, odd dates, markers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.functions.dates import day_gap, parse_day, parse_slash_date, parse_timestamp
from riskloom.functions.text import (
    ID_DOCUMENT_SYNONYMS, first_int, normalise_synonyms, prefix, region_code_parts, tokenize, user_tokenizer)
from riskloom.functions.values import fill_missing, not_null_flag
from riskloom.operators.aggregates import Feature, entity_features, summary
from riskloom.operators.encode import category_code_stats, ordinal_dictionary, ordinal_encode, out_of_fold_rate
from riskloom.operators import encode
from riskloom.operators.joins import attach, lookup, membership_flags
from riskloom.operators.models import (
    Trees, fit_with_patience, mean_score, most_categories, predict, rounds_with_patience, stopping_round, tree_pipeline)
from riskloom.operators.ordering import ordered_values
from riskloom.operators.profile import profile_columns
from riskloom.operators.records import first_record, latest_record, stack_sources
from riskloom.operators.sampling import hash_fold, negative_bags, stratified_fold
from riskloom.plans.scoring import evaluate
from riskloom.operators.scoring import (
    auc_exact, base_rules, blend_tables, extended_rules, fold_gate_average, rank_fusion)


def values(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_parse_timestamp_shapes(spark):
    texts = ["2017-03-04", "2017/3/4", "2017-03-04 10:20:30", "20170304", " 2017-3-4 ", "9999-12-31", "bad", "", None]
    got = values(spark, [(t,) for t in texts], "t string", parse_timestamp(F.col("t")))
    day = dt.datetime(2017, 3, 4)
    assert got == [day, day, day.replace(hour=10, minute=20, second=30), day, day, dt.datetime(9999, 12, 31), None, None, None]


def test_parse_day_drops_time(spark):
    texts = ["2017-03-04 23:59:59", "2017/3/4 9:00", "2017-3-4T10:00", "20170304", "bad"]
    got = values(spark, [(t,) for t in texts], "t string", parse_day(F.col("t")))
    assert got == [dt.datetime(2017, 3, 4)] * 4 + [None]


def test_short_times(spark):
    texts = ["2017/3/4 9:05", "2017-03-04 09:05:00", "2017-03-04T09:05:00", "2017/03/04 9:5:0"]
    got = values(spark, [(t,) for t in texts], "t string", parse_timestamp(F.col("t")))
    assert got == [dt.datetime(2017, 3, 4, 9, 5)] * 4


def test_parse_slash_date(spark):
    got = values(spark, [("2017/3/4",), ("bad",), ("2017-03-04",), ("2017/13/4",), (None,)], "t string", parse_slash_date(F.col("t")))
    assert got == [dt.datetime(2017, 3, 4), None, None, None, None]


def test_day_gap_rounds_down(spark):
    rows = [(dt.datetime(2020, 1, 2, 1), dt.datetime(2020, 1, 2)), (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)),
            (dt.datetime(2020, 1, 1, 12), dt.datetime(2020, 1, 2, 11)), (None, dt.datetime(2020, 1, 1)),
            (dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31)), (dt.datetime(9999, 12, 31, 0, 0, 0, 1), dt.datetime(1, 1, 1))]
    got = values(spark, rows, "a timestamp_ntz, b timestamp_ntz", day_gap(F.col("a"), F.col("b")))
    assert got == [None if a is None else (b - a).days for a, b in rows]


def test_dates_do_not_depend_on_the_zone(spark):
    """The hour 02:30 of 2020-03-08 does not exist in New York, and that day has 23 hours."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.createDataFrame([("2020-03-08 02:30:00", "2020/3/9")], "a string, b string").select(
            parse_timestamp(F.col("a")).alias("a"), parse_slash_date(F.col("b")).alias("b"), parse_day(F.col("a")).alias("d"))
        got = row.select(F.col("a").cast("string"), F.col("d").cast("string"), day_gap(F.col("a"), F.col("b")),
                         day_gap(F.col("d"), F.col("b")), day_gap(F.col("b"), F.col("a"))).head()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == ("2020-03-08 02:30:00", "2020-03-08 00:00:00", 0, 1, -1)


def test_text_functions(spark):
    assert values(spark, [("招5-10人",), ("若干",), (None,), ("１２人",)], "t string", first_int(F.col("t"))) == [5, None, None, 12]
    assert values(spark, [("苏州市吴中区",), ("ab",)], "t string", prefix(F.col("t"), 3)) == ["苏州市", "ab"]
    parts = region_code_parts(F.col("c"), "r")
    row = spark.createDataFrame([(320506,)], "c int").select(*[c.alias(n) for n, c in parts.items()]).head()
    assert tuple(row) == ("32", "05", "06", "3205", "320506")
    got = values(spark, [("居民身份证",), ("护照",), (None,)], "t string", normalise_synonyms(F.col("t"), ID_DOCUMENT_SYNONYMS))
    assert got == ["身份证", "护照", None]


def test_tokenize(spark):
    texts = [("销售：LED灯具、模具",), ("a-b  c",), ("，",), ("",), (None,), ("中文字x",)]
    got = values(spark, texts, "t string", tokenize(F.col("t")))
    assert got == [["销售", "LED", "灯具", "模具"], ["a", "b", "c"], [], [], None, ["中文", "文字", "x"]]


def test_user_tokenizer_keeps_null(spark):
    got = values(spark, [("a b",), (None,), ("",)], "t string", user_tokenizer(str.split)(F.col("t")))
    assert got == [["a", "b"], None, []]


def test_metric_of_the_task(spark):
    scores = spark.createDataFrame([("a", 0.9, 0.1), ("b", 0.1, 0.2), ("c", 0.5, 0.2)], "qymc string, FORTARGET1 double, FORTARGET2 double")
    labels = spark.createDataFrame([("a", 1, 0), ("b", 0, 1), ("c", 0, 0), ("d", 1, 1)], "qymc string, is_shixin int, is_chufa int")
    assert tuple(evaluate(scores, labels).head()) == (1.0, 0.75, 0.875)


def test_flags_and_markers(spark):
    df = spark.createDataFrame([("a", 1.5), (None, None)], "s string, d double")
    assert [tuple(r) for r in fill_missing(df, ["s", "d"]).collect()] == [("a", 1.5), ("-1", -1.0)]
    assert values(spark, [("x",), (None,)], "t string", not_null_flag(F.col("t"))) == [1, 0]


def test_counts_and_kinds(spark):
    df = spark.createDataFrame(
        [("e", "a", "x", "是"), ("e", "a", "x", "否"), ("e", None, None, None), ("f", None, None, "否"), (None, "z", "z", "是")],
        "k string, t string, z string, f string")
    got = entity_features(df, ["k"], [
        Feature("n", "rows"), Feature("t", "distinct_incl_null", F.col("t")), Feature("z", "distinct_nullable", F.col("z")),
        Feature("d", "distinct", F.col("z")), Feature("f", "rows_where", F.col("f") == "是")]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("e", 3, 2, 1, 1, 1), ("f", 1, 1, None, 0, None)]


def test_one_value_has_no_deviation(spark):
    df = spark.createDataFrame([("e", 5.0)], "k string, v double")
    assert tuple(entity_features(df, ["k"], summary("v", F.col("v"))).head()) == ("e", 5.0, 5.0, 5.0, None)


def test_approximate_kinds(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    rows = entity_features(df, ["k"], [Feature("n", "distinct", F.col("id"))], approx=True).collect()
    assert all(abs(r["n"] - 500) < 60 for r in rows)


def test_first_record_prefers_earlier_source(spark):
    old = spark.createDataFrame([("E1", 10.0, 5)], "k string, v double, row long")
    new = spark.createDataFrame([("E1", 20.0, 1), ("E2", 30.0, 2), (None, 1.0, 3)], "k string, v double, row long")
    stacked = stack_sources([(old, 1), (new, 0)], "is_first", "rank")
    got = first_record(stacked, ["k"], ["rank", "row"], ["v", "is_first"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("E1", 10.0, 1), ("E2", 30.0, 0)]


@pytest.mark.parametrize("dates, by, expected", [
    ([None, "2017-01-01", "2018-01-01"], "text", 3),
    (["2017/9/1", "2017/10/1"], "text", 1),
    (["2017/9/1", "2017/10/1"], "parsed", 2),
    (["2018-01-01", "2018-01-01"], "text", 1),
    ([None, None], "parsed", 1),
])
def test_latest_record(spark, dates, by, expected):
    df = spark.createDataFrame([("E", d, i + 1) for i, d in enumerate(dates)], "k string, d string, row long")
    order = F.col("d") if by == "text" else parse_timestamp(F.col("d"))
    assert latest_record(df, ["k"], order, ["row"], ["row"]).head()["row"] == expected


def test_membership(spark):
    spine = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    listed = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    got = membership_flags(spine, {"f": listed}, ["k"]).collect()
    assert sorted((str(r["k"]), r["f"]) for r in got) == [("None", 0), ("a", 1), ("b", 0)]


def test_attach_keeps_rows_and_splits(spark):
    spine = spark.createDataFrame([("train", "E1"), ("test", "E1"), ("test", "E2")], "split string, k string")
    detail = spark.createDataFrame([("train", "E1"), ("train", "E1"), ("test", "E1")], "split string, k string")
    counts = entity_features(detail, ["split", "k"], [Feature("n", "rows")])
    got = attach(spine, [counts], ["split", "k"], {"n": 0}).collect()
    assert sorted(tuple(r) for r in got) == [("test", "E1", 1), ("test", "E2", 0), ("train", "E1", 2)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("slots", [4, 1000])
def test_lookup_with_hot_and_null_keys(spark, how, weighted, slots):
    keys = ["hot"] * 500 + [f"k{i % 50}" for i in range(300)] + [None] * 200
    rows = spark.createDataFrame(list(enumerate(keys)), "id long, k string")
    entries = [("hot", 1)] + [(f"k{i}", i) for i in range(0, 60, 2)]
    table = spark.createDataFrame([(k, v, keys.count(k)) for k, v in entries], "k string, v int, n long")
    if not weighted:
        table = table.drop("n")
    got = lookup(rows, table, ["k"], ["id"], weight="n" if weighted else None, how=how, slots=slots, sampled=1.0)
    known = dict(entries)
    if how == "left":
        want = [(i, k, known.get(k)) for i, k in enumerate(keys)]
    elif how == "inner":
        want = [(i, k, known[k]) for i, k in enumerate(keys) if k in known]
    else:
        want = [(i, k) for i, k in enumerate(keys) if (k in known) == (how == "left_semi")]
    assert sorted(tuple(r) for r in got.select(*got.columns).collect()) == sorted(want)


@pytest.mark.parametrize("limits", [
    {"broadcast_bytes": 0}, {"inline_bytes": 0}, {}], ids=["large", "broadcast", "inline"])
def test_codes_over_train_and_test(spark, limits):
    df = spark.createDataFrame([(1, "train", "b"), (2, "train", None), (3, "test", "a"), (4, "test", "c"), (5, "test", "b")],
                               "id long, split string, v string")
    got = ordinal_encode(df, ["v"], ["id"], **limits).orderBy("id").collect()
    assert [r["v_encoder"] for r in got] == [1, None, 0, 2, 1]


def test_codes_of_an_empty_column(spark):
    df = spark.createDataFrame([(1, None, 7), (2, None, 3)], "id long, v string, w int")
    got = ordinal_encode(df, ["v", "w"], ["id"]).orderBy("id").collect()
    assert [(r["v_encoder"], r["w_encoder"]) for r in got] == [(None, 1), (None, 0)]
    assert ordinal_encode(df, ["v"], ["id"]).head()["v_encoder"] is None


def test_code_statistics(spark):
    df = spark.createDataFrame([("e", "a"), ("e", "c"), ("e", "c"), ("f", "b"), ("f", None)], "k string, v string")
    got = {r["k"]: tuple(r)[1:] for r in category_code_stats(df, ["k"], "v", "v").collect()}
    assert got["f"] == (1, 1, 1.0, None)
    assert got["e"][:2] == (2, 0) and abs(got["e"][2] - 4 / 3) < 1e-12 and abs(got["e"][3] - (4 / 3) ** 0.5) < 1e-12


def test_out_of_fold_rate_of_a_lone_category(spark):
    df = spark.createDataFrame([(1, "a", 1, 0), (2, "a", 0, 1), (3, "b", 1, 0), (4, None, 1, 0)], "id long, c string, y int, fold int")
    got = {r["id"]: r["rate"] for r in out_of_fold_rate(df, ["id"], "c", "y", "fold", "rate").collect()}
    assert got == {1: 0.0, 2: 1.0, 3: None, 4: None}


def test_ordered_values_over_many_slices(spark):
    """Positions and prefix sums must be exact however the range is cut."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(((F.col("id") * 7919) % 1009).alias("v"), (F.col("id") % 3).alias("g"))
        got = ordered_values(df, ["g"], "v", {"s": F.sum("v")}).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, rows = {}, {}
    for i in range(5000):
        rows.setdefault((i % 3, (i * 7919) % 1009), []).append((i * 7919) % 1009)
    for g in range(3):
        before_n = before_s = 0
        for position, v in enumerate(sorted(v for gg, v in rows if gg == g)):
            want[g, v] = (len(rows[g, v]), sum(rows[g, v]), position, before_n, before_s)
            before_n, before_s = before_n + len(rows[g, v]), before_s + sum(rows[g, v])
    assert {(r["g"], r["v"]): (r["n"], r["s"], r["position"], r["before_n"], r["before_s"]) for r in got} == want


def test_rules(spark):
    schema = "s double, p int, r int, a int, b int, i int, z int, c long, n long"
    rows = [(0.9, 1, 0, 1, 1, 1, 0, 1, 1), (0.9, 0, 0, 0, 0, 0, 0, 1, 1), (0.9, 1, 1, 0, 0, 0, 0, 1, 1),
            (0.9, 1, 0, 0, 0, 0, 1, 1, 1), (0.9, 1, 0, 0, 0, 0, 0, 2, 1), (0.9, 1, 0, 0, 0, 0, 0, None, 2), (0.9, 1, 0, 0, 0, 0, 0, None, None)]
    c = F.col
    base = base_rules(c("s"), c("p"), c("r"), c("a"), c("b"), c("i"))
    got = values(spark, rows, schema, extended_rules(base, c("z"), c("c"), c("n")))
    assert [round(v, 12) for v in got] == [0.1, 0.0, 0.0, 0.6, 0.0, 0.0, 0.9]


def test_fold_gate(spark):
    scores = spark.createDataFrame([("e", 0, 0.2), ("e", 1, 0.9), ("e", 2, 0.4)], "k string, fold int, p double")
    metrics = spark.createDataFrame([(0, 0.95), (1, 0.85), (2, 0.92)], "fold int, auc double")
    assert abs(fold_gate_average(scores, metrics, ["k"], "p", "p").head()["p"] - 0.3) < 1e-12
    assert fold_gate_average(scores, metrics, ["k"], "p", "p", gate=0.99).head()["p"] is None


def test_blend(spark):
    a = spark.createDataFrame([("x", 0.5, 0.5)], "k string, t1 double, t2 double")
    b = spark.createDataFrame([("x", 1.0, 1.0)], "k string, t1 double, t2 double")
    row = blend_tables(a, b, "k", "t1", "t2").head()
    assert (round(row["t1"], 12), round(row["t2"], 12)) == (0.7, 0.9)


def test_auc(spark):
    df = spark.createDataFrame([(0.8, 1), (0.8, 0), (0.1, 0), (0.5, None)], "s double, y int")
    assert auc_exact(df, "s", "y").head()["auc"] == 0.75
    assert auc_exact(df.filter("y = 1"), "s", "y").head()["auc"] is None


def test_rank_fusion_of_ties(spark):
    df = spark.createDataFrame([("a", 1.0, 3.0), ("b", 1.0, 2.0), ("c", 2.0, 1.0)], "k string, m double, n double")
    got = {r["k"]: round(r["f"], 9) for r in rank_fusion(df, ["k"], {"m": 1.0, "n": 1.0}, "f").collect()}
    assert got == {k: round((x + y) / 6, 9) for k, x, y in [("a", 1, 3), ("b", 1, 2), ("c", 3, 1)]}


def test_bags(spark):
    df = spark.range(9).select("id", F.when(F.col("id") == 0, 1).otherwise(0).alias("y"))
    one = [tuple(r) for r in negative_bags(df, ["id"], "y").select("id", "bag").collect()]
    three = [tuple(r) for r in negative_bags(df, ["id"], "y", leave_one_out=True).select("id", "bag").collect()]
    for i in range(9):
        assert len({b for k, b in one if k == i}) == (4 if i == 0 else 1)
        assert len({b for k, b in three if k == i}) == (4 if i == 0 else 3)
    assert len(one) == 12 and len(three) == 28


def test_folds_cover_every_row_once(spark):
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    assert df.select(hash_fold(["id"], 10, 1).alias("f")).distinct().count() == 10
    exact = stratified_fold(df, ["id"], "y", 10, 1)
    assert exact.count() == 1003
    sizes = {(r["y"], r["fold"]): r["count"] for r in exact.groupBy("y", "fold").count().collect()}
    for label in (0, 1):
        counts = [n for (y, _), n in sizes.items() if y == label]
        assert len(counts) == 10 and max(counts) - min(counts) <= 1


def test_values_outside_the_dictionary_have_no_code_on_any_path(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "new"), (3, "y"), (4, None)], "k long, c string")
    known = ordinal_dictionary(rows.filter("c IN ('x', 'y')"), ["c"])
    for limits in ({}, {"inline_bytes": 0}, {"inline_bytes": 0, "broadcast_bytes": 0}):
        coded = ordinal_encode(rows, ["c"], ["k"], dictionary=known, **limits)
        assert dict(coded.select("k", "c_encoder").collect()) == {1: 0, 2: None, 3: 1, 4: None}


def test_profile_of_an_empty_table(spark):
    rows = profile_columns(spark.createDataFrame([], "a int, b string")).collect()
    assert sorted(map(tuple, rows)) == [("a", "int", 0, 0, 0), ("b", "string", 0, 0, 0)]


def test_blend_without_one_model(spark):
    a = spark.createDataFrame([("p", 0.5, 1.0), ("q", 0.25, 2.0)], "k string, t1 double, t2 double")
    b = spark.createDataFrame([("p", None, 1.0), ("q", None, None)], "k string, t1 double, t2 double")
    found = {r["k"]: (r["t1"], r["t2"]) for r in blend_tables(a, b, "k", "t1", "t2").collect()}
    assert found["p"][0] == 0.5 and found["q"] == (0.25, 2.0) and found["p"][1] == pytest.approx(1.0)


def test_boosting_with_small_steps_goes_on(spark):
    """Rounds that gain little each are all kept while the held-out loss falls."""
    rows = spark.range(2000).select(
        (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 > 2).cast("double").alias("y"),
        (F.col("id") % 4 == 0).alias("held"))
    trees = Trees(rounds=60, step=0.02, depth=2)
    model = tree_pipeline(["x"], "y", trees, validation="held").fit(rows)
    assert model.stages[-1].getNumTrees > 50


def test_code_statistics_of_large_codes(spark, monkeypatch):
    big = 4_000_000_000
    monkeypatch.setattr(encode, "ordinal_dictionary", lambda df, columns: spark.createDataFrame(
        [("v", "a", big, 2), ("v", "b", big + 1, 1)], "column string, value string, code long, n long"))
    df = spark.createDataFrame([("e", "a"), ("e", "a"), ("e", "b")], "k string, v string")
    row = category_code_stats(df, ["k"], "v", "c").head()
    assert row["c_max"] == big + 1 and row["c_std"] == pytest.approx((1 / 3) ** 0.5)


def test_dictionaries_beyond_the_total_are_joined(spark):
    rows = spark.createDataFrame([(1, "x", "u"), (2, "y", "v"), (3, None, "u")], "k long, c string, d string")
    for total in (0, 200, 1 << 20):
        coded = ordinal_encode(rows, ["c", "d"], ["k"], inline_bytes=0, broadcast_total=total)
        assert {tuple(r) for r in coded.select("k", "c_encoder", "d_encoder").collect()} == {(1, 0, 0), (2, 1, 1), (3, None, 0)}


def test_patience():
    assert stopping_round([3.0, 2.0, 2.5, 2.4, 2.3], 3) == (2, True)
    assert stopping_round([3.0, 2.0, 2.5, 1.9], 3) == (4, False)
    curve = [abs(i - 700) / 100 + 1 for i in range(3000)]
    tried = []
    for first in (10, 250, 3000):
        assert rounds_with_patience(lambda n: tried.append(n) or curve[:n], Trees(3000, 0.1, 2, patience=100), first) == 701
    assert tried[:3] == [10, 20, 40] and max(tried[:-1]) < 3000
    assert rounds_with_patience(lambda n: curve[:n], Trees(300, 0.1, 2, patience=100), 250) == 300


def test_categories_of_many_values_stay_categories(spark):
    """A label that alternates along the codes is one split for a category and out of reach of shallow numeric trees."""
    rows = spark.range(3000).select((F.col("id") % 150).cast("double").alias("c"), (F.col("id") % 2).cast("double").alias("y"))
    assert most_categories(rows, ["c"]) == 150 and most_categories(rows, []) == 0
    model = fit_with_patience(rows, rows, ["c"], "y", Trees(5, 0.5, 1, bins=16), categorical=["c"],
                              max_categories=most_categories(rows, ["c"]))
    assert predict(model, rows, ["y"], "p").filter((F.col("p") > 0.5) != (F.col("y") == 1)).isEmpty()


def test_mean_of_no_model(spark):
    assert mean_score([], spark.range(2), ["id"], "p").filter("p IS NULL").count() == 2
