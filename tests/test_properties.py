"""Random small tables against plain Python."""

import collections

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from riskloom.functions.text import tokenize
from riskloom.operators.aggregates import Feature, entity_features, summary
from riskloom.operators.encode import ordinal_encode
from riskloom.operators.joins import attach, lookup, membership_flags
from riskloom.operators.records import first_record, latest_record
from riskloom.operators.scoring import auc_exact
from riskloom.operators.terms import term_frequencies

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
key = st.one_of(st.none(), st.sampled_from("abcde"))


@few
@given(rows=st.lists(st.tuples(key, st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=60))
def test_attach_never_changes_the_row_count(spark, rows):
    detail = spark.createDataFrame(rows, "k string, v int")
    spine = spark.createDataFrame([(c,) for c in "abcdefg"], "k string")
    stats = entity_features(detail, ["k"], [
        Feature("n", "rows", fill=0), Feature("d", "distinct_incl_null", F.col("v")),
        Feature("e", "distinct_nullable", F.col("v")), *summary("v", F.col("v"))])
    got = {r["k"]: r for r in attach(spine, [stats], ["k"], {"n": 0}).collect()}
    assert len(got) == 7
    for name, row in got.items():
        values = [v for k, v in rows if k == name]
        present = [v for v in values if v is not None]
        assert row["n"] == len(values) and row["d"] == (len(set(values)) or None) and row["e"] == (len(set(present)) or None)
        assert row["v_max"] == (max(present) if present else None) and row["v_min"] == (min(present) if present else None)


@few
@given(rows=st.lists(key, min_size=1, max_size=80), slots=st.sampled_from([1, 3, 256]))
def test_lookup_is_a_left_join(spark, rows, slots):
    left = spark.createDataFrame(list(enumerate(rows)), "id long, k string")
    right = spark.createDataFrame([("a", 1), ("c", 3), ("z", 9)], "k string, v int")
    want = sorted((i, k, {"a": 1, "c": 3}.get(k)) for i, k in enumerate(rows))
    for sampled in (1.0, 0.3):
        assert sorted(tuple(r) for r in lookup(left, right, ["k"], ["id"], slots=slots, sampled=sampled).collect()) == want


@few
@given(rows=st.lists(st.tuples(key, st.one_of(st.none(), st.sampled_from(["2017-1", "2018-1", "2018-2"]))), min_size=1, max_size=60))
def test_first_and_latest(spark, rows):
    df = spark.createDataFrame([(k, d, i) for i, (k, d) in enumerate(rows)], "k string, d string, row long")
    first = {r["k"]: r["row"] for r in first_record(df, ["k"], ["row"], ["row"]).collect()}
    latest = {r["k"]: r["row"] for r in latest_record(df, ["k"], "d", ["row"], ["row"]).collect()}
    for name in {k for k, _ in rows} - {None}:
        own = [(i, d) for i, (k, d) in enumerate(rows) if k == name]
        assert first[name] == own[0][0]
        assert latest[name] == min(own, key=lambda p: (p[1] is None, [-ord(c) for c in p[1] or ""], p[0]))[0]
    assert set(first) == set(latest) == {k for k, _ in rows} - {None}


@few
@given(rows=st.lists(st.tuples(st.sampled_from([0.1, 0.2, 0.2000001, 0.9]), st.sampled_from([0, 1, None])), min_size=1, max_size=60))
def test_auc(spark, rows):
    got = auc_exact(spark.createDataFrame(rows, "s double, y int"), "s", "y").head()["auc"]
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    if pos and neg:
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert abs(got - want) < 1e-12
    else:
        assert got is None


@few
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet="ab 中文，.-", max_size=12)), min_size=1, max_size=20))
def test_term_counts_agree_with_the_tokens(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    tokens = [r[0] or [] for r in df.select(tokenize(F.col("t"))).collect()]
    tf = collections.Counter(t for row in tokens for t in row)
    df_ = collections.Counter(t for row in tokens for t in set(row))
    assert {r["term"]: (r["tf"], r["df"]) for r in term_frequencies(df, F.col("t")).collect()} == {t: (tf[t], df_[t]) for t in tf}
    assert all(t and " " not in t and "，" not in t for t in tf)


@few
@given(values=st.lists(st.one_of(st.none(), st.text(alphabet="aB中é0", max_size=3)), min_size=1, max_size=40),
       limits=st.sampled_from([{}, {"inline_bytes": 0}, {"broadcast_bytes": 0}]))
def test_codes_are_dense_and_ordered(spark, values, limits):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v string")
    place = {v: i for i, v in enumerate(sorted({v for v in values if v is not None}))}
    got = {r["id"]: r["v_encoder"] for r in ordinal_encode(df, ["v"], ["id"], **limits).collect()}
    assert got == {i: place.get(v) for i, v in enumerate(values)}


@few
@given(rows=st.lists(key, max_size=20), listed=st.lists(key, max_size=10))
def test_membership_is_set_membership(spark, rows, listed):
    spine = spark.createDataFrame([(i, k) for i, k in enumerate(rows)], "id long, k string")
    flags = membership_flags(spine, {"f": spark.createDataFrame([(k,) for k in listed], "k string")}, ["k"])
    assert sorted((r["id"], r["f"]) for r in flags.collect()) == [(i, int(k is not None and k in listed)) for i, k in enumerate(rows)]
