"""The whole job on small raw tables, against a row-by-row recomputation."""

import datetime as dt
import re
import statistics

import pytest
from pyspark.ml.feature import Word2VecModel
from pyspark.sql import functions as F

from riskloom.operators.models import Trees, load_tree_model, save_model, tree_pipeline
from riskloom.plans import features as plan
from riskloom.plans import job
from riskloom.plans.scoring import (
    CATEGORICAL, FEATURES_A1, FEATURES_A2, FEATURES_B1, FEATURES_B2, Settings, apply_rules, model_tables, rule_flags,
    score_enterprises)
from riskloom.sources.sinks import write_tables
from riskloom.sources.tables import NULL_TEXTS, read_raw, read_scores, read_staged

SPLITS = ("train", "test")


@pytest.fixture(scope="module")
def tables(spark, raw, tmp_path_factory):
    root, _ = raw
    folder = str(tmp_path_factory.mktemp("staged"))
    write_tables(read_raw(spark, root), folder)
    return read_staged(spark, folder)


@pytest.fixture(scope="module")
def built(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features"))
    from riskloom.sources.sinks import write_features

    write_features(plan.build_features(tables), path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def expected(raw):
    """``{(split, table): {name: [rows in file order]}}`` with null texts as None."""
    _, written = raw
    grouped = {}
    for (table, split), rows in written.items():
        for row in rows:
            clean = {k: None if v in NULL_TEXTS else v for k, v in row.items()}
            if clean["qymc"]:
                grouped.setdefault((split, table), {}).setdefault(clean["qymc"], []).append(clean)
    return grouped


def rows_of(built):
    return {(r["split"], r["qymc"]): r for r in built.collect()}


def parse(text):
    if text is None:
        return None
    for form in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%Y/%m/%d"):
        try:
            return dt.datetime.strptime(text, form)
        except ValueError:
            pass


def test_spine_and_labels(built, expected):
    got = rows_of(built)
    assert set(got) == {(s, n) for s in SPLITS for n in expected[s, "base"]}
    for (split, name), row in got.items():
        first = expected[split, "base"][name][0]
        assert (row["zch"], row["hymldm"], row["is_chusai"]) == (first["zch"], first["hymldm"], first["is_chusai"])
        assert row["is_shixin"] == int(name in expected.get((split, "dishonest"), {}))
        assert row["is_chufa"] == int(name in expected.get((split, "punished"), {}))


def test_counts_and_statistics(built, expected):
    for (split, name), row in rows_of(built).items():
        base = expected[split, "base"][name]
        assert row["QYJL_number"] == len(base)
        assert row["QY_tzrgs"] == len({r["tzr"] for r in base})
        assert row["QY_zwzls"] == len({r["zw"] for r in base})
        assert row["QY_fddbrbz_gs"] == (sum(r["fddbrbz"] == "是" for r in base) or None)
        shares = [float(r["czbl"]) for r in base if r["czbl"]]
        assert row["czbl_max"] == (max(shares) if shares else None)
        assert (row["czbl_std"] is None) == (len(shares) < 2)
        if len(shares) > 1:
            assert abs(row["czbl_std"] - statistics.stdev(shares)) < 1e-9
        for table, topic in plan.TOPICS.items():
            assert row[f"{topic}_number"] == len(expected[split, table].get(name, [])), (topic, name)
        jobs = expected[split, "recruitment"].get(name, [])
        for column in ("zylb", "zprs", "zprq"):
            assert row[f"ZPSJ_{column}_kinds"] == (len({r[column] for r in jobs} - {None}) or None)
        heads = [int(re.findall(r"\d+", r["zprs"])[0]) for r in jobs if r["zprs"] and re.findall(r"\d+", r["zprs"])]
        assert row["ZPSJ_zprs_max"] == (max(heads) if heads else None)
        if heads:
            assert abs(row["ZPSJ_zprs_mean"] - statistics.mean(heads)) < 1e-9


def test_picked_records_dates_and_gaps(built, expected):
    for (split, name), row in rows_of(built).items():
        for pick in plan.PICKS:
            topic = plan.TOPICS[pick.table]
            records = expected[split, pick.table].get(name, [])
            if not records:
                assert all(row[f"{topic}_{c}"] is None for c in pick.columns)
                continue
            best = records[0]
            if pick.by:
                for record in records[1:]:
                    if (record[pick.by] or "") > (best[pick.by] or ""):
                        best = record
            for column in pick.columns:
                value = row[f"{topic}_{column}"]
                want = best[column]
                if f"{topic}_{column}" in plan.TOPIC_DATES:
                    want = parse(want)
                elif column in ("yynx", "dfbm"):
                    want = float(want) if want else None
                assert value == want, (pick, column)
        founded = parse(expected[split, "base"][name][0]["clrq"])
        assert row["clrq"] == founded.replace(hour=0)
        assert (row["clrq_year"], row["clrq_month"], row["clrq_day"]) == (founded.year, founded.month, founded.day)
        for gap, start, end in plan.GAPS:
            a, b = row[start], row[end]
            assert row[gap] == (None if a is None or b is None else (b - a).days)


def test_branch_and_registration(built, expected):
    for (split, name), row in rows_of(built).items():
        branches = expected[split, "branch"].get(name)
        assert row["has_branch"] == int(branches is not None)
        assert row["is_FZ_die"] == int(bool(branches and branches[0]["fzswsj"]))
        assert row["fzqymc"] == (branches[0]["fzqymc"] if branches else None)
        registered = expected[split, "registration"][name][0]
        assert row["jyfw"] == registered["jyfw"]
        address = registered["jgdzzs"]
        assert row["jgdzzs_top3"] == (address[:3] if address else None)
        assert row["xzgh_city"] == registered["xzgh"][2:4]
        vector = [row[f"jyfw_array_{i}_fea"] for i in range(10)]
        assert any(vector) == (registered["jyfw"] is not None)


def test_codes_are_joint_and_dense(built):
    rows = built.collect()
    for column in plan.ENCODED_COLUMNS:
        texts = sorted({str(r[column]) for r in rows if r[column] is not None})
        place = {t: i for i, t in enumerate(texts)}
        for r in rows:
            assert r[f"{column}_encoder"] == (None if r[column] is None else place[str(r[column])]), column


def test_parsed_order_differs_only_in_latest(spark, tables):
    text = plan._picked(tables, plan.PICKS[2], "text").count()
    assert text == plan._picked(tables, plan.PICKS[2], "parsed").count()


def test_feature_lists(built):
    assert [len(f) for f in (FEATURES_A1, FEATURES_A2, FEATURES_B1, FEATURES_B2)] == [79, 85, 49, 87]
    assert {*FEATURES_A1, *FEATURES_A2, *FEATURES_B1, *FEATURES_B2, *CATEGORICAL} <= set(built.columns)


def test_rules_zero_outside_the_province(spark, tables, built):
    flags = rule_flags(tables, built)
    scores = built.filter("split = 'test'").select("qymc", F.lit(0.5).alias("FORTARGET1"), F.lit(0.5).alias("FORTARGET2"))
    got = {r["qymc"]: r["FORTARGET1"] for r in apply_rules(scores, flags).collect()}
    known = {r["qymc"]: r for r in flags.collect()}
    assert set(got) == set(known)
    for name, score in got.items():
        f = known[name]
        want = 0.0 if f["zsszdsf"] != "江苏省" or f["is_fr"] else 0.5 / (1.5 if f["is_fzc"] else 1) / (3 if f["is_fz"] else 1) / (2 if f["is_qq"] else 1)
        assert abs(score - want) < 1e-12


def test_tree_model_round_trip(spark, built, tmp_path):
    train, test = model_tables(built)
    model = tree_pipeline(FEATURES_B1[:8], "is_chufa", Trees(2, 0.1, 2, bins=16)).fit(train)
    save_model(model, str(tmp_path / "m"))
    again = load_tree_model(str(tmp_path / "m"))
    assert again.transform(test).select("probability").collect() == model.transform(test).select("probability").collect()


def test_score_all(spark, tables, built):
    small = Trees(2, 0.1, 2, bins=32)
    scores = score_enterprises(tables, built, Settings(bags=2, folds=2, a1=small, a2=small, b1=small, b2=small, extended=True))
    rows = scores.collect()
    assert {r["qymc"] for r in rows} == {r["qymc"] for r in built.filter("split = 'test'").select("qymc").collect()}
    assert all(r[c] is not None and 0 <= r[c] <= 1 for r in rows for c in ("FORTARGET1", "FORTARGET2"))


def test_job_steps(spark, raw, tmp_path):
    root, _ = raw
    tables, target = str(tmp_path / "tables"), str(tmp_path / "features")
    job.ingest(spark, root, tables)
    job.features(spark, tables, target)
    assert Word2VecModel.load(f"{target}-word-vectors").getVectors().count() > 0
    small = Trees(1, 0.1, 2, bins=32)
    job.score(spark, tables, target, str(tmp_path / "scores"), Settings(bags=2, folds=2, a1=small, a2=small, b1=small, b2=small))
    assert read_scores(spark, str(tmp_path / "scores")).count() == spark.read.parquet(target).filter("split = 'test'").count()


def test_reports(spark, tables, expected):
    from riskloom.plans import reports

    base = expected["train", "base"]
    shares = {r["table_name"]: r for r in reports.coverage(tables).collect()}
    for table in ("branch", "registration", "revocation", "recruitment"):
        known = len(set(base) & set(expected["train", table]))
        assert shares[table]["n_entities"] == known and abs(shares[table]["share"] - known / len(base)) < 1e-12
    overlap = {r["combination"]: r["n_keys"] for r in reports.overlap_with_targets(tables).collect()}
    listed, taxed = expected["train", "dishonest"], expected["train", "tax"]
    assert overlap["tax&dishonest"] == len(set(listed) & set(taxed))
    province = {n for n, rows in base.items() if rows[0]["zsszdsf"] == "江苏省"}
    assert overlap["province&registration&dishonest"] == len(province & set(listed) & set(expected["train", "registration"]))

    rates = {(r["table_name"], r["value"]): r for r in reports.target_rates(tables).collect() if r["category"] == "shdw"}
    for value in {row["shdw"] for s in SPLITS for rows in expected[s, "tax"].values() for row in rows} - {None}:
        hits = [(s, n) for s in SPLITS for n, rows in expected[s, "tax"].items() for row in rows if row["shdw"] == value]
        marked = [int(n in expected.get((s, "dishonest"), {})) for s, n in hits if n in expected[s, "base"]]
        row = rates["tax", value]
        assert (row["n_rows"], row["is_shixin_sum"]) == (len(hits), sum(marked))
        assert abs(row["is_shixin_mean"] - sum(marked) / len(marked)) < 1e-12

    assert sum(r["n_rows"] for r in reports.balance(tables).collect()) == sum(len(expected[s, "base"]) for s in SPLITS)
    assert reports.branch_names(tables, "fz").count() == tables["branch"].filter("fzqymc IS NOT NULL").count()
    profile = {r["column"]: r for r in reports.profile(tables, "tax").collect()}
    assert profile["shdw"]["n_present"] == tables["tax"].filter("shdw IS NOT NULL").count()
    assert {r["reason"] for r in reports.columns_to_drop(tables, "tax").collect()} <= {"sparse", "constant", "same meaning"}


def test_term_stacking_scores_every_enterprise_once(spark, built):
    from riskloom.functions.text import user_tokenizer
    from riskloom.plans.stacking import term_stacking

    for tokens in ({}, {"tokens": user_tokenizer(str.split)}):
        scored = term_stacking(built, "is_chufa", "term_score", terms=50, folds=2, **tokens)
        assert scored.count() == scored.select(*plan.KEY).distinct().count() == built.count()
        assert scored.filter("term_score IS NULL OR term_score < 0 OR term_score > 1").count() == 0
