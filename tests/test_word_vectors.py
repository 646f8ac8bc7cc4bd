"""Training of word vectors: codes, shares that grow with the corpus, words of one context close together."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.operators import word_vectors
from riskloom.operators.terms import document_vectors, fit_word_vectors
from riskloom.operators.word_vectors import Settings, huffman, learn, paths, subtree, sums_of_shares
from riskloom.session import application_folder


def test_codes_are_those_of_huffman():
    counts = np.array([8, 4, 2, 1, 1])
    parent, bit = huffman(counts)
    nodes, labels, used = paths(np.arange(5), parent, bit, 5)
    assert used.sum(1).tolist() == [1, 2, 3, 4, 4]
    codes = {tuple(zip(n[u > 0], l[u > 0])) for n, l, u in zip(nodes, labels, used)}
    assert len(codes) == 5 and nodes.max() == 3
    assert huffman(np.array([3]))[0].tolist() == [-1]


def test_one_position_takes_the_step_of_the_formula():
    """Two words of one text: each learns the other's path, all from the scores before the run."""
    parent, bit = huffman(np.array([2, 1]))
    words, inner = np.array([[0.1, 0.2], [0.3, -0.1]], np.float32), np.array([[0.5, 0.4]], np.float32)
    old, node = words.astype(float), inner.astype(float)[0]
    met = learn(np.array([0, 1], np.int32), np.zeros(2, int), words, inner, parent, bit, 1, np.full(2, 0.1, np.float32), np.random.default_rng(0))
    step = [0.1 * (1 - bit[word] - 1 / (1 + np.exp(-old[1 - word] @ node))) for word in (0, 1)]
    assert met.tolist() == [0]
    assert inner[0] == pytest.approx(node + step[0] * old[1] + step[1] * old[0], rel=1e-5)
    assert words == pytest.approx(np.stack([old[0] + step[1] * node, old[1] + step[0] * node]), rel=1e-5)


def test_shares_grow_with_the_corpus(spark, monkeypatch):
    asked = []
    from pyspark.sql.classic.dataframe import DataFrame
    repartition = DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda self, n, *c: asked.append(n) or repartition(self, n, *c))
    monkeypatch.setattr(word_vectors, "SHARE", 300)
    draw = np.random.default_rng(0)
    texts = [" ".join(f"{'ab'[i % 2]}{k}" for k in draw.integers(0, 10, 12)) for i in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "once", "", None])], "id int, text string")
    model = fit_word_vectors(df, F.col("text"), iterations=3)
    assert asked == [16] * 3  # 4,800 terms
    found = {r["word"]: r["vector"].toArray() for r in model.getVectors().collect()}
    assert set(found) == {f"{c}{k}" for c in "ab" for k in range(10)}
    unit = {w: v / np.linalg.norm(v) for w, v in found.items()}
    same = np.mean([unit[f"a{i}"] @ unit[f"a{j}"] for i in range(10) for j in range(i)])
    other = np.mean([unit[f"a{i}"] @ unit[f"b{j}"] for i in range(10) for j in range(10)])
    assert same > other + 0.2
    rows = {r["id"]: [r["x"], r["y"]] for r in document_vectors(df, model, F.col("text"), ["x", "y"]).collect()}
    assert rows[400] == rows[401] == rows[402] == [0.0, 0.0]
    assert rows[0] == pytest.approx(np.mean([found[w][:2] for w in texts[0].split()], 0))


def test_a_share_works_on_the_part_of_the_tree_above_its_words():
    counts = np.sort(np.random.default_rng(0).integers(1, 1000, 50))[::-1]
    parent, bit = huffman(counts)
    known = np.array([0, 7, 31, 49])
    above, own_parent, own_bit = subtree(known, parent, bit)
    whole, own = paths(known, parent, bit, 50), paths(np.arange(4), own_parent, own_bit, 4)
    on = whole[2] > 0
    assert (own[2] == whole[2]).all() and (above[own[0]][on] == whole[0][on]).all() and (own[1][on] == whole[1][on]).all()
    assert set(above) == set(whole[0][on])
    assert [x.tolist() for x in subtree(np.array([0]), *huffman(np.array([3])))] == [[], [-1], [0]]


def test_a_task_hands_out_one_sum_of_all_its_shares(monkeypatch):
    """Whatever the number of shares, a place is handed out once; shares do not see each other's steps."""
    monkeypatch.setattr(word_vectors, "BLOCK", 4)
    draw = np.random.default_rng(0)
    tree, settings = huffman(np.arange(20, 0, -1)), Settings(3, 2, 1, 0, 2, 6)
    vectors = draw.random((39, 3), np.float32)
    texts = [draw.integers(0, 20 - i, 9).astype(np.int32) for i in range(9)]
    batch = lambda rows: pa.RecordBatch.from_pylist(
        [{"share": i // 3, "ids": texts[i]} for i in rows], pa.schema([("share", pa.int32()), ("ids", pa.list_(pa.int32()))]))

    def handed_out(iteration, *batches):
        sums, times, rows = np.zeros((39, 3)), np.zeros(39, int), 0
        for out in sums_of_shares(iter(batches), vectors, tree, settings, 3, 81, iteration):
            for row in out.to_pylist():
                assert {p // 4 for p in row["places"]} == {row["block"]} and not times[row["places"]].any()
                sums[row["places"]], times[row["places"]] = np.reshape(row["sums"], (-1, 3)), row["times"]
                rows += 1
        return sums, times, rows

    alone = [handed_out(0, batch(range(i, i + 3))) for i in (0, 3, 6)]
    together = handed_out(0, batch(range(4)), batch(range(4, 9)))
    assert together[0] == pytest.approx(sum(a[0] for a in alone), rel=1e-5) and together[2] <= 10 < sum(a[2] for a in alone)
    assert (together[1] == sum(a[1] for a in alone)).all() and together[1].max() == 3 and together[1][-1] == 3
    assert not handed_out(1, batch(range(9)))[1][20:].any()  # nobody reads the nodes after the last iteration


def test_training_leaves_no_table_and_no_shuffle_file(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in files.getAllFiles().mkString("\n").split("\n") if "shuffle_" in os.path.basename(f)}
    before = shuffles()
    df = spark.createDataFrame([("a b c d e f g h",), (None,)] * 50, "text string").repartition(4)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    fit_word_vectors(df, F.col("text"), iterations=2)
    assert not shuffles() - before and spark.conf.get(setting, None) is None
    folder = application_folder(spark).removeprefix("file:")
    assert not [x for x in (os.listdir(folder) if os.path.isdir(folder) else []) if x.startswith("word-vector")]


def test_means_are_those_of_the_model(spark):
    rows = [(i, t) for i, t in enumerate(["a b a", "a once b b", "企业 a,b", "", "once", None, "twice twice"] * 3 + ["rare a"])]
    df = spark.createDataFrame(rows, "id int, text string")
    vectors = fit_word_vectors(df, F.col("text"), iterations=1)
    own, names = [], [f"v{i}" for i in range(10)]
    for model in (vectors, vectors.model):
        found = document_vectors(df, model, F.col("text"), names)
        assert found.columns == ["id", "text", *names]
        own.append(sorted(found.drop("text").collect()))
    assert np.array(own[0]) == pytest.approx(np.array(own[1]), rel=1e-12) and len(own[0]) == len(rows)
    assert not any(own[0][5][1:]) and any(own[0][0][1:])
