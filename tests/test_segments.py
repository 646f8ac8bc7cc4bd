"""Segmentation by a lexicon, and a lexicon learned from text; columns of one meaning found."""

import random

import pytest

from riskloom.operators.profile import discover_same_meaning
from riskloom.operators.segments import best_path, learn_lexicon, lexicon_costs, segment_tokens, with_best_path


def all_paths(text, costs, unknown):
    if not text:
        yield [], 0
    for n in range(1, len(text) + 1):
        cost = costs.get(text[:n], unknown if n == 1 else None)
        if cost is not None:
            for rest, more in all_paths(text[n:], costs, unknown):
                yield [text[:n], *rest], cost + more


def test_best_path_is_the_cheapest_of_all():
    draw = random.Random(0)
    for _ in range(60):
        costs = {"".join(draw.choice("ab") for _ in range(draw.randrange(1, 5))): draw.randrange(1, 9) for _ in range(6)}
        text = "".join(draw.choice("abc") for _ in range(draw.randrange(0, 9)))
        words, cost = best_path(text, costs, 4, 7)
        assert cost == min(c for _, c in all_paths(text, costs, 7)) and "".join(words) == text
        assert cost == sum(costs.get(w, 7) for w in words)


def test_paths_of_odd_texts(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "abc"), (3, "abc"), (4, "x" * 50_000)], "id int, t string")
    found = {r["id"]: (r["words"], r["cost"]) for r in with_best_path(rows, "t", {"ab": 1.0, "c": 2.0}, unknown=3.0).collect()}
    assert found[1] == (None, None) and found[2] == ([], 0.0) and found[3] == (["ab", "c"], 3.0) and found[4][1] == 150_000.0
    assert with_best_path(rows.limit(0), "t", {}).collect() == []


@pytest.fixture(scope="module")
def planted(spark):
    """Unspaced texts of words that share characters with each other, drawn with different frequencies."""
    draw = random.Random(1)
    letters = [chr(ord("一") + 37 * i) for i in range(60)]
    words = list({"".join(draw.choice(letters) for _ in range(draw.choice([2, 2, 3, 4]))) for _ in range(50)})
    texts = [[draw.choice(words[:25] * 2 + words) for _ in range(draw.randrange(3, 12))] for _ in range(1500)]
    return words, texts, spark.createDataFrame([(i, "".join(t)) for i, t in enumerate(texts)], "id int, t string")


def test_a_learned_lexicon_recovers_planted_words(planted):
    words, texts, table = planted
    lexicon = learn_lexicon(table, "t")
    learned = {r["word"] for r in lexicon.collect() if len(r["word"]) > 1}
    assert len(learned & set(words)) >= 0.9 * len(words) and len(learned & set(words)) >= 0.8 * len(learned)
    found = with_best_path(table, "t", lexicon_costs(lexicon)).sort("id").collect()

    def borders(cut):
        at, out = 0, set()
        for word in cut:
            at += len(word)
            out.add(at)
        return out

    right = sum(len(borders(r["words"]) & borders(t)) for r, t in zip(found, texts))
    assert right >= 0.9 * sum(len(borders(t)) for t in texts) and right >= 0.9 * sum(len(r["words"]) for r in found)


def test_figures_of_the_lexicon_are_those_of_plain_counting(spark):
    import math

    table = spark.createDataFrame([("天地人",), ("天地天地",), ("人天地",), (None,), ("abc 天地，人",)], "t string")
    found = {r["word"]: r for r in learn_lexicon(table, "t", longest=2, least=2, cohesion=-9.0, freedom=-1.0).collect()}
    n = {"天": 5, "地": 5, "人": 3, "天地": 5}
    assert {w: found[w]["n"] for w in n} == n and "地天" not in found
    assert found["天地"]["cohesion"] == pytest.approx(math.log(5 * 13 / 25))
    # On the left: three edges, 地 once, 人 once; every edge counts as another neighbour.
    assert found["天地"]["left_freedom"] == pytest.approx(math.log(5))
    assert found["天地"]["cost"] == pytest.approx(-math.log(5 / 13))


def test_terms_of_mixed_text(spark):
    table = spark.createDataFrame([(1, "天地人，abc 天 x天地y"), (2, "no han"), (3, ""), (4, None), (5, "天地\n人")], "id int, t string")
    found = {r["id"]: r["tokens"] for r in segment_tokens(table, "t", {"天地": 1.0, "人": 1.0, "天": 2.0}).collect()}
    assert found == {1: ["天地", "人", "abc", "天", "x", "天地", "y"], 2: ["no", "han"], 3: [], 4: None, 5: ["天地", "人"]}


def test_columns_of_one_meaning_are_found(spark):
    rows = [(i, i % 7, f"n{i % 7}", None if i % 7 == 0 else i % 7, i % 14, "same", str(i)) for i in range(200)]
    df = spark.createDataFrame(rows * 2, "a int, b int, c string, d int, e int, f string, `g.h` string")
    found = {tuple(r) for r in discover_same_meaning(df).collect()}
    assert found == {("a", "g.h"), ("b", "c"), ("b", "d"), ("c", "d")}
    assert discover_same_meaning(df.limit(0)).collect() == []
