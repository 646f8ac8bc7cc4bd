"""The source mix against plain sums, exact quotas and what the shards really hold."""

import collections
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string, rank int, place string, of string, n string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", "n") for r in rows], SCHEMA)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Stop whoever is above, share the rest anew, in exact fractions."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, fixed = Fraction(3, 2) * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 2 * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed.update({s: Fraction(2 * sizes[s]) for s in above})


def check(rows, found, tolerance=1):
    sizes, taken, wanted = collections.Counter(), collections.Counter(), collections.Counter()
    for _, source, text in rows:
        sizes[source] += words(text)
        wanted[source] += 0
    targets = plain_targets(dict(sizes)) if rows else {}
    by_id = collections.Counter((r["doc_id"], r["size"]) for r in found)
    assert by_id == collections.Counter((i, words(t)) for i, _, t in rows)
    of = {}
    for i, source, text in rows:
        of.setdefault((i, words(text)), set()).add(source)
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sources = of[r["doc_id"], r["size"]]
        assert any(r["source_size"] == sizes[s] and abs(r["target"] - targets[s]) < 1e-6 for s in sources)
        if len(sources) == 1:
            taken[next(iter(sources))] += r["taken"]
            wanted[next(iter(sources))] = targets[next(iter(sources))]
    for source, words_taken in taken.items():
        assert abs(words_taken - wanted[source]) <= tolerance


def documents(n, seed=0):
    draw = np.random.default_rng(seed)
    return [(i, f"s{min(int(draw.integers(0, 14)), 6)}", " ".join(["w"] * int(draw.integers(0, 60)))) for i in range(n)]


def test_word_count_of_odd_texts(spark):
    texts = [None, "", " ", "a", " a", "a ", "a\tb\nc\x0bd\x0ce\rf g", "   x　y", "\x1c \x85", "日本 語", "x " * 200_000, " " * 300_000]
    made = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", mixing.word_count(F.col("t")).alias("n"))
    assert [r["n"] for r in made.sort("i").collect()] == [words(t) for t in texts]


@pytest.mark.parametrize("block_words, shard_blocks", [(16, 4), (7, 1), (1 << 16, 64)])
def test_quotas_are_exact_whatever_the_blocks(spark, block_words, shard_blocks):
    rows = documents(300)
    docs = table(spark, rows)
    made, pieces = mixing.mix_sources(docs, block_words=block_words, shard_blocks=shard_blocks)
    found = made.collect()
    check(rows, found)
    again, _ = mixing.mix_sources(docs.repartition(7), block_words=block_words, shard_blocks=shard_blocks)
    assert sorted(map(repr, found)) == sorted(map(repr, again.collect()))
    held = pieces.collect()
    assert sum(p["words"] for p in held) == sum(r["taken"] for r in found)
    # Only the document that reaches a source's quota is cut.
    assert sum(p["words"] < p["size"] for p in held) <= len({r[1] for r in rows})
    places = collections.defaultdict(list)
    for p in held:
        places[p["shard"]].append(p["place"])
    assert all(sorted(own) == list(range(len(own))) for own in places.values())


def test_the_mix_itself(spark):
    rows = documents(200, 3) + [(7, "s0", "one two  three\nfour")] * 3 + [(None, None, "no name at all")] * 4
    docs = table(spark, rows)
    made, pieces = mixing.mix_sources(docs, block_words=16, shard_blocks=4)
    texts = mixing.mixed_texts(docs, pieces).collect()
    taken = collections.Counter()
    for r in made.collect():
        taken[r["doc_id"]] += r["taken"]
    got = collections.Counter()
    known = collections.defaultdict(set)
    for i, _, t in rows:
        known[i].add(t)
    for r in texts:
        got[r["doc_id"]] += words(r["text"])
        assert any(t.startswith(r["text"]) for t in known[r["doc_id"]])
    assert +got == +taken


def test_odd_tables(spark):
    same = "the very same words"
    odd = [(None, None, None), (None, None, ""), (1, "b", " "), (2, "é", "x"), (2, "é", "x"), (2, "z", "x y"), (3, "", "long " * 100_000)]
    hot = [(None, "hot", same)] * 400 + [(5, "hot", same)] * 100 + [(i, "hot", f"w{i}") for i in range(10, 60)]
    for rows in (odd, hot, odd + hot, [(1, "only", "a b c")], [(1, "a", None), (2, None, "")], []):
        check(rows, mixing.mix_sources(table(spark, rows))[0].collect())


def test_repeats_are_listed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 16)
    rows = [(None, "hot", "a b c")] * 100 + [(i, "s", "x") for i in range(5)]
    check(rows, mixing.mix_sources(table(spark, rows), block_words=16, shard_blocks=2)[0].collect())


def test_splitting_tree_keeps_counts_and_mixes(spark):
    counts = np.array([4000, 2000, 1000, 1])
    leaves = list(mixing.descend(1, 0, 37, np.arange(4), counts, np.zeros(4, np.int64), 20))
    assert [leaf[1] for leaf in leaves] == list(range(37)) and all(leaf[2] == 1 for leaf in leaves)
    total, starts = np.zeros(4, np.int64), np.zeros(4, np.int64)
    for *_, ranks, own, begin in leaves:
        assert (begin == starts[ranks]).all()
        starts[ranks] += own
        total[ranks] += own
        assert abs(own.sum() - 7001 / 37) < 3 and abs(own[0] - 4000 / 37) < 40
    assert (total == counts).all()
    twice = list(mixing.descend(1, 0, 37, np.arange(4), counts, np.zeros(4, np.int64), 20))
    assert all((a[4] == b[4]).all() for a, b in zip(leaves, twice))
    # In two jobs of a few levels each the same leaves come out.
    upper = mixing.descend(1, 0, 37, np.arange(4), counts, np.zeros(4, np.int64), 3)
    lower = [leaf for node in upper for leaf in mixing.descend(*node, 20)]
    assert all((a[4] == b[4]).all() and a[1] == b[1] for a, b in zip(leaves, lower))


@pytest.mark.parametrize("blocks", [1, 2, 3, 10, 64, 1001])
def test_draws_are_a_permutation(blocks):
    assert sorted(mixing.drawn_block(np.arange(blocks), blocks, 5).tolist()) == list(range(blocks))


def test_many_sources_go_down_in_several_jobs(spark):
    rows = [(i, f"s{i % 40}", "w " * (1 + i % 9)) for i in range(400)]
    made, _ = mixing.mix_sources(table(spark, rows), block_words=2, shard_blocks=1)
    check(rows, made.collect())
