"""Merkle manifests against plain recursion, with blocks so small that every level is used."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, rank int, leaf string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def record(row, n_chars):
    fields = (row[0], row[1], row[2], n_chars, row[4])
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def tree(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, at):
    for level in levels[:-1]:
        other = at ^ 1
        yield at % 2, level[other] if other < len(level) else None
        at //= 2


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = []
    for lang in langs:
        own = [(r[0], record(r, r[3]), r) for r in rows if r[2] == lang]
        groups.append(sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1])))
    trees = [tree([r[1] for r in own]) for own in groups]
    top = tree([t[-1][0] for t in trees]) if trees else []
    out = []
    for g, (own, levels) in enumerate(zip(groups, trees)):
        for at, (doc_id, leaf, row) in enumerate(own):
            steps = [*path(levels, at), *path(top, g)]
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and row[3] is not None
            now = record(row, row[3] + 1) if tampered else leaf
            for side, other in steps:
                now = h(now) if other is None else h(other, now) if side else h(now, other)
            out.append((doc_id, leaf, levels[-1][0], top[-1][0], h(*(o for _, o in steps if o)), now, now == top[-1][0]))
            assert (now == top[-1][0]) == (not tampered)
    return sorted(map(repr, out))


def found(spark, rows):
    return sorted(repr(tuple(r)) for r in merkle.document_proofs(frame(spark, rows)).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("levels", range(1, 12))
def test_addresses_are_a_layout_of_aligned_subtrees(levels):
    places = merkle.addresses(levels)
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
    # Every subtree that the recursion cuts off lies in one run of addresses.
    top = max(1, levels // 2)
    for root in range(1 << top if levels > 1 else 0):
        below = np.concatenate([places[d][root << (d - top):(root + 1) << (d - top)] for d in range(top, levels)])
        assert below.max() - below.min() == len(below) - 1


def test_address_order_of_four_levels():
    assert [p.tolist() for p in merkle.addresses(4)] == [[0], [1, 2], [3, 6, 9, 12], [4, 5, 7, 8, 10, 11, 13, 14]]


@pytest.mark.parametrize("height", [1, 2, 10])
def test_proofs_are_those_of_plain_recursion(spark, monkeypatch, height):
    monkeypatch.setattr(merkle.build_manifest, "__defaults__", (None, height))
    sizes = {"en": 37, "de": 8, "fr": 1, "": 2, "ß": 5, None: 3}
    ids = itertools.count(1)
    rows = [(next(ids), "s", lang, 5, f"text {i}") for lang, n in sizes.items() for i in range(n)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows[:37]) == plain(rows[:37])
    assert found(spark, rows[45:46]) == plain(rows[45:46])


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(None, None, None, None, None), (None, "a", None, 1, ""), (2**62 + 1, "b", "en", None, "é日本"), (2**62 + 3, "b", "en", 2**63 - 1, "x"),
            (5, "c", "en", 1, "same"), (5, "c", "en", 1, "same"), (5, "d", "en", 1, "same"), (6, "", "de", -3, "word " * 300_000)]
    rows += [(9, "hot", "es", 4, "copy")] * 50 + [(i, "s", "es", 1, "t") for i in range(40)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_hot_group_is_spread_and_order_of_rows_does_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = sorted(map(repr, merkle.document_proofs(docs).collect()))
    other = sorted(map(repr, merkle.document_proofs(docs.repartition(9, F.xxhash64("text")).withColumn("rank", F.lit(1))).collect()))
    assert one == other
    assert one == sorted(map(repr, merkle.document_proofs(docs.sort("text")).collect()))


def test_manifest_is_written_with_all_blocks(spark, tmp_path, monkeypatch):
    docs = frame(spark, [(i, "s", "en" if i % 3 else "de", 5, f"text {i}") for i in range(30)])
    made = merkle.build_manifest(docs, merkle.record_digest([F.col("text")]), "lang", "doc_id", None, 2)
    made.write(str(tmp_path / "manifest"))
    blocks = spark.read.parquet(str(tmp_path / "manifest"))
    # 20 leaves: 5 blocks, 2 above them, 1 on top; 10 leaves: 3 blocks and 1; the tops of both: 1.
    assert [tuple(r) for r in blocks.groupBy("part", "level").count().sort("part", "level").collect()] == [
        ("group", 0, 8), ("group", 1, 3), ("group", 2, 1), ("top", 0, 1)]
    assert blocks.filter("part = 'top'").head()["root"] == made.root
    leaves = {hashlib.sha256(f"{len(f'text {i}')}:text {i}".encode()).digest() for i in range(30)}
    held = set()
    for r in blocks.filter("part = 'group' AND level = 0").collect():
        nodes = np.frombuffer(bytes(r["nodes"]), np.uint8).reshape(-1, 32)
        places = merkle.addresses(len(nodes).bit_length())[-1][:r["members"]]
        held |= {nodes[p].tobytes() for p in places}
    assert held == leaves
