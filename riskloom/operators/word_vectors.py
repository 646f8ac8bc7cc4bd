"""Skip-gram training with hierarchical softmax: Spark counts, deals out and averages, tasks add up steps in numpy.

It is the training of Spark's ``Word2Vec`` (shares of the texts, vectors averaged after each iteration), with as many
shares as the corpus asks for, and a step for a whole run of positions at once.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from riskloom.session import shuffles_removed, staged

# Fixed values, those of Spark's Word2Vec: first learning rate, and the scores beyond which a node is learned.
RATE = 0.025
MOST_SCORE = 6.0

#: Terms of a share beyond the least number of shares; a share is trained on its own, from the vectors of the iteration.
SHARE = 250_000
#: The most terms of a task, which trains shares one after the other and hands out the sums of their vectors.
TASK = 64_000_000
#: Positions whose steps are taken together, and about how many are looked up at once.
RUN, CHUNK = 64, 20_000
#: Vectors that travel as one row, rows of a batch, and rows that the driver reads at once.
BLOCK, ROWS, READ = 1024, 64, 1024


@dataclass(frozen=True)
class Settings:
    size: int
    window: int
    min_count: int
    seed: int
    iterations: int
    sentence: int


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent and bit of every node; leaves come first, by falling count, then inner nodes, the root last (parent -1)."""
    n = len(counts)
    nodes = n + max(n - 1, 0)
    weight = array("q", np.concatenate([counts, np.zeros(nodes - n)]).astype(np.int64).tobytes())
    parent, bit = array("i", [-1]) * nodes, array("b", [0]) * nodes
    leaf, inner = n - 1, n
    for made in range(n, nodes):
        for side in range(2):
            if leaf >= 0 and (inner >= made or weight[leaf] < weight[inner]):
                least, leaf = leaf, leaf - 1
            else:
                least, inner = inner, inner + 1
            weight[made] += weight[least]
            parent[least], bit[least] = made, side
    return np.array(parent, np.int32), np.array(bit, np.int8)


def subtree(known: np.ndarray, parent: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inner nodes above some words (from 0), and the tree of only these words and nodes, numbered in this order."""
    n = len(parent) // 2 + 1
    met, at = np.zeros(len(parent), bool), parent[known]
    while len(at := at[at >= 0]):
        at = np.unique(at)
        at = at[~met[at]]
        met[at] = True
        at = parent[at]
    above = np.flatnonzero(met)
    nodes = np.concatenate([known, above])
    up = parent[nodes]
    return above - n, np.where(up >= 0, np.searchsorted(above, up) + len(known), -1), bit[nodes]


def paths(words: np.ndarray, parent: np.ndarray, bit: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inner nodes above each word (from 0), their labels, and which places are used."""
    at, nodes, labels = words.astype(np.int64), [], []
    while len(at) and (above := parent[at]).max() >= 0:
        nodes.append(np.where(above >= 0, above - n, -1))
        labels.append(1 - bit[at])
        at = np.where(above >= 0, above, at)
    if not nodes:
        return tuple(np.zeros((len(words), 0), t) for t in (np.int64, np.float32, np.float32))
    nodes = np.stack(nodes, 1)
    return np.maximum(nodes, 0), np.stack(labels, 1).astype(np.float32), (nodes >= 0).astype(np.float32)


def learn(ids: np.ndarray, text: np.ndarray, words: np.ndarray, inner: np.ndarray, parent: np.ndarray, bit: np.ndarray,
          window: int, rates: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Steps for every position of some texts, in place; returns the inner nodes met."""
    size, n = words.shape[1], len(ids)
    known, which = np.unique(ids, return_inverse=True)
    nodes, labels, used = paths(known, parent, bit, len(words))
    depth, labels = used.sum(1).astype(np.int64), labels - np.float32(0.5)
    offsets = np.array([k for k in range(-window, window + 1) if k])
    padded = np.concatenate([ids[:1].repeat(window), ids, ids[:1].repeat(window)])
    texts = np.concatenate([np.full(window, -1), text, np.full(window, -1)])
    width = draw.integers(1, window + 1, n)
    flat_words, flat_inner, columns = words.reshape(-1), inner.reshape(-1), np.arange(size)
    near = np.stack([(abs(k) <= width) & (texts[window + k:window + k + n] == text) for k in offsets], 1).astype(np.float32)
    near *= rates[:, None]
    places = np.arange(RUN)[:, None] + window + offsets
    for first in range(0, n, RUN):
        end = min(first + RUN, n)
        own, at, close = which[first:end], places[:end - first], near[first:end]
        top = depth[own].max()
        above, on = nodes[own, :top], used[own, :top]
        around = padded[first:end + 2 * window]
        vectors = words.take(around, 0)
        context, softmax = vectors.take(at, 0), inner.take(above, 0)
        score = context @ softmax.transpose(0, 2, 1)
        step = np.tanh(score * np.float32(-0.5))
        step *= np.float32(0.5)
        step += labels[own, :top][:, None, :]
        step *= close[:, :, None]
        step *= on[:, None, :]
        step *= np.abs(score, out=score) < MOST_SCORE
        of_words, of_inner = step @ softmax, step.transpose(0, 2, 1) @ context
        moved = np.zeros_like(vectors)
        for place, part in zip(window + offsets, of_words.transpose(1, 0, 2)):
            moved[place:place + end - first] += part
        np.add.at(flat_inner, (above[:, :, None] * size + columns).ravel(), of_inner.ravel())
        np.add.at(flat_words, (around[:, None] * size + columns).ravel(), moved.ravel())
    met = np.zeros(len(inner), bool)
    met[nodes[used > 0]] = True
    return np.flatnonzero(met)


def _shares(batches: Iterator[pa.RecordBatch], sentence: int) -> Iterator[list[np.ndarray]]:
    """The texts of one share after the other, a long text in pieces of ``sentence`` terms."""
    last, texts = None, []
    for batch in batches:
        share = batch.column("share").to_numpy()
        lists = batch.column("ids")
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        for of, start, end in zip(share, np.concatenate([[0], ends[:-1]]), ends):
            if texts and of != last:
                yield texts
                texts = []
            last = of
            texts += [flat[at:min(at + sentence, end)] for at in range(start, end, sentence)]
    if texts:
        yield texts


def _chunks(texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and a number of the text each belongs to, about ``CHUNK`` positions at a time, texts longer than that whole."""
    ids, length = [], 0
    for i, text in enumerate(texts, 1):
        ids.append(text)
        length += len(text)
        if length >= CHUNK or i == len(texts):
            yield np.concatenate(ids), np.repeat(np.arange(len(ids)), [len(t) for t in ids])
            ids, length = [], 0


def sums_of_shares(batches: Iterator[pa.RecordBatch], vectors: np.ndarray, tree: tuple[np.ndarray, np.ndarray], settings: Settings,
                   shares: int, total: int, iteration: int) -> Iterator[pa.RecordBatch]:
    """Train each share of ``share, ids`` from ``vectors``; sums of the vectors moved, and how many shares moved them.

    A share works on a copy of only the words and nodes it meets. One row holds up to ``BLOCK`` vectors, as ``SUMS``.
    Nobody reads the inner nodes after the last iteration.
    """
    s, size, n = settings, vectors.shape[1], len(tree[0]) // 2 + 1
    kept = n if iteration == s.iterations - 1 else len(vectors)
    sums, times = np.zeros((kept, size), np.float32), np.zeros(kept, np.int32)
    place = np.zeros(n, np.int32)
    for texts in _shares(batches, s.sentence):
        seen = np.zeros(n, bool)
        for text in texts:
            seen[text] = True
        known = np.flatnonzero(seen)
        place[known] = np.arange(len(known))
        above, parent, bit = subtree(known, *tree)
        # Not copies: a pickled array has a type object of its own, for which numpy's add.at is 40 times as slow.
        words, inner = np.zeros((len(known), size), np.float32), np.zeros((max(len(above), 1), size), np.float32)
        words[:], inner[:len(above)] = vectors.take(known, 0), vectors.take(above + n, 0)
        done = 0
        for ids, text in _chunks(texts):
            progress = (iteration + np.minimum((done + np.arange(len(ids))) * shares / total, 1)) / s.iterations
            rates = (RATE * np.maximum(1 - progress, 1e-4)).astype(np.float32)
            draw = np.random.default_rng([s.seed, iteration, done, len(ids)])
            learn(place[ids], text, words, inner, parent, bit, s.window, rates, draw)
            done += len(ids)
        sums[known] += words
        times[known] += 1
        if kept > n:
            sums[above + n] += inner[:len(above)]
            times[above + n] += 1
    moved = np.flatnonzero(times)
    starts = np.searchsorted(moved, np.arange(0, kept + BLOCK, BLOCK))
    blocks = np.flatnonzero(np.diff(starts))
    for at in range(0, len(blocks), ROWS):
        some = blocks[at:at + ROWS]
        own = moved[starts[some[0]]:starts[some[-1] + 1]]
        ends = np.append(starts[some], starts[some[-1] + 1]) - starts[some[0]]
        columns = [(ends, own.astype(np.int32)), (ends, times[own]), (ends * size, sums[own].ravel())]
        lists = [pa.ListArray.from_arrays(pa.array(e, pa.int32()), pa.array(values)) for e, values in columns]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *lists], ["block", "places", "times", "sums"])


SUMS = "block int, places array<int>, times array<int>, sums array<float>"


def mean_of_sums(rows: pa.Table) -> pa.Table:
    """The vectors of one block: the sums that its tasks hand out, divided by the shares they are of."""
    size = len(rows["sums"].chunk(0).flatten()) // max(len(rows["places"].chunk(0).flatten()), 1)
    first = rows["block"][0].as_py() * BLOCK
    sums, times = np.zeros((BLOCK, size)), np.zeros((BLOCK, 1))
    for row in rows.select(["places", "times", "sums"]).to_batches():
        for places, number, vectors in zip(*row.columns):
            at = places.values.to_numpy() - first  # no place comes twice in a row
            sums[at] += vectors.values.to_numpy().reshape(-1, size)
            times[at, 0] += number.values.to_numpy()
    moved = np.flatnonzero(times)
    means = (sums[moved] / times[moved]).astype(np.float32)
    return pa.table({"block": rows["block"].slice(0, 1), "places": pa.array([moved + first], pa.list_(pa.int32())),
                     "means": pa.array([means.ravel()], pa.list_(pa.float32()))})


MEANS = "block int, places array<int>, means array<float>"


def encoded(terms: DataFrame, vocabulary: Broadcast[pa.Array]) -> DataFrame:
    """``ids``: the terms of each text that are in the vocabulary, as places in it; texts without two are left out."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("terms")
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            found = pc.index_in(lists.flatten(), value_set=vocabulary.value)
            text = np.repeat(np.arange(len(lengths)), lengths)[found.is_valid().to_numpy(zero_copy_only=False)]
            kept = np.bincount(text, minlength=len(lengths))
            offsets = pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32())
            ids = pa.ListArray.from_arrays(offsets, found.drop_null().cast(pa.int32()))
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(kept > 1))], ["ids"])

    return terms.select("terms").mapInArrow(encode, "ids array<int>")


def train(terms: DataFrame, settings: Settings, shares: int) -> tuple[pa.Array, np.ndarray]:
    """The vocabulary by falling count and the vector of each word, from the ``terms`` of the texts.

    Texts are dealt out in each iteration, to ``shares`` shares at least and to one per ``SHARE`` terms of a larger
    corpus; a vector that several of them moved becomes the mean of theirs. A task adds up the vectors of its shares,
    so that what is moved between the tasks follows their number. Tables and shuffle files go as soon as they are read.
    """
    spark, s = terms.sparkSession, settings
    with shuffles_removed(spark), ExitStack() as kept:
        with staged(terms, "word-vector-terms") as terms:
            counts = terms.select(F.explode("terms").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(
                F.col("n") >= s.min_count).orderBy(F.col("n").desc(), "word").toArrow()
            vocabulary, n = counts.column("word").combine_chunks(), counts.num_rows
            if not n:
                raise ValueError(f"no word occurs {s.min_count} times")
            shared = spark.sparkContext.broadcast(vocabulary)
            ids = kept.enter_context(staged(encoded(terms, shared), "word-vector-ids"))
            shared.destroy()
        each = counts.column("n").to_numpy()
        total, size = int(each.sum()), s.size
        del counts
        shares = max(shares, math.ceil(total / SHARE))
        cores = spark.sparkContext.defaultParallelism
        tasks = min(shares, cores * math.ceil(total / (cores * TASK)))
        tree = spark.sparkContext.broadcast(huffman(each))
        vectors = np.zeros((n + max(n - 1, 1), size), np.float32)
        vectors[:n] = (np.random.default_rng(s.seed).random((n, size), np.float32) - 0.5) / size

        for iteration in range(s.iterations):
            now = spark.sparkContext.broadcast(vectors)

            def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                return sums_of_shares(batches, now.value, tree.value, s, shares, total, iteration)

            # Below coalesce(), the number of a partition is still that of the share.
            dealt = ids.repartition(shares).select(F.spark_partition_id().alias("share"), "ids").coalesce(tasks)
            means = dealt.mapInArrow(trained, SUMS).groupBy("block").applyInArrow(mean_of_sums, MEANS)
            with staged(means, "word-vector-means") as means:
                now.destroy()
                for first in range(0, math.ceil(len(vectors) / BLOCK), READ):
                    some = means.filter(F.col("block").between(first, first + READ - 1)).toArrow()
                    for places, found in zip(some["places"].chunks, some["means"].chunks):
                        vectors[places.flatten().to_numpy()] = found.flatten().to_numpy().reshape(-1, size)
        tree.destroy()
    return vocabulary, vectors[:n]
