"""Mixing sources to target weights: exact quotas, dealt to output shards by a splitting tree."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ordering import ordered_values
from riskloom.llm.texts import consecutive
from riskloom.session import stage

#: Weights of the sources in their order, repeating; the words of the mix as a
#: share of all words; and how often a source may be taken as a whole.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
SEED = 2024
#: Words of a block, the unit of the quotas, and blocks of an output shard.
BLOCK_WORDS, SHARD_BLOCKS = 1 << 16, 64
#: Copies of one row that are listed by one task.
COPIES = 1 << 16

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_count(text: Column) -> Column:
    """The number of runs of characters that are neither blank nor tab to carriage return; 0 for null.

    Every run, with the space behind it, becomes one character, and these are counted: no list of words is built.
    """
    begun = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]++", "")
    return F.length(F.regexp_replace(begun, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")).cast("long")


# Targets.

def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, rank, target, quota`` from a written table ``source, source_size``.

    Sources are in code-point order, null last (``rank`` from 0), and weigh ``weights``,
    repeating. They share ``share`` of all words by weight; whoever gets more than ``most`` times
    its size stops there, and the rest is shared anew until none is above. Each turn is one sum
    over the table, and the share per weight only rises, so a turn without a
    new stop is the last. ``quota`` is the target in whole words.
    """
    named = sizes.filter(F.col("source").isNotNull())
    places = ordered_values(sizes, [], "source").select("source", F.col("position").alias("rank"))
    unnamed = sizes.filter(F.col("source").isNull()).withColumn("rank", F.lit(named.count()).cast("long"))
    ranks = named.join(places, "source").unionByName(unnamed).select("source", "source_size", "rank")
    weight = F.element_at(F.lit([float(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = stage(ranks.withColumn("weight", weight).withColumn("most", F.col("source_size") * most), "source-ranks")
    words = table.agg(F.sum("source_size")).head()[0] or 0
    each, stopped = None, -1
    while True:
        stops = F.lit(False) if each is None else F.col("most") <= F.col("weight") * each
        found = table.agg(F.count(F.when(stops, 1)).alias("n"), F.sum(F.when(stops, F.col("most"))).alias("given"),
                          F.sum(F.when(~stops, F.col("weight"))).alias("weight")).head()
        if found["n"] == stopped or not found["weight"]:
            break
        each, stopped = (share * words - (found["given"] or 0)) / found["weight"], found["n"]
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(each).cast("double"))
    return stage(table.select("source", "source_size", "rank", target.alias("target"))
                 .withColumn("quota", F.least(F.col("source_size") * most, F.floor(F.col("target") + 0.5))), "targets")


# Documents laid end to end, source by source, in permuted order.

def laid_out(distinct: DataFrame, targets: DataFrame) -> DataFrame:
    """Each distinct row with ``start``, the words of its source before it, and its source's figures.

    The order within a source is that of ``place``, a keyed hash of id and text, so neighbours in the
    table are not neighbours here and runs agree. Rows are dealt by the hash into slices, and each slice
    starts behind those before it, so no source is ever in one task. A source's figures travel with its slices.
    """
    slices = 4 * int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spot = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    sliced = distinct.withColumn("slice", F.shiftright(spot * slices, 32))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    words = F.sum(F.col("size") * F.col("n"))
    offsets = sliced.groupBy("source", "slice").agg(words.alias("words")).select(
        F.col("source").alias("of"), F.col("slice").alias("at"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    figures = targets.withColumnRenamed("source", "of_source")
    offsets = offsets.join(figures, offsets["of"].eqNullSafe(figures["of_source"])).drop("of_source")
    within = Window.partitionBy("source", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("local", F.coalesce(words.over(within), F.lit(0)))
    return local.join(offsets, local["source"].eqNullSafe(offsets["of"]) & (local["slice"] == offsets["at"])) \
        .withColumn("start", F.col("offset") + F.col("local")).drop("of", "at", "offset", "local", "slice")


def with_pieces(laid: DataFrame, block_words: int, most: int) -> DataFrame:
    """One row per copy of each distinct row: ``doc_id, source, mark, copy, size, source_size, target, rank, pieces``.

    A source's documents are passed through up to ``most`` times, until its quota of words is full; the
    document that reaches the quota is cut there. ``pieces`` has a struct ``turn, words, block`` for
    each pass that takes words of this copy; a document belongs to the block in which it begins.
    """
    def piece(turn: int) -> Column:
        first = F.col("source_size") * turn + F.col("start") + F.col("copy") * F.col("size")
        return F.struct(F.lit(turn).alias("turn"), F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - first)).alias("words"),
                        F.floor(first / block_words).alias("block"))

    last = F.ceil(F.col("n") / COPIES) - 1
    chunks = laid.filter(F.col("n") > COPIES).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    chunks = chunks.repartition("place", "chunk").unionByName(
        laid.filter(F.col("n") <= COPIES).withColumn("chunk", F.lit(0).cast("long")))
    copy = F.explode(F.sequence(F.col("chunk") * COPIES, F.least((F.col("chunk") + 1) * COPIES, F.col("n")) - 1))
    return chunks.withColumn("copy", copy).select(
        "doc_id", "source", "mark", "copy", "size", "source_size", "target", "rank",
        F.filter(F.array(*map(piece, range(most))), lambda p: p["words"] > 0).alias("pieces"))


# The splitting tree.

def descend(node: int, first: int, shards: int, ranks: np.ndarray, counts: np.ndarray, starts: np.ndarray, levels: int,
            seed: int = SEED) -> Iterator[tuple]:
    """Split a node's blocks among its shards, ``levels`` levels down, and yield the nodes reached.

    The left half of the shards draws its blocks from the node's without putting back, so the counts
    by source follow the multivariate hypergeometric distribution; the right half has the
    rest. No count is ever rounded: sources keep their quotas exactly. The
    drawing depends on seed and node alone. ``starts`` says how many blocks of a source went to shards before.
    """
    if not levels or shards == 1:
        yield node, first, shards, ranks, counts, starts
        return
    half = shards // 2
    left = np.random.default_rng([seed, node]).multivariate_hypergeometric(
        counts, int(counts.sum()) * half // shards, method="marginals")
    for child, at, n, own, begin in ((2 * node, first, half, left, starts),
                                     (2 * node + 1, first + half, shards - half, counts - left, starts + left)):
        held = own > 0
        yield from descend(child, at, n, ranks[held], own[held], begin[held], levels - 1, seed)


def drawn_block(position: np.ndarray, blocks: int, rank: int, seed: int = SEED) -> np.ndarray:
    """The block that a source's draw of this number gives: a permutation of ``blocks`` numbers by one step and one shift."""
    step = max(1, int(blocks * 0.618))
    while np.gcd(step, blocks) != 1:
        step += 1
    return (position * step + (seed + 7919 * rank)) % blocks


def split_quotas(targets: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS,
                 seed: int = SEED, levels: int = 8) -> DataFrame:
    """``rank, block, shard``: every block of every source's quota, dealt to shards of about ``shard_blocks``.

    Each job goes ``levels`` levels down the tree; its tasks hold one number per source and level.
    Nodes are written between jobs. Fewer than 10^9 blocks are possible, which is the bound of the
    drawing; larger mixes take larger blocks.
    """
    blocks = F.ceil(F.col("quota") / block_words)
    quotas = targets.filter("quota > 0").select("rank", blocks.alias("blocks"))
    total = quotas.agg(F.sum("blocks")).head()[0] or 0
    shards = max(1, -(-total // shard_blocks))
    nodes = quotas.select(F.lit(1).cast("long").alias("node"), F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("shards"),
                          "rank", F.col("blocks").alias("count"), F.lit(0).cast("long").alias("start"), "blocks")
    names = nodes.columns
    schema = ", ".join(f"{name} long" for name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in consecutive(batches, 1):
            node, first, n, ranks, counts, starts, blocks = (c.to_numpy() for c in group.columns)
            of = dict(zip(ranks.tolist(), blocks.tolist()))
            for child, at, left, own, held, begin in descend(
                    int(node[0]), int(first[0]), int(n[0]), ranks, counts, starts, levels, seed):
                same = [np.full(len(own), x) for x in (child, at, left)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (
                    *same, own, held, begin, np.array([of[r] for r in own.tolist()], np.int64))], names=names)

    for turn in range(0, int(shards - 1).bit_length(), levels):
        nodes = stage(nodes.repartition("node").sortWithinPartitions("node", "rank").mapInArrow(run, schema), f"shares-{turn}")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, shard, _, rank, count, start, blocks in zip(*(c.to_pylist() for c in batch.columns)):
                found = drawn_block(np.arange(start, start + count), blocks, rank, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(count, rank)), pa.array(found), pa.array(np.full(count, shard))], names=["rank", "block", "shard"])

    return nodes.mapInArrow(draw, "rank long, block long, shard long")


# The mix.

def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST,
                block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """What the mix takes: one table of all rows, and one of the pieces of each output shard.

    The first has ``doc_id, source, size, source_size, target, taken`` for every row: ``size`` in words
    (null and empty texts: 0), ``taken`` the words that the pieces of all shards hold of it, repeats
    counted. A source's taken words are its target, rounded to a whole word. The second
    has ``shard, place, doc_id, source, mark, turn, words, size``: whole documents, but for one a source that is
    cut at the quota; ``mark`` is the MD5 of the text and ``place`` the order within the shard, a keyed shuffle.

    A null source is a source of its own, rows without an id take part, and rows repeated with id,
    source and text are counted once and listed as often as they occur, so that no copy count makes a task large.
    Reruns agree. An empty table gives no rows. Texts are read once and not moved.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.md5(text.cast("binary")).alias("mark"), word_count(text).alias("size"))
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "mark").cast("binary"))
    distinct = stage(rows.groupBy("doc_id", "source", "mark").agg(F.first("size").alias("size"), F.count(F.lit(1)).alias("n"))
                     .withColumn("place", place), "distinct-documents")
    sizes = stage(distinct.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), "source-sizes")
    targets = source_targets(sizes, weights, share, most)
    listed = stage(with_pieces(laid_out(distinct, targets), block_words, most), "listed")
    key = ["doc_id", "source", "mark", "copy"]
    wanted = listed.select(*key, "size", "rank", F.explode("pieces").alias("p")).select(*key, "size", "rank", "p.*")
    drawn = stage(wanted.join(split_quotas(targets, block_words, shard_blocks, seed), ["rank", "block"]).select(
        *key, "size", "turn", "words", "shard"), "drawn")
    each = listed.select(*key, "size", "source_size", "target", F.lit(0).cast("long").alias("words")).unionByName(
        drawn.select(*key, "words"), allowMissingColumns=True)
    taken = each.groupBy(*key).agg(F.max("size").alias("size"), F.max("source_size").alias("source_size"),
                                   F.max("target").alias("target"), F.sum("words").alias("taken"))
    shuffled = F.md5(F.concat_ws(":", F.lit(f"{seed}-shard"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "mark",
                                 F.col("copy").cast("string"), F.col("turn").cast("string")).cast("binary"))
    order = F.row_number().over(Window.partitionBy("shard").orderBy(shuffled, "source")) - 1
    pieces = drawn.select("shard", order.alias("place"), "doc_id", "source", "mark", "turn", "words", "size")
    return taken.drop("mark", "copy"), pieces


def mixed_texts(docs: DataFrame, pieces: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """``shard, place, doc_id, source, text``: the mix itself, its rows gathered and ordered shard by shard.

    A piece that holds fewer words than its document is the document's beginning. Each distinct
    document is sent once to where its pieces are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    known = docs.select(F.col(id_col).alias("of"), F.col(source_col).cast("string").alias("of_source"), text.alias("text"),
                        F.md5(text.cast("binary")).alias("of_mark")).dropDuplicates(["of", "of_source", "of_mark"])
    same = pieces["doc_id"].eqNullSafe(known["of"]) & pieces["source"].eqNullSafe(known["of_source"]) & (pieces["mark"] == known["of_mark"])
    whole = pieces.join(known, same).select("shard", "place", "doc_id", "source", "text", "words", "size")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [beginning(t, n) for t, n in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(texts, pa.string())], names=[*batch.schema.names[:4], "text"])

    part = whole.filter("words < size").drop("size")
    schema = ", ".join(f"`{name}` {kind}" for name, kind in part.dtypes[:5])
    return whole.filter("words = size").drop("words", "size").unionByName(part.mapInArrow(cut, schema)) \
        .repartition("shard").sortWithinPartitions("shard", "place")


def beginning(text: str, words: int) -> str:
    """The text up to the end of its word of this number."""
    last = next(islice(_WORD.finditer(text), words - 1, None), None) if words else None
    return text[:last.end()] if last else ""
