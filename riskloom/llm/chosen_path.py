"""Near duplicates by word shingles: a chosen-path similarity join."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import components
from riskloom.llm.fingerprints import mix
from riskloom.llm.shingles import WORDS, sampled_tokens, sequence_digest, shingle_hashes, word_hashes
from riskloom.llm.texts import arrow_map, fresh, hash_value, id_and_text, parted_by
from riskloom.session import stage

SIMILARITY = 0.8
#: Tokens sampled of each set, shared by all runs.
SAMPLED = 64
#: Levels of the recursion, and the share of pairs at exactly SIMILARITY that
#: the runs together must bring into one bucket.
DEPTH, RECALL = 3, 0.999
#: Sets that are compared with each other at once; and shingles held at once.
#: Larger buckets and groups are compared exactly too, block by block.
SMALL, HELD = 512, 2_000_000


def runs_for(recall: float = RECALL, depth: int = DEPTH, similarity: float = SIMILARITY) -> int:
    """Runs that reach the recall, by the survival of a pair at the threshold through ``depth`` levels.

    All runs share the sampled tokens, so the loss is averaged over how many of
    these agree. At each level a pair has a common child at each agreeing
    place, if the place is chosen; it survives if any of these does.
    """
    agree = np.arange(SAMPLED + 1)
    weight = np.array([math.comb(SAMPLED, k) * similarity ** k * (1 - similarity) ** (SAMPLED - k) for k in agree])
    survives = np.ones(SAMPLED + 1)
    for _ in range(depth):
        survives = 1 - (1 - survives / (similarity * SAMPLED)) ** agree
    runs = 1
    while weight @ (1 - survives) ** runs > 1 - recall:
        runs += 1
    return runs


def children(nodes: np.ndarray, tokens: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The rows that go on and the nodes they go to.

    A node chooses each of the sampled places with probability
    ``1 / (similarity * places)``, by a hash of its path alone, so all sets at
    a node choose the same; those with the same token there stay together.
    """
    places = tokens.shape[1]
    drawn = mix(nodes[:, None] + np.arange(1, places + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    rows, at = np.nonzero(drawn < np.uint64(int((1 << 64) / (similarity * places))))
    return rows, mix(drawn[rows, at] ^ mix(tokens[rows, at].astype(np.uint64) + np.uint64(1)))


def described(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, mark, digest, size, tokens, brief`` of every row; rows without words have size 0.

    ``mark`` (MD5) stands for the text itself, ``digest`` for the sequence of words, ``size`` counts distinct
    shingles, ``tokens`` are the sampled ones, ``brief`` a byte of each.
    """

    def rows(ids: list, texts: list) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": ids, "mark": [], "digest": [], "size": [], "tokens": [], "brief": []}
        for text in texts:
            found = word_hashes(text)
            shingles = shingle_hashes(found, words)
            sample = sampled_tokens(shingles, SAMPLED)
            out["mark"].append(hashlib.md5(text.encode()).digest())
            out["digest"].append(sequence_digest(found))
            out["size"].append(len(shingles))
            out["tokens"].append(sample.tobytes())
            out["brief"].append((sample & np.uint32(255)).astype(np.uint8).tobytes())
        return out

    return arrow_map(docs, f"doc_id {dict(docs.dtypes)['doc_id']}, mark binary, digest binary, size long, tokens binary, brief binary", rows)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _go_on(batches: Iterator[pa.RecordBatch], similarity: float, runs: int) -> Iterator[pa.RecordBatch]:
    """``(digest, tokens[, node])`` to ``(node, digest)`` one level down; without nodes from the root of every run."""
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            tokens = _matrix(part.column(1), "<u4")
            if part.num_columns == 3:
                above = [part.column(2).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)]
            else:
                above = [np.full(len(tokens), run, np.uint64) for run in range(1, runs + 1)]
            for nodes in above:
                rows, below = children(nodes, tokens, similarity)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(below.view(np.int64)), part.column(0).take(pa.array(rows))], names=["node", "digest"])


def leaf_buckets(sets: DataFrame, similarity: float, depth: int, recall: float) -> DataFrame:
    """``(node, digest, n)``: the buckets to compare by brute force, of ``n`` sets each.

    Each level counts its nodes. Nodes with a single set end, those of up to
    ``SMALL`` are leaves, larger ones are split again. What is still larger
    below the last level are sets that cannot be told apart by their tokens;
    they are leaves as well, to be compared in blocks. All runs go down at once.
    """
    runs = runs_for(recall, depth, similarity)
    level, leaves = sets.select("digest", "tokens"), None
    for down in range(1, depth + 1):
        rows = level.mapInArrow(lambda batches: _go_on(batches, similarity, runs), "node long, digest binary")
        many = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        found = stage(rows.join(many, "node"), f"nodes-{down}")
        large = found.filter(F.col("n") > SMALL)
        last = down == depth or not large.limit(1).count()
        leaf = found if last else found.filter(F.col("n") <= SMALL)
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        if last:
            break
        level = large.select("node", "digest").join(sets.select("digest", "tokens"), "digest").select("digest", "tokens", "node")
    return leaves


def in_blocks(rows: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Deal the rows of each group into ``blocks`` and add ``_key`` and ``_side`` for every pair of blocks.

    Each block meets itself and every other block under a key of its own.
    ``_side`` is 0 where a block meets itself, else 1 and 2 tell the two apart;
    one of them may be empty.
    """
    own = F.pmod(F.xxhash64("digest"), F.col("_blocks")).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    return rows.withColumn("_blocks", blocks.cast("long")).withColumn("_own", own).withColumn("_other", other).withColumn(
        "_key", F.concat_ws(":", group, F.least("_own", "_other"), F.greatest("_own", "_other"))).withColumn(
        "_side", F.when(F.col("_own") == F.col("_other"), 0).when(F.col("_own") < F.col("_other"), 1).otherwise(2)).drop("_blocks", "_own", "_other")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows with the same first column, which arrive next to each other."""
    held: list[tuple] = []
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            for row in zip(*(column.to_pylist() for column in batch.slice(start, 1024).columns)):
                if held and held[0][0] != row[0]:
                    yield held
                    held = []
                held.append(row)
    if held:
        yield held


def _paired(sides: np.ndarray) -> np.ndarray:
    """Which pairs count: all others within a block (side 0), else those across the sides 1 and 2."""
    out = sides[:, None] != sides[None, :] if sides.any() else np.ones((len(sides), len(sides)), bool)
    np.fill_diagonal(out, False)
    return out


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each row the first row it is connected with."""
    labels = np.arange(len(linked))
    joined = linked | np.eye(len(linked), dtype=bool)
    while True:
        lower = np.where(joined, labels[None, :], len(labels)).min(axis=1)
        lower = lower[lower]
        if (lower == labels).all():
            return labels
        labels = lower


def _likely(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Buckets ``(key, digest, side, size, brief)`` to edges between probably similar sets.

    Equal bytes estimate the similarity; four standard errors below the
    threshold pass. Only a spanning star of each connected part is returned.
    """
    enough = math.floor(SAMPLED * (similarity - 4 * math.sqrt(similarity * (1 - similarity) / SAMPLED)))
    out: list[tuple[bytes, bytes]] = []
    for group in _groups(batches):
        if len(group) < 2:
            continue
        sizes = np.array([r[3] for r in group])
        briefs = np.frombuffer(b"".join(r[4] for r in group), np.uint8).reshape(len(group), -1)
        equal = np.zeros((len(group), len(group)), np.uint8)
        for place in range(SAMPLED):
            equal += briefs[:, place, None] == briefs[None, :, place]
        close = np.minimum(sizes[:, None], sizes) >= (similarity - 1e-9) * np.maximum(sizes[:, None], sizes)
        linked = (equal >= enough) & close & _paired(np.array([r[2] for r in group]))
        if linked.any():
            for at, root in enumerate(_roots(linked).tolist()):
                if at != root:
                    out.append((group[at][1], group[root][1]))
        if len(out) >= 4096:
            yield _edges(out)
            out = []
    if out:
        yield _edges(out)


def _edges(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows)], names=["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Groups ``(key, digest, side, copies, shingles)`` to ``(digest, root, links)`` by exact similarity.

    ``links`` counts the copies of all sets linked to this one under this key.
    """
    for group in _groups(batches):
        group = list({row[1]: row for row in group}.values())
        if len(group) < 2:
            continue
        sets = [np.frombuffer(r[4], np.uint64) for r in group]
        sizes = np.array([len(s) for s in sets])
        _, token = np.unique(np.concatenate(sets), return_inverse=True)
        offsets = np.cumsum(sizes) - sizes
        paired = _paired(np.array([r[2] for r in group]))
        linked = np.zeros((len(group), len(group)), bool)
        mark = np.zeros(int(token.max()) + 1, bool)
        for i, (start, size) in enumerate(zip(offsets.tolist(), sizes.tolist())):
            own = token[start:start + size]
            mark[own] = True
            common = np.add.reduceat(mark[token], offsets, dtype=np.int64)
            mark[own] = False
            linked[i] = common >= (similarity - 1e-12) * (sizes + size - common)
        linked &= paired
        links = linked @ np.array([r[3] for r in group], np.int64)
        roots = _roots(linked)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[1] for r in group], pa.binary()), pa.array([group[i][1] for i in roots.tolist()], pa.binary()),
             pa.array(links, pa.int64())], names=["digest", "root", "links"])


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, depth: int = DEPTH,
                    recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, n_links, class_size`` of every row.

    Texts are linked if the Jaccard similarity of their sets of word shingles
    (words: letters and digits, lower case) is at least ``similarity``. A class
    is what links connect; its id is its smallest ``doc_id``. ``n_links``
    counts the other rows linked directly, copies included. Texts of fewer
    words than a shingle are one shingle. Rows without words (null and empty
    texts too) link to nothing: each is its own class. Repeated rows are copies
    of each other; an empty table gives no rows.

    Method: texts with the same words are one set from the start. The chosen
    paths bring similar sets into common buckets; within a bucket, sampled
    tokens pick the probably similar ones. The connected parts of these are
    then compared exactly, each pair once, on whole shingle sets. Nothing is
    capped: what is too large for one task is compared in pairs of blocks.
    """
    return _classified(id_and_text(docs, id_col, text_col), similarity, words, depth, recall).select(
        "doc_id", "class_id", "n_links", "class_size")


def _classified(texts: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, depth: int = DEPTH,
                recall: float = RECALL) -> DataFrame:
    """The rows of ``near_duplicates`` with ``mark`` of their text and ``root``, which names the class without an id."""
    rows = stage(described(texts, words), "described")
    sets = stage(rows.filter("size > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.min("mark").alias("mark"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"),
        F.first("tokens").alias("tokens"), F.first("brief").alias("brief")), "sets")

    leaves = leaf_buckets(sets, similarity, depth, recall)
    dealt = in_blocks(leaves, "node", F.ceil(F.col("n") / SMALL)).select("_key", "digest", "_side") \
        .join(sets.select("digest", "size", "brief"), "digest").select("_key", "digest", "_side", "size", "brief")
    likely = dealt.repartition("_key").sortWithinPartitions("_key", "digest") \
        .mapInArrow(lambda batches: _likely(batches, similarity), "a binary, b binary")
    parts = stage(components(likely).withColumnRenamed("node", "digest"), "likely-parts")

    members = parts.join(sets.select("digest", "mark", "copies", "size"), "digest")
    extent = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"))
    wanted = members.join(extent, "root").select(
        "digest", "mark", "copies", F.hex("root").alias("part"),
        F.greatest(F.ceil(F.col("n") / SMALL), F.ceil(F.col("total") / HELD)).alias("blocks"))
    compared = _with_shingles(texts, stage(wanted, "members"), words)
    exact = in_blocks(compared, "part", F.col("blocks")).select("_key", "digest", "_side", "copies", "shingles") \
        .repartition("_key").sortWithinPartitions("_key", "digest") \
        .mapInArrow(lambda batches: _verified(batches, similarity), "digest binary, root binary, links long")
    exact = stage(exact, "links")

    classes = components(exact.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    links = exact.groupBy("digest").agg(F.sum("links").alias("links"))
    rooted = sets.select("digest", "first_id", "copies") \
        .join(classes.withColumnRenamed("node", "digest"), "digest", "left").join(links, "digest", "left") \
        .withColumn("root", F.coalesce("root", "digest"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"))
    labelled = rooted.join(ids, "root").select(
        "digest", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "class_size")
    named = rows.filter("size > 0").select("doc_id", "mark", "digest").join(labelled, "digest") \
        .select("doc_id", "mark", "root", "class_id", "n_links", "class_size")
    alone = rows.filter("size = 0").select("doc_id", "mark", F.lit(None).cast("binary").alias("root"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                           F.lit(1).cast("long").alias("class_size"))
    return named.unionByName(alone)


def text_mark(text: Column) -> Column:
    """The ``mark`` of a text: its MD5, null as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _with_shingles(texts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``wanted`` with the shingle set of each digest, from a text with its mark.

    Only few texts are wanted. A hash of the marks, of a bounded number of values, tells most others
    where they are read, so that they do not cross the network to be thrown away; the
    join by mark then decides. Of the copies of a text each task passes on one.
    """
    marked = texts.select(text_mark(F.col("text")).alias("mark"), "text").withColumn("value", hash_value("mark"))
    likely, _ = parted_by(marked, "value", wanted.withColumn("value", hash_value("mark")))
    joined = likely.join(wanted, "mark").select("text", "digest", "copies", "part", "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                new = []
                for digest in part.column(1).to_pylist():
                    new.append(digest not in seen)
                    seen.add(digest)
                chosen = part.filter(pa.array(new, pa.bool_()))
                shingles = [shingle_hashes(word_hashes(t), words).tobytes() for t in chosen.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*chosen.columns[1:], pa.array(shingles, pa.binary())],
                                                 names=["digest", "copies", "part", "blocks", "shingles"])

    return joined.mapInArrow(run, "digest binary, copies long, part string, blocks long, shingles binary")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of ``docs`` for each class, with all its columns: that of the smallest id.

    Only rows whose text may be that of a dropped row are moved.
    Rows are told apart by id and text, so another text with a dropped id stays
    and rows without an id (they come last) are dropped too. Only repeats of
    the chosen row, equal in id and text, stay with it.
    """
    gone, mark, value = (fresh(name, docs.columns) for name in ("_dropped", "_mark", "_value"))
    found = stage(_classified(id_and_text(docs, id_col, text_col), **settings).filter("class_size > 1")
                  .select("root", "doc_id", "mark").distinct(), "near-classes")
    kept = found.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "mark")).alias("kept"))
    dropped = found.join(kept, "root") \
        .filter(~(F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("mark") == F.col("kept.mark")))) \
        .select(F.col("doc_id").alias(gone), F.col("mark").alias(mark))
    dropped = stage(dropped.withColumn(value, hash_value(mark)), "near-dropped")
    doubtful, others = parted_by(docs.withColumn(value, hash_value(text_mark(F.col(text_col)))), value, dropped)
    same = F.col(id_col).eqNullSafe(F.col(gone)) & (text_mark(F.col(text_col)) == F.col(mark))
    kept = doubtful.join(dropped.drop(value), same, "left_anti")
    return others.select(*docs.columns).unionByName(kept.select(*docs.columns))
