"""A Merkle manifest of a dataset: hash trees in blocks, each block in van Emde Boas order."""

from __future__ import annotations

import hashlib
from binascii import hexlify
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.texts import consecutive
from riskloom.session import stage

#: Levels between a block's leaves and its root: a block has at most 1,024 leaves and 2,047 nodes.
HEIGHT = 10
#: A digest, and a step of a path: the side of the sibling (0 none, 1 left, 2 right) and its digest.
DIGEST, STEP = 32, 33
#: Rows of an Arrow batch of blocks.
BLOCKS = 16


@lru_cache(maxsize=32)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Where the nodes of each depth of a complete tree of ``levels`` levels lie, the root's depth first.

    Van Emde Boas order: the tree is cut at half its height; the top part
    comes first, then the parts below it from left to right, each laid out
    in the same way. A path from a leaf to the root so crosses few
    neighbourhoods of memory, whatever the size of a cache line or page.
    """
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top, bottom = addresses(levels // 2), addresses(levels - levels // 2)
    first = (1 << len(top)) - 1 + np.arange(1 << len(top))[:, None] * ((1 << len(bottom)) - 1)
    return (*top, *((first + depth).ravel() for depth in bottom))


def node_digest(below: bytes) -> bytes:
    """The digest of the digests of one or two nodes, which enter as hexadecimal text."""
    return hashlib.sha256(hexlify(below)).digest()


def block_nodes(leaves: Sequence[bytes], height: int) -> np.ndarray:
    """All digests of a block, by address; places without a node are zero. A node without a neighbour goes up alone."""
    out = np.zeros(((2 << height) - 1, DIGEST), np.uint8)
    level = list(leaves)
    for depth, places in zip(range(height, -1, -1), reversed(addresses(height + 1))):
        out[places[:len(level)]] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
        if depth:
            level = [node_digest(b"".join(level[i:i + 2])) for i in range(0, len(level), 2)]
    return out


def block_steps(nodes: np.ndarray, members: int) -> np.ndarray:
    """For each leaf of a block the steps to its root (``members`` x height x ``STEP`` bytes), found by address."""
    places = addresses(int(len(nodes)).bit_length())
    height = len(places) - 1
    out = np.zeros((members, height, STEP), np.uint8)
    at, width = np.arange(members), members
    for up in range(height):
        other = at ^ 1
        there = other < width
        out[there, up, 0] = np.where(at[there] & 1, 1, 2)
        out[there, up, 1:] = nodes[places[height - up][other[there]]]
        at, width = at >> 1, (width + 1) >> 1
    return out


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the steps of its path lead to."""
    for start in range(0, len(path), STEP):
        side, other = path[start], path[start + 1:start + STEP]
        leaf = node_digest(leaf if not side else other + leaf if side == 1 else leaf + other)
    return leaf


def siblings_digest(path: bytes) -> str:
    """One hash over the siblings of a path, in its order."""
    found = [hexlify(path[i + 1:i + STEP]) for i in range(0, len(path), STEP) if path[i]]
    return hashlib.sha256(b"".join(found)).hexdigest()


def record_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 over the columns as text: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    def field(column: Column) -> Column:
        text = column.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.unhex(F.sha2(F.concat(*map(field, columns)).cast("binary"), 256))


# Ranks: the place of every leaf in its tree.

def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Add ``rank`` (from 0 within ``tree``, nulls first) and ``n`` (rows of the tree).

    Range partitioning deals the rows out in order, each task numbers its
    own, and one offset per tree and slice is added. Ties are broken by a
    random number, so that rows repeated any number of times do not end up in
    one task; rows that are equal in ``order`` must be interchangeable.
    """
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order, "_tie")]
    placed = rows.withColumn("_tie", F.rand(11)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stage(placed.withColumn("_slice", F.spark_partition_id()).withColumn("_at", row_in_task).drop("_tie"), "placed")
    slices = placed.groupBy(tree, "_slice").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(tree).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(tree, "_slice", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_offset"),
                            F.sum("_rows").over(Window.partitionBy(tree)).alias("n"))
    return placed.join(offsets, [tree, "_slice"]).withColumn("rank", F.col("_at") + F.col("_offset")) \
        .drop("_slice", "_at", "_offset")


# Construction, block by block and then over the roots of the blocks.

def build_blocks(nodes: DataFrame, height: int, carried: Sequence[str] = ()) -> DataFrame:
    """``tree, rank, n, digest`` of one level to its blocks.

    A row has ``tree, block, n, members, root, nodes`` and, for each column that
    is ``carried``, the list of its members' values. A tree that fits into one block is only
    as high as it must be; in larger ones every block reaches its full height.
    """
    kinds = dict(nodes.dtypes)
    schema = "tree string, block long, n long, members int, root binary, nodes binary" + "".join(
        f", `{c}` array<{kinds[c]}>" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        lists: list[list[pa.Array]] = [[] for _ in carried]

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (
                pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))]
            for own in lists:
                ends = np.cumsum([0, *map(len, own)])
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(own)))
            return pa.RecordBatch.from_arrays(columns, names=["tree", "block", "n", "members", "root", "nodes", *carried])

        for group in consecutive(batches, 2):
            tree, block, n = (group.column(i)[0].as_py() for i in range(3))
            high = min(height, (n - 1).bit_length())
            found = block_nodes(group.column(3).to_pylist(), high)
            out.append((tree, block, n, group.num_rows, found[0].tobytes(), found.tobytes()))
            for own, column in zip(lists, group.columns[4:]):
                own.append(column.combine_chunks())
            if len(out) == BLOCKS:
                yield batch()
                out.clear()
                lists[:] = [[] for _ in carried]
        if out:
            yield batch()

    keyed = nodes.withColumn("block", F.shiftright("rank", height))
    return keyed.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank") \
        .select("tree", "block", "n", "digest", *carried).mapInArrow(run, schema)


def build_levels(nodes: DataFrame, height: int, carried: Sequence[str] = ()) -> list[DataFrame]:
    """The written blocks of all levels: block roots of large trees are the leaves of the next level."""
    levels = [stage(build_blocks(nodes, height, carried), "blocks-0")]
    while True:
        above = levels[-1].filter(F.col("n") > 1 << height).select(
            "tree", F.col("block").alias("rank"), F.ceil(F.col("n") / (1 << height)).alias("n"), F.col("root").alias("digest"))
        if above.isEmpty():
            return levels
        levels.append(stage(build_blocks(above, height), f"blocks-{len(levels)}"))


def tree_roots(levels: Sequence[DataFrame], height: int) -> DataFrame:
    """``tree, root``: the root of the one block that each tree ends in."""
    out = None
    for level in levels:
        ended = level.filter(F.col("n") <= 1 << height).select("tree", "root")
        out = ended if out is None else out.unionByName(ended)
    return out


@dataclass
class Manifest:
    """Blocks of the trees of all groups, blocks of the tree over their roots, and its root.

    ``root`` is null for an empty table. The name of a group's tree is empty
    for null and else ``1`` with the group behind it.
    """

    levels: list[DataFrame]
    top: list[DataFrame]
    root: bytes | None
    height: int

    def write(self, path: str) -> None:
        """All blocks as one Parquet table: ``part`` (group or top), ``level`` and the block's columns."""
        columns = ["tree", "block", "n", "members", "root", "nodes"]
        for part, levels in (("group", self.levels), ("top", self.top)):
            for at, level in enumerate(levels):
                level.select(F.lit(part).alias("part"), F.lit(at).alias("level"), *columns).write.mode("append").parquet(path)


def build_manifest(rows: DataFrame, leaf: Column, group: str, order: str, claimed: Column | None = None,
                   height: int = HEIGHT) -> Manifest:
    """The manifest of ``rows``: a tree for each ``group``, its leaves by ``order``, and a tree over the groups' roots.

    ``leaf`` is the digest of a row; ``claimed`` one that is to be verified in its place
    (null: the same). Rows without an order come first, ties are ordered by
    leaf; a null group is a group and comes first. Repeated rows are leaves of their own.
    Digests are written once; the records themselves are read once and never moved.
    """
    tree = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit(""))
    leaves = stage(rows.select(tree.alias("tree"), F.col(order).alias("key"), leaf.alias("digest"),
                               (F.lit(None).cast("binary") if claimed is None else claimed).alias("claimed")), "leaves")
    levels = build_levels(ranked(leaves, "tree", ["key", "digest"]), height, ("key", "claimed"))
    roots = stage(tree_roots(levels, height), "roots")
    named = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    top = build_levels(ranked(named, "tree", ["name"]), height, ("name",))
    last = top[-1].select("root").head()
    return Manifest(levels, top, bytes(last["root"]) if last else None, height)


# Paths, from the top down.

def _with_paths(level: DataFrame, above: DataFrame, height: int, carried: Sequence[str] = ()) -> DataFrame:
    """Each member of a level's blocks with its path to the root of everything.

    ``above`` has ``tree, block, path, subroot`` for every block. Columns: ``tree, block``
    (the member's rank), ``path, subroot, digest`` and what is carried.
    """
    kinds = dict(level.dtypes)
    schema = "tree string, block long, path binary, subroot binary, digest binary" + "".join(
        f", `{c}` {kinds[c].removeprefix('array<').removesuffix('>')}" for c in carried)
    joined = level.join(above, ["tree", "block"]).select(
        "tree", "block", "members", "nodes", "path", "subroot", "root", *carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                tree, block, members, nodes, path, subroot, root = (batch.column(i)[at].as_py() for i in range(7))
                found = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
                high = int(len(found)).bit_length() - 1
                steps = block_steps(found, members)
                leaves = found[addresses(high + 1)[high][:members]]
                subroot = root if subroot is None else subroot
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * members, pa.string()), pa.array((block << height) + np.arange(members)),
                     pa.array([s.tobytes() + path for s in steps], pa.binary()), pa.array([subroot] * members, pa.binary()),
                     pa.array([d.tobytes() for d in leaves], pa.binary()),
                     *(batch.column(7 + i).slice(at, 1).flatten() for i in range(len(carried)))],
                    names=["tree", "block", "path", "subroot", "digest", *carried])

    return joined.mapInArrow(run, schema)


def _descended(levels: Sequence[DataFrame], heads: DataFrame, height: int, carried: Sequence[str]) -> DataFrame:
    """The leaves of all trees with their paths; ``heads`` has ``tree, path`` from each tree's root on.

    A block is met by exactly one row from above: by the step from its place
    in the block over it, or, where a tree ends, by its tree's head.
    """
    below = None
    for at in range(len(levels) - 1, -1, -1):
        ended = levels[at].filter(F.col("n") <= 1 << height).select("tree")
        above = heads.join(ended, "tree", "left_semi").select(
            "tree", F.lit(0).cast("long").alias("block"), "path", F.lit(None).cast("binary").alias("subroot"))
        if below is not None:
            above = above.unionByName(below.select("tree", "block", "path", "subroot"))
        below = _with_paths(levels[at], above, height, carried if at == 0 else ())
        if at:
            below = stage(below, f"paths-{at}")
    return below


def proofs(manifest: Manifest) -> DataFrame:
    """``key, digest, claimed, subroot, path`` of every leaf; an empty table has none."""
    spark = manifest.levels[0].sparkSession
    above = spark.createDataFrame([("", b"")], "tree string, path binary")
    heads = stage(_descended(manifest.top, above, manifest.height, ("name",)).select(F.col("name").alias("tree"), "path"), "heads")
    return _descended(manifest.levels, heads, manifest.height, ("key", "claimed")).select(
        "key", "digest", "claimed", "subroot", "path")


def verified(found: DataFrame, root: bytes | None, key: str = "doc_id") -> DataFrame:
    """Each row of ``proofs`` checked: its claimed (else its own) digest folded along its path against ``root``.

    Columns: the key under its name, ``leaf, subroot, root, proof_sha256, folded_root`` in
    lower-case hexadecimal, and ``verified``.
    """
    kind = dict(found.dtypes)["key"]
    names = [key, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, claims, subroots, paths = (batch.column(i).to_pylist() for i in range(1, 5))
            ends = [folded(leaf if claim is None else claim, path) for leaf, claim, path in zip(leaves, claims, paths)]
            text = [[d.hex() for d in column] for column in (leaves, subroots, [root] * len(ends))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.string()) for c in text),
                 pa.array([siblings_digest(p) for p in paths], pa.string()), pa.array([e.hex() for e in ends], pa.string()),
                 pa.array([e == root for e in ends], pa.bool_())], names=names)

    return found.mapInArrow(run, f"`{key}` {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                                 "folded_root string, verified boolean")


#: The columns of a document's record, in the order in which they enter its digest.
RECORD = ("doc_id", "source", "lang", "n_chars", "text")


def document_proofs(docs: DataFrame) -> DataFrame:
    """Every document's leaf and proof, checked once more after a known part of the rows was tampered with.

    Where 7 divides the unsigned CRC-32 of the decimal ``doc_id``, one is added to
    ``n_chars`` in the record that is verified (a null stays null, so that record is
    unchanged). Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``,
    one row for each row of ``docs``; without a ``doc_id`` a row is never tampered with.
    """
    own = [F.col(c) for c in RECORD]
    more = [(F.col(c).cast("decimal(20,0)") + 1).cast("string") if c == "n_chars" else F.col(c) for c in RECORD]
    chosen = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    manifest = build_manifest(docs, record_digest(own), "lang", "doc_id", F.when(chosen, record_digest(more)))
    return verified(proofs(manifest), manifest.root)
