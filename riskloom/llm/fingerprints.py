"""Document fingerprints from closed syncmers with their positions."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a k-mer and of the inner substrings whose smallest decides.
K, INNER = 16, 6
#: Anchors of a fingerprint.
ANCHORS = 64
#: Characters hashed at once, so that memory does not grow with the text.
BLOCK = 1 << 18

_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15

# A fingerprint: hashes in ascending order and the place of each.
Anchors = tuple[np.ndarray, np.ndarray]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads close values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_A
    values = (values ^ (values >> np.uint64(27))) * _MIX_B
    return values ^ (values >> np.uint64(31))


def _window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` codes: a polynomial by doubling of its width."""
    out, have, done = np.zeros(max(len(codes) - width + 1, 0), np.uint64), codes, 0
    power, size = _BASE, 1
    while done < width:
        if width & size:
            part = have[done:done + len(out)]
            out = out * np.uint64(power) + part[:len(out)]
            done += size
        have = have[:-size] * np.uint64(power) + have[size:] if len(have) > size else have[:0]
        power, size = power * power % (1 << 64), 2 * size
    return mix(out)


def closed_syncmers(codes: np.ndarray, k: int = K, inner: int = INNER) -> Anchors:
    """Hashes and places of the k-mers whose smallest inner substring is their first or their last.

    Whether a k-mer is chosen depends on its own characters alone, so an edit
    moves or removes only anchors that contain it.
    """
    if len(codes) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    small = _window_hashes(codes, inner)
    span = k - inner + 1
    count = len(small) - span + 1
    least, have, done, size = None, small, 0, 1
    while done < span:
        if span & size:
            part = have[done:done + count]
            least = part if least is None else np.minimum(least, part)
            done += size
        have, size = np.minimum(have[:-size], have[size:]) if len(have) > size else have[:0], 2 * size
    at = np.flatnonzero((small[:count] == least) | (small[span - 1:] == least))
    return _window_hashes(codes, k)[at], at


def fingerprint(text: str, k: int = K, inner: int = INNER, anchors: int = ANCHORS) -> Anchors:
    """The anchors of smallest hash, each at its first place.

    The whole text is read, block by block; blocks overlap by a k-mer less a
    character. A text shorter than a k-mer, or with no closed syncmer, is its
    own only anchor; the empty text has none.
    """
    best = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for start in range(0, max(len(text) - k + 1, 1), BLOCK):
        block = text[start:start + BLOCK + k - 1]
        codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        hashes, places = closed_syncmers(codes, k, inner)
        hashes, places = np.concatenate([best[0], hashes]), np.concatenate([best[1], places + start])
        hashes, first = np.unique(hashes, return_index=True)
        best = hashes[:anchors], places[first[:anchors]]
    if text and not len(best[0]):
        whole = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        best = np.frombuffer(whole, "<u8").astype(np.uint64), np.zeros(1, np.int64)
    return best


def likeness(one: Anchors, other: Anchors, anchors: int = ANCHORS) -> float:
    """Share of common anchors among the smallest of both, counted along a common order.

    The smallest ``anchors`` hashes of the union are a random sample of all
    anchors of both texts. Common anchors count if they lie on a longest chain
    of places that ascend in both texts, so insertions and deletions, which
    move all that follows, cost only what they change, and passages in another
    order do not all count. Two empty texts are alike (1), an empty and another
    are not (0).
    """
    if not len(one[0]) or not len(other[0]):
        return float(len(one[0]) == len(other[0]))
    sample = np.union1d(one[0], other[0])[:anchors]
    common, left, right = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    common_in = common <= sample[-1]
    left, right = one[1][left[common_in]], other[1][right[common_in]]
    # The smallest last place of an ascending chain of each length.
    ends: list[int] = []
    for place in right[np.argsort(left)].tolist():
        at = bisect_left(ends, place)
        ends[at:at + 1] = [place]
    return len(ends) / len(sample)


def written(found: Anchors) -> str:
    """Anchors as text: hash in hexadecimal and place, ``@`` between, blanks between anchors."""
    return " ".join(f"{h:016x}@{p}" for h, p in zip(found[0].tolist(), found[1].tolist()))


def edited_text(text: str, following: str) -> str:
    """The last third of the text replaced by as many first characters of the following one, or all it has."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def in_descending_blocks(docs: DataFrame, per_partition: int = 4) -> DataFrame:
    """``(doc_id, text, _block, _guest)`` in tasks that hold whole blocks of neighbouring ids, largest first.

    Block borders are quantiles of the ids, some for each shuffle partition.
    The first row of a block is sent to the block before as well, as its last
    row and ``_guest``, and the very first row to the last block: so each row
    meets its successor in its own task.
    """
    spark = docs.sparkSession
    blocks = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull())
    borders = np.unique(np.array(ids.stat.approxQuantile(
        "doc_id", [i / blocks for i in range(1, blocks)], 1 / (4 * blocks)) or [0.0]))

    @F.pandas_udf("int")
    def block_of(values: pd.Series) -> pd.Series:
        # From 0 with the largest ids; null ids come last of all.
        known = values.notna().to_numpy()
        out = np.full(len(values), len(borders) + 1, np.int32)
        out[known] = len(borders) - np.searchsorted(borders, values[known].to_numpy(float), "right")
        return pd.Series(out)

    heads = ids.groupBy(block_of("doc_id").alias("_block")).agg(F.max("doc_id").alias("head")).collect()
    first = {r["_block"]: r["head"] for r in heads}
    if docs.filter(F.col("doc_id").isNull()).limit(1).count():
        first[len(borders) + 1] = None
    present = sorted(first)
    # One row per block: which id's rows are sent to which block as well. Ids are compared as they are.
    guests = spark.createDataFrame([(first[block], present[i - 1]) for i, block in enumerate(present)], "_head long, _as_guest int")
    placed = docs.withColumn("_block", block_of("doc_id")) \
        .join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("_head")), "left")
    return placed.withColumn("_place", F.explode(F.when(F.col("_as_guest").isNull(), F.array(
        F.struct(F.col("_block").alias("b"), F.lit(False).alias("g")))).otherwise(F.array(
            F.struct(F.col("_block").alias("b"), F.lit(False).alias("g")),
            F.struct(F.col("_as_guest").alias("b"), F.lit(True).alias("g")))))).select(
        "doc_id", "text", F.col("_place.b").alias("_block"), F.col("_place.g").alias("_guest")) \
        .repartition(blocks // per_partition, "_block") \
        .sortWithinPartitions("_block", "_guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc())


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. Documents follow each other by descending id
    (rows of one id by descending text, null ids last), the first follows the
    last. Ids are integers. A null text is empty. In a table of one row the row follows itself;
    an empty table gives no rows. Texts cross the network once.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for row in zip(*(column.to_pylist() for column in part.columns)):
                    if held is not None and held[2] == row[2]:
                        yield held, row
                        held = None if row[3] else row
                    elif held is not None:
                        raise RuntimeError(f"block {held[2]} has no row that follows document {held[0]}")
                    elif not row[3]:
                        held = row
        if held is not None:
            raise RuntimeError(f"block {held[2]} has no row that follows document {held[0]}")

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        known: tuple[tuple | None, Anchors | None] = (None, None)
        for row, following in pairs(batches):
            own = known[1] if known[0] is row else fingerprint(row[1])
            after = fingerprint(following[1])
            known = following, after
            edited = edited_text(row[1], following[1])
            changed = fingerprint(edited)
            digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            out.append((row[0], len(row[1]), digest, written(own), written(changed), likeness(own, changed),
                        likeness(own, after)))
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return in_descending_blocks(rows).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
