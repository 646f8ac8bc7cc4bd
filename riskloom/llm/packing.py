"""Packing of token sequences as a cutting-stock problem, solved by column generation."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.bpe import load_word_bpe
from riskloom.llm.texts import SURE_BORDER, UNUSUAL_SPACE, arrow_map, by_size, id_and_text, segments
from riskloom.llm.token_counts import load_tokenizer
from riskloom.session import stage

#: Tokens of a sequence.
CAPACITY = 2048
#: Up to this length pieces fill what room is left by their exact length; longer ones are in the linear program,
#: their length rounded up to 4 or 8 tokens: by one in a hundred or less on average.
SHORT = 256
STEPS = ((512, 4), (CAPACITY, 8))
#: The linear program's unit of length, which divides all steps.
UNIT = 4
#: The program stops once it is proven to be this close to the optimum.
GAP = 5e-4
#: Distinct pieces of text whose ids a worker remembers, characters that are worked on together.
MEMO_PIECES, BATCH_CHARS = 500_000, 1 << 21


# Documents to pieces.

# Pieces without white space in signs, digits and letters of European languages: what the vectorised encoder
# takes. All others, and those with special strings, go to the library.
_ORDINARY = re.compile("[!-~\u00a1-\u00ac\u00ae-\u017f]+")


class PieceIds:
    """The ids of pieces of text, kept in one array; the least recently used half is forgotten at ``limit`` pieces."""

    def __init__(self, path: str, limit: int = MEMO_PIECES):
        self.path, self.limit, self.turn = path, limit, 0
        self.rows: dict[str, int] = _Numbered()
        self.ids = np.zeros(0, "<u4")
        self.starts, self.sizes, self.used = (np.zeros(0, np.int64) for _ in range(3))

    def lookup(self, pieces: list[str]) -> np.ndarray:
        """The row of each piece; rows hold until ``forget``."""
        rows, known = self.rows, len(self.starts)
        found = np.fromiter(map(rows.__getitem__, pieces), np.int64, len(pieces))
        if len(rows) > known:
            self._add(list(islice(reversed(rows), len(rows) - known))[::-1])
        self.used[found] = self.turn
        return found

    def forget(self) -> None:
        """Between two batches: make room."""
        self.turn += 1
        if len(self.rows) <= self.limit:
            return
        kept = np.sort(np.argsort(-self.used, kind="stable")[:self.limit // 2])
        chosen = set(kept.tolist())
        names = [name for at, name in enumerate(self.rows) if at in chosen]
        self.ids, self.sizes = self.gather(kept), self.sizes[kept]
        self.starts, self.used = np.cumsum(self.sizes) - self.sizes, self.used[kept]
        self.rows = _Numbered(zip(names, range(len(names))))

    def gather(self, rows: np.ndarray) -> np.ndarray:
        """The ids of the rows, one after another."""
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[rows] - (ends - sizes), sizes)
        at += np.arange(len(at))
        return self.ids[at]

    def _add(self, pieces: list[str]) -> None:
        encoder = load_word_bpe(self.path)
        ordinary = np.array([bool(_ORDINARY.fullmatch(p)) and "<|" not in p for p in pieces], bool)
        plain = np.fromiter(map(str.isascii, pieces), bool, len(pieces))
        sizes, starts = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        ids, held = [self.ids], len(self.ids)
        for number, kind in enumerate((ordinary & plain, ordinary & ~plain, ~ordinary)):
            chosen = [pieces[at] for at in np.flatnonzero(kind).tolist()]
            if number < 2:
                words, counts = encoder.split_all(chosen)
                found, lengths = encoder.merged(words)
                upto, ends = np.concatenate([[0], np.cumsum(lengths)]), np.cumsum(counts)
                own = upto[ends] - upto[ends - counts]
            else:
                lists = [e.ids for batch in by_size(chosen, BATCH_CHARS)
                         for e in load_tokenizer(self.path).encode_batch_fast(batch, add_special_tokens=False)]
                found, own = np.fromiter(chain.from_iterable(lists), "<u4"), np.fromiter(map(len, lists), np.int64)
            sizes[kind] = own
            starts[kind] = held + np.cumsum(own) - own
            ids.append(found.astype("<u4"))
            held += len(found)
        self.ids, self.sizes = np.concatenate(ids), np.concatenate([self.sizes, sizes])
        self.starts = np.concatenate([self.starts, starts])
        self.used = np.concatenate([self.used, np.zeros(len(pieces), np.int64)])


class _Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


@lru_cache(maxsize=2)
def _store(path: str) -> PieceIds:
    return PieceIds(path)


def _piece_rows(parts: list[str], store: PieceIds) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the pieces between white space, part by part, and how many each part has.

    Arrow splits and numbers the pieces, so only the distinct ones of a batch become strings. The vocabulary
    ignores case, so plain ASCII is lower-cased first (unless a special string could arise from it). Parts with
    unusual white space are cut at sure borders instead.
    """
    if len(parts) == 1 and UNUSUAL_SPACE.search(parts[0]):
        rows = store.lookup([p.strip(" \t\n\r") for p in SURE_BORDER.split(parts[0])])
        return rows, np.array([len(rows)])
    lowered = [p.lower() if p.isascii() and "<|" not in p else p for p in parts]
    split = pc.ascii_split_whitespace(pa.array(lowered, pa.string()))
    pieces = split.flatten().dictionary_encode()
    # No piece holds a line break: joining and splitting is the fastest way to strings.
    distinct = pc.binary_join(pa.ListArray.from_arrays([0, len(pieces.dictionary)], pieces.dictionary), "\n")[0].as_py()
    rows = store.lookup(distinct.split("\n") if len(pieces.dictionary) else [])
    return rows[pieces.indices.to_numpy()], np.diff(split.offsets.to_numpy())


def _batches(parts: list[str]) -> Iterator[list[str]]:
    """Consecutive parts of about ``BATCH_CHARS`` characters; one with unusual white space comes alone."""
    group: list[str] = []
    size = 0
    for part in parts:
        unusual = bool(UNUSUAL_SPACE.search(part))
        if group and (unusual or size + len(part) > BATCH_CHARS):
            yield group
            group, size = [], 0
        group.append(part)
        size += BATCH_CHARS if unusual else len(part)
    if group:
        yield group


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """The library's ids of each text as little-endian unsigned 32-bit integers.

    The vocabulary drops white space, and its words never contain any, so
    texts are encoded by distinct piece, and gathered batch by batch.
    """
    store = _store(path)
    out: list[list[bytes]] = [[] for _ in texts]
    parts = [(at, part) for at, text in enumerate(texts) for part in segments(text, BATCH_CHARS)]
    done = 0
    for group in _batches([part for _, part in parts]):
        store.forget()
        rows, counts = _piece_rows(group, store)
        upto = np.concatenate([[0], np.cumsum(store.sizes[rows])])[np.concatenate([[0], np.cumsum(counts)])] * 4
        ids = store.gather(rows).tobytes()
        for (at, _), start, end in zip(parts[done:], upto.tolist(), upto[1:].tolist()):
            out[at].append(ids[start:end])
        done += len(group)
    return [own[0] if len(own) == 1 else b"".join(own) for own in out]


def token_pieces(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: each document's ids, cut at full sequences.

    The ids are the library's with ``end_id`` behind them; null and empty
    texts consist of that id alone. Only the last piece of a document is
    shorter than a sequence, so no document is cut without need.
    """

    def rows(ids, texts):
        out: dict[str, list] = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": []}
        mark = np.array([end_id], "<u4").tobytes()
        for doc_id, encoded in zip(ids, encode_texts(texts, path)):
            encoded += mark
            for start in range(0, len(encoded), 4 * capacity):
                piece = encoded[start:start + 4 * capacity]
                out["doc_id"].append(doc_id)
                out["start"].append(start // 4)
                out["length"].append(len(piece) // 4)
                out["ids_crc32"].append(zlib.crc32(piece))
                out["doc_tokens"].append(len(encoded) // 4)
        return out

    kind = dict(docs.dtypes)[id_col]
    return arrow_map(id_and_text(docs, id_col, text_col),
                     f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long", rows, 1024)


# The linear program, over a histogram of some hundred classes.

def class_size(length: int) -> int:
    """The length that a piece is booked with."""
    step = next((step for most, step in ((SHORT, 1), *STEPS) if length <= most), STEPS[-1][1])
    return -(-length // step) * step


def best_pattern(sizes: np.ndarray, prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The dearest multiset of sizes (ascending) that fits into ``room``: the unbounded knapsack's table, and its trace.

    No entry depends on one less than the smallest size below it, so the table is filled in
    blocks of that many spaces at once.
    """
    block = int(sizes[0])
    value, taken = np.zeros(room + 1), np.full(room + 1, -1)
    for start in range(block, room + 1, block):
        spaces = np.arange(start, min(start + block, room + 1))
        fits = int(np.searchsorted(sizes, spaces[-1], "right"))
        below = spaces - sizes[:fits, None]
        reached = np.where(below >= 0, value[np.maximum(below, 0)] + prices[:fits, None], -1.0)
        best = reached.argmax(axis=0)
        worth = reached[best, np.arange(len(spaces))]
        # An empty rest costs nothing: the best of all smaller spaces counts too.
        upto = np.maximum.accumulate(np.concatenate([[value[start - 1]], worth]))[:-1]
        better = worth > upto + 1e-12
        value[spaces] = np.maximum(worth, upto)
        taken[spaces[better]] = best[better]
    pattern, space = np.zeros(len(sizes), np.int64), room
    while space > 0:
        if taken[space] < 0:
            space -= 1
        else:
            pattern[taken[space]] += 1
            space -= sizes[taken[space]]
    return float(value[room]), pattern


def column_generation(sizes: np.ndarray, counts: np.ndarray, room: int, gap: float = GAP,
                      rounds: int = 20_000) -> tuple[list[np.ndarray], np.ndarray, float]:
    """Patterns and how often each is used (fractions), so that every class is covered exactly, and the gap reached.

    The revised simplex method starts with one pattern per class. The dual
    prices go to the knapsack, whose best pattern enters while it is worth
    more than one sequence. Demand times prices, divided by that worth, is a
    lower bound; within ``gap`` of it, or after ``rounds`` exchanges, the
    solution at hand is returned, which is feasible at any time.
    """
    copies = room // sizes
    patterns = [np.eye(len(sizes), dtype=np.int64)[i] * copies[i] for i in range(len(sizes))]
    inverse, use = np.diag(1.0 / copies), counts / copies
    bound = 0.0
    for _ in range(rounds):
        prices = inverse.sum(axis=0)
        worth, pattern = best_pattern(sizes, np.maximum(prices, 0), room)
        bound = max(bound, float(prices @ counts / max(worth, 1.0)))
        if worth <= 1 + 1e-9 or use.sum() * (1 - gap) <= bound:
            break
        change = inverse @ pattern
        ratio = np.full(len(use), np.inf)
        np.divide(use, change, out=ratio, where=change > 1e-9)
        leaves = int(ratio.argmin())
        step = ratio[leaves]
        use = np.maximum(use - step * change, 0)
        use[leaves] = step
        patterns[leaves] = pattern
        row = inverse[leaves] / change[leaves]
        inverse -= np.outer(change, row)
        inverse[leaves] = row
    return patterns, use, max(0.0, 1 - bound / use.sum())


@dataclass
class Plan:
    """Which sequence takes which ranks of a class, as parallel arrays sorted by class and first rank.

    ``gap`` is how far the linear program's solution may be from its optimum: the parameter, unless the
    program was stopped by its number of rounds.
    """

    classes: np.ndarray
    first_rank: np.ndarray
    copies: np.ndarray
    first_sequence: np.ndarray
    gap: float

    def sequences(self, classes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        key = np.int64(1) << 44
        at = np.searchsorted(self.classes * key + self.first_rank, classes * key + ranks, "right") - 1
        return self.first_sequence[at] + (ranks - self.first_rank[at]) // self.copies[at]


def filled_up(sizes: np.ndarray, left: np.ndarray, room: int, times: int) -> Iterator[tuple[np.ndarray, int]]:
    """``(pattern, times)`` that fill ``times`` sequences with ``room`` each from ``left``, largest first; ``left`` shrinks.

    A class of which too few are left for all sequences alike parts these into two, and is used up by that.
    """
    todo = [(np.zeros(len(sizes), np.int64), room, times, len(sizes) - 1)]
    while todo:
        pattern, space, n, at = todo.pop()
        while at >= 0:
            fit = min(space // int(sizes[at]), -(-int(left[at]) // n))
            if fit and left[at] < fit * n:
                # The first ones get one more than the others.
                more = int(left[at]) - (fit - 1) * n
                rest = pattern.copy()
                rest[at] = fit - 1
                todo.append((rest, space - (fit - 1) * int(sizes[at]), n - more, at - 1))
                left[at] -= (fit - 1) * (n - more)
                n = more
            pattern[at] = fit
            left[at] -= fit * n
            space -= fit * int(sizes[at])
            at -= 1
        yield pattern, n


def make_plan(histogram: dict[int, int], capacity: int, gap: float = GAP, short: int = 0, unit: int = 1) -> Plan:
    """A plan for pieces of the sizes given, by the number of each; ``unit`` divides the capacity and all sizes above ``short``.

    Long pieces: the program's solution is rounded down and the rest packed largest first, at most a few
    sequences per class. Short ones then take the room that is left, by exact length, and sequences of their own.
    """
    every = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[s] for s in every], np.int64)
    long = every > short
    sizes, left = every[long], counts[long].copy()
    uses: list[tuple[np.ndarray, int]] = []
    reached = 0.0
    if len(sizes):
        patterns, use, reached = column_generation(sizes // unit, left.astype(float), capacity // unit, gap)
        for pattern, times in zip(patterns, np.floor(use + 1e-7).astype(np.int64)):
            held = pattern > 0
            times = min(int(times), int((left[held] // pattern[held]).min()))
            if times:
                uses.append((pattern, times))
                left -= times * pattern
    while left.any():
        pattern, space = np.zeros(len(sizes), np.int64), capacity
        for i in range(len(sizes) - 1, -1, -1):
            pattern[i] = min(left[i], space // sizes[i])
            space -= pattern[i] * sizes[i]
        held = pattern > 0
        times = int((left[held] // pattern[held]).min())
        uses.append((pattern, times))
        left -= times * pattern
    small, few = every[~long], counts[~long].copy()
    whole: list[tuple[np.ndarray, int]] = []
    for pattern, times in uses:
        for own, n in filled_up(small, few, capacity - int(pattern @ sizes), times):
            whole.append((np.concatenate([own, pattern]), n))
    while few.any():
        times = max(1, int(few @ small) // capacity)
        for own, n in filled_up(small, few, capacity, times):
            whole.append((np.concatenate([own, np.zeros(len(sizes), np.int64)]), n))
    rows, rank, sequence = [], np.zeros(len(every), np.int64), 0
    for pattern, times in whole:
        for i in np.flatnonzero(pattern):
            rows.append((every[i], rank[i], pattern[i], sequence))
            rank[i] += pattern[i] * times
        sequence += times
    return Plan(*np.array(sorted(rows), np.int64).reshape(-1, 4).T, reached)


# Pieces to sequences.

def rank_in_class(pieces_df: DataFrame, order: list[str]) -> DataFrame:
    """Add ``_rank``, gapless from 0 within ``_class``, without ever gathering a class.

    Rows are dealt by a hash into slices; a class's rows are numbered slice by
    slice, behind those of the slices before. ``_salt`` is part of the order, so equal rows are dealt out too.
    """
    slices = 4 * int(pieces_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces_df.withColumn("_slice", F.pmod(F.xxhash64(*order, "_salt"), F.lit(slices)))
    before = Window.partitionBy("_class").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("_class", "_slice").agg(F.count(F.lit(1)).alias("_n")).select(
        "_class", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_class", "_slice").orderBy(*order, "_salt")) - 1
    return dealt.withColumn("_local", local).join(offsets, ["_class", "_slice"]) \
        .withColumn("_rank", F.col("_before") + F.col("_local")).drop("_before", "_local", "_slice")


def booked(length: Column) -> Column:
    """``class_size`` as a column."""
    out = length
    for most, step in reversed(STEPS):
        out = F.when(length <= most, F.ceil(length / step) * step).otherwise(out)
    return F.when(length <= SHORT, length).otherwise(out).cast("long")


def assign_sequences(pieces_df: DataFrame, capacity: int = CAPACITY, gap: float = GAP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table with ``length`` (1 to ``capacity``, which 8 divides).

    The pieces are written once, each with a random number that tells equal rows apart.
    The driver sees only the histogram: some hundred counts.
    Pieces are ranked within their class, the plan turns class and rank into a
    sequence, and offsets are running sums within a sequence, longest piece
    first. An empty table gives no rows; repeated rows are separate pieces.
    """
    order = [c for c in pieces_df.columns]
    written = stage(pieces_df.withColumn("_salt", F.rand(5)), "pieces")
    classed = written.withColumn("_class", booked(F.col("length")))
    histogram = {r["_class"]: r["n"] for r in classed.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = make_plan(histogram, capacity, gap, SHORT, UNIT)
    ranked = rank_in_class(classed, order).select(*order, "_class", "_rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = plan.sequences(batch.column("_class").to_numpy(zero_copy_only=False),
                                   batch.column("_rank").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in order), pa.array(found, pa.int64())], names=[*order, "sequence_id"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces_df.dtypes) + ", sequence_id long"
    within = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), *order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return ranked.mapInArrow(place, schema).withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)))


def pack_documents(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Texts are encoded once; the pieces, some numbers each, are written, and
    everything else reads those.
    """
    return assign_sequences(token_pieces(docs, path, end_id, capacity, id_col, text_col), capacity)
