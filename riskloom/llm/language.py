"""Language identification with a string kernel and Nyström landmarks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.texts import arrow_map, id_and_text
from riskloom.session import stage

#: Lengths of the n-grams whose presence counts: the blended spectrum.
GRAMS = (1, 2, 3, 4)
#: n-grams are hashed into this many columns (a power of two).
COLUMNS = 1 << 17
#: Bounds of the learning sample: rows of each language, and landmarks among them; rows and landmarks of all
#: languages together; and languages. With more languages than that the most frequent ones are learned.
ROWS_PER_LANGUAGE, LANDMARKS_PER_LANGUAGE = 300, 40
ROWS, LANDMARKS, LANGUAGES = 2_400, 240, 1_000
RIDGE = 1e-2
#: Rows whose feature lists are multiplied together.
SCORED_ROWS = 32
#: Characters whose n-grams are hashed at once.
BLOCK = 1 << 18

UNDETERMINED = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_columns(text: str, mark: np.ndarray) -> np.ndarray:
    """The columns of all n-grams of the text, each once, ascending.

    Case is ignored and everything between letters is one blank. The whole
    text is read, in blocks. ``mark`` is a scratch array of zeros.
    """
    words = " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "
    for start in range(0, len(words), BLOCK):
        block = words[start:start + BLOCK + max(GRAMS) - 1]
        codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        grams = codes[:0]
        for size in range(1, max(GRAMS) + 1):
            if len(codes) < size:
                break
            grams = codes if size == 1 else (grams[:-1] * np.uint64(0x10FFFF + 2) + codes[size - 1:])
            if size in GRAMS:
                mark[((grams + np.uint64(size)) * _MIX >> np.uint64(40)) & np.uint64(COLUMNS - 1)] = 1
    found = np.flatnonzero(mark)
    mark[found] = 0
    return found


def _places(columns: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the wanted columns are among ``columns``; those that are not there are left out."""
    at = np.searchsorted(columns, wanted)
    at[at == len(columns)] = 0
    return at[columns[at] == wanted] if len(columns) else at


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class KernelModel:
    """One column of weights for each language, over the presence of n-grams.

    The kernel of two texts is the number of n-grams in both over the root of
    the product of their numbers. It is an inner product, so landmarks and coefficients
    can be multiplied out, which is how a model of few languages is looked into.
    """

    languages: list[str]
    weights: np.ndarray

    def products(self, found: list[np.ndarray]) -> np.ndarray:
        """For each text, given by its n-gram columns, the sum of their weights."""
        sizes = np.array([len(own) for own in found])
        return np.add.reduceat(self.weights[np.concatenate(found)], np.cumsum(sizes) - sizes, axis=0)

    def scores(self, texts: list[str]) -> np.ndarray:
        """The scores of each text, batch by batch."""
        mark = np.zeros(COLUMNS, np.uint8)
        out = np.zeros((len(texts), len(self.languages)))
        for start in range(0, len(texts), SCORED_ROWS):
            found = [gram_columns(t, mark) for t in texts[start:start + SCORED_ROWS]]
            sizes = np.array([len(own) for own in found])
            out[start:start + len(found)] = self.products(found) / np.sqrt(sizes)[:, None]
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        labels, best = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if known:
            scores = self.scores([texts[i] for i in known])
            for i, at, value in zip(known, scores.argmax(axis=1).tolist(), scores.max(axis=1).tolist()):
                labels[i], best[i] = self.languages[at], min(max(value, 0.0), 1.0)
        return labels, best


class LandmarkModel(KernelModel):
    """Landmark texts and one column of coefficients for each language.

    ``columns`` are the n-gram columns that any landmark has, ascending; ``landmarks`` has a row for
    each landmark: its presence there, over the root of its number of n-grams. A model travels as
    one bit for each of these numbers.
    """

    def __init__(self, languages: list[str], columns: np.ndarray, landmarks: np.ndarray, coefficients: np.ndarray):
        self.languages, self.columns, self.landmarks, self.coefficients = languages, columns, landmarks, coefficients

    def __getstate__(self) -> dict:
        return {**self.__dict__, "landmarks": np.packbits(self.landmarks > 0, axis=1), "size": self.landmarks.max(axis=1, initial=0)}

    def __setstate__(self, state: dict) -> None:
        bits, size = state.pop("landmarks"), state.pop("size")
        self.__dict__.update(state)
        self.landmarks = np.unpackbits(bits, axis=1, count=len(self.columns)).astype(np.float32)
        self.landmarks *= size[:, None]

    def products(self, found: list[np.ndarray]) -> np.ndarray:
        """The kernel of the batch and the landmarks as one matrix product, times the coefficients."""
        present = np.zeros((len(found), len(self.columns)), np.float32)
        for row, own in zip(present, found):
            row[_places(self.columns, own)] = 1
        return (present @ self.landmarks.T).astype(np.float64) @ self.coefficients

    def folded(self) -> KernelModel:
        """The same model with landmarks and coefficients multiplied out: a weight per n-gram column and language."""
        weights = np.zeros((COLUMNS, len(self.languages)))
        weights[self.columns] = self.landmarks.T.astype(np.float64) @ self.coefficients
        return KernelModel(self.languages, weights)


def learning_rows(docs: DataFrame, rows_per_language: int, id_col: str, text_col: str, lang_col: str,
                  all_rows: int = ROWS, most_languages: int = LANGUAGES) -> DataFrame:
    """``(lang, columns)`` of a bounded number of rows of each language: those of smallest hash.

    Only rows that are not held out, have a language and a letter take part, and of the languages at most
    ``most_languages``, the most frequent ones (ties by name). Each has ``rows_per_language`` rows, or its
    share of ``all_rows`` if that is less. Counts by language thin the rows to about four times as many as wanted
    before any text is moved, so what is moved does not grow with the table.
    ``columns`` is a bit per n-gram column, so a row has ``COLUMNS / 8`` bytes however long its text is.
    """
    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("_id")) \
        .filter(~held_out(F.col("_id")) & F.col("lang").isNotNull())
    counts = labelled.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(most_languages).collect()
    rows_per_language = max(1, min(rows_per_language, all_rows // max(1, len(counts))))
    if counts:
        share = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], 4.0 * rows_per_language / r["count"])))
        labelled = labelled.filter(F.pmod(F.xxhash64("_id", "text"), F.lit(1 << 31)) < share[F.col("lang")] * (1 << 31))
    picked = Window.partitionBy("lang").orderBy("_key", "text")
    sample = labelled.filter(F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("_id", "text").alias("_key")) \
        .withColumn("_nth", F.row_number().over(picked)).filter(F.col("_nth") <= rows_per_language).select("lang", "text")

    def rows(langs: list, texts: list) -> dict[str, list]:
        mark = np.zeros(COLUMNS, np.uint8)
        packed = []
        for text in texts:
            present = np.zeros(COLUMNS, np.uint8)
            present[gram_columns(text, mark)] = 1
            packed.append(np.packbits(present).tobytes())
        return {"lang": langs, "columns": packed}

    return arrow_map(sample, "lang string, columns binary", rows, slice_rows=64)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_language_model(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE,
                       landmarks_per_language: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE,
                       id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LandmarkModel:
    """Kernel ridge regression, one language against the rest, in the span of the landmarks.

    The sample is bounded by ``rows_per_language`` rows of a language, ``ROWS`` rows and ``LANGUAGES`` languages
    in all, and reaches the driver as ``COLUMNS / 8`` bytes a row. Landmarks are dealt out in turn, up to
    ``landmarks_per_language`` to a language and ``LANDMARKS`` in all. Ties of the sample are
    broken by the text, so the model does not depend on the order of rows.
    """
    sample = stage(learning_rows(docs, rows_per_language, id_col, text_col, lang_col), "language-sample") \
        .orderBy("lang", "columns").collect()
    names = sorted({r["lang"] for r in sample})
    if not sample:
        return LandmarkModel([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros((0, 0)))
    number = {name: at for at, name in enumerate(names)}
    labels = np.array([number[r["lang"]] for r in sample])

    def dense(rows) -> np.ndarray:
        present = np.unpackbits(np.stack([np.frombuffer(sample[i]["columns"], np.uint8) for i in rows]), axis=1)
        return present.astype(np.float32)

    rng = np.random.default_rng(0)
    per_language = min(landmarks_per_language, max(1, LANDMARKS // len(names)))
    marks = np.concatenate([rng.permutation(np.flatnonzero(labels == c))[:per_language] for c in range(len(names))])[:LANDMARKS]
    landmarks = dense(marks)
    columns = np.flatnonzero(landmarks.any(axis=0))
    landmarks = landmarks[:, columns] / np.sqrt(landmarks.sum(axis=1, keepdims=True))
    kernel = np.zeros((len(sample), len(marks)))
    for start in range(0, len(sample), 64):
        block = dense(range(start, min(start + 64, len(sample))))
        kernel[start:start + 64] = block[:, columns] @ landmarks.T / np.sqrt(block.sum(axis=1, keepdims=True))
    targets = np.eye(len(names))[labels]
    # Every language has the same say, however many rows it has.
    weight = (len(sample) / len(names) / np.bincount(labels))[labels][:, None]
    among = kernel[marks]
    left = kernel.T @ (weight * kernel) + ridge * len(sample) / len(marks) * among + 1e-8 * np.eye(len(marks))
    return LandmarkModel(names, columns, landmarks, np.linalg.solve(left, kernel.T @ (weight * targets)))


def predict_language(docs: DataFrame, model: KernelModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from its whole text and nothing else.

    A null text, one without letters, and any text under a model that learned
    nothing are ``und`` with score 0. Repeated rows get equal answers; an empty
    table gives no rows. Equal scores go to the language first in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(ids: list, texts: list) -> dict[str, list]:
        labels, scores = shared.value.predict(texts)
        return {"doc_id": ids, "lang_pred": labels, "score": scores}

    kind = dict(docs.dtypes)[id_col]
    return arrow_map(id_and_text(docs, id_col, text_col), f"doc_id {kind}, lang_pred string, score double", rows)


def keep_determined(docs: DataFrame, model: KernelModel, least: float, text_col: str = "text") -> DataFrame:
    """The rows whose text has a language and a score of at least ``least``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                labels, scores = shared.value.predict([t or "" for t in part.column(at).to_pylist()])
                yield part.filter(pa.array([name != UNDETERMINED and score >= least
                                            for name, score in zip(labels, scores)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
