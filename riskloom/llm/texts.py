"""Small helpers the text operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once per row: a one-element array stands for a local name.

    A value that a lambda names is computed anew for each element unless it is bound like this.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores behind it until no column in ``taken`` has it (in any case of letters)."""
    names = {t.lower() for t in taken}
    while name.lower() in names:
        name += "_"
    return name


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` and nothing else, a null text as the empty one.

    Operators work on these two columns only, so other columns of the input,
    whatever their names, cannot clash with theirs.
    """
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


# The fixed classes: plain white space, and every other character that some
# definition takes for white space, with the invisible ones near them.
UNUSUAL_SPACE = re.compile(
    "[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
#: After a printable ASCII character, before plain white space, and between a Han character and a stop:
#: a token border by every definition.
SURE_BORDER = re.compile("(?<=[!-~])(?=[ \t\n\r])|(?<=[\u4e00-\u9fff])(?=[\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f])")


def segments(text: str, limit: int) -> Iterator[str]:
    """The text in parts of about ``limit`` characters, cut only at sure token borders."""
    start = 0
    while len(text) - start > limit and (border := SURE_BORDER.search(text, start + limit)):
        yield text[start:border.start()]
        start = border.start()
    yield text[start:] if start else text


#: A large table's rows are told from the few that may match by this many values of a hash, which all tasks get to
#: know: 8 bytes each, however many rows there are.
HASH_VALUES = 1 << 22


def hash_value(column: Column | str) -> Column:
    """One of ``HASH_VALUES`` numbers."""
    return F.pmod(F.xxhash64(column), F.lit(HASH_VALUES))


def parted_by(rows: DataFrame, value: str, few: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``value`` (a ``hash_value``) occurs in ``few``, and all others; nothing is moved for it.

    Only the first need to be joined with whatever the values stand for; the others, nearly all while the few are few, stay where
    they are read.
    """
    known = F.broadcast(few.select(F.col(value)).distinct())
    return rows.join(known, value, "left_semi"), rows.join(known, value, "left_anti")


def byte_size(text: str) -> int:
    """Bytes of the text in UTF-8."""
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


def by_size(texts: list[str], limit: int) -> Iterator[list[str]]:
    """Consecutive lists of texts of at most about ``limit`` bytes each; a longer text comes alone."""
    group: list[str] = []
    size = 0
    for text in texts:
        own = byte_size(text)
        if group and size + own > limit:
            yield group
            group, size = [], 0
        group.append(text)
        size += own
    if group:
        yield group


class Memo(dict):
    """Values by key that a worker remembers: about ``limit`` of them, or those of the last call if these are more.

    There are two generations. Once the younger one holds half the limit it
    becomes the older one, which is forgotten but for the keys that are asked for again.
    """

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit
        self.older: dict = {}

    def fill(self, keys: set, compute: Callable[[list], Iterable]) -> None:
        """Make every one of ``keys`` known."""
        unknown = keys.difference(self)
        if len(self) + len(unknown) > self.limit // 2:
            self.older = dict(self)
            self.clear()
            unknown = keys
        again = unknown.intersection(self.older)
        self.update((key, self.older[key]) for key in again)
        unknown = list(unknown - again)
        self.update(zip(unknown, compute(unknown)))


def arrow_map(docs: DataFrame, schema: str, rows: Callable[[list, list], dict[str, list]],
              slice_rows: int = 512) -> DataFrame:
    """Apply ``rows(ids, texts) -> columns`` to slices of an ``(id, text)`` table, batch by batch."""
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                columns = rows(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[field.name], type=field.type) for field in target], schema=target)

    return docs.mapInArrow(run, schema)


def consecutive(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows with the same first ``keys`` columns, which arrive next to each other, group by group."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        found = list(zip(*(batch.column(i).to_pylist() for i in range(keys))))
        start = 0
        while start < len(found):
            stop = start + 1
            while stop < len(found) and found[stop] == found[start]:
                stop += 1
            if held and found[start] != key:
                yield pa.Table.from_batches(held)
                held = []
            key = found[start]
            held.append(batch.slice(start, stop - start))
            start = stop
    if held:
        yield pa.Table.from_batches(held)
