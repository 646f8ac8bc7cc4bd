"""Token counts of whole texts, by the tokenizers library."""

from __future__ import annotations

import os
import re
from functools import lru_cache

from pyspark.sql import DataFrame

from riskloom.llm.texts import SURE_BORDER, UNUSUAL_SPACE, Memo, arrow_map, by_size, byte_size, id_and_text, segments

#: Bytes of one call to the library, and characters of a part of a long text.
BATCH_CHARS = 1 << 20
#: Distinct pieces whose count a worker remembers.
MEMO_PIECES = 300_000

# A token of the byte-level pattern never runs from a character that is not
# white space into one that is, and white space belongs to what follows. A
# piece is therefore white space together with the characters after it.
_PIECE = re.compile("[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")


def pieces(text: str) -> list[str]:
    """The text cut where the tokenizer's own pattern always cuts.

    Texts with unusual white space are cut only after a printable ASCII
    character that plain white space follows, which is safe by every definition.
    """
    return SURE_BORDER.split(text) if UNUSUAL_SPACE.search(text) else _PIECE.findall(text)


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def _memo(path: str) -> Memo:
    return Memo(MEMO_PIECES)


def count_tokens(texts: list[str], path: str) -> list[int]:
    """Lengths of the encodings of ``texts``, special strings handled as the library does by default."""
    tokenizer, memo = load_tokenizer(path), _memo(path)

    def encode(unknown: list[str]):
        for batch in by_size(unknown, BATCH_CHARS):
            yield from map(len, tokenizer.encode_batch_fast(batch, add_special_tokens=False))

    lengths = [0] * len(texts)
    parts = [(at, part) for at, text in enumerate(texts) for part in segments(text, BATCH_CHARS)]
    done = 0
    for group in by_size([part for _, part in parts], BATCH_CHARS):
        cut = [pieces(part) for part in group]
        memo.fill(set().union(*cut), encode)
        for (at, _), found in zip(parts[done:], cut):
            lengths[at] += sum(map(memo.__getitem__, found))
        done += len(cut)
    return lengths


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    A null or empty text has no bytes and no tokens. Repeated rows are counted
    again, an empty table gives no rows. Texts travel once to the Arrow
    function, only lengths come back. A long text is cut into pieces at places
    where the tokenizer cuts anyway (before white space, and before the stops of Han text); calls
    are balanced by bytes. A text without any such place is one call.
    """

    def rows(ids, texts):
        counts = count_tokens(texts, path)
        return {"doc_id": ids, "n_bytes": [byte_size(t) for t in texts], "n_tokens": counts,
                "over_limit": [n > limit for n in counts]}

    kind = dict(docs.dtypes)[id_col]
    return arrow_map(id_and_text(docs, id_col, text_col),
                     f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", rows)
