"""Word-level BPE: greedy proposals, checked pair by pair, merged exactly where a check fails."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from riskloom.llm.merges import Merges
from riskloom.llm.texts import Memo, arrow_map, by_size, id_and_text, segments

#: Characters that are worked on together.
BATCH_CHARS = 1 << 20
#: Distinct words and token pairs a worker remembers.
MEMO_WORDS, MEMO_PAIRS = 500_000, 500_000

# The fixed pattern of the vocabulary's pre-tokenizer with white space spelled
# out, and the same for text in plain lower-case ASCII.
_WORD = regex.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]"
    "|[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\\p{L}\\p{N}]+")
_ASCII_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")

_WORD_OR_BREAK, _ASCII_WORD_OR_BREAK = regex.compile("\n|" + _WORD.pattern), re.compile("\n|" + _ASCII_WORD.pattern)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), ord("\xff") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    code = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}
    return [chr(code[b]) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one tokenizer file with word-end suffixes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            described = json.load(source)
        model = described["model"]
        self.end: str = model["end_of_word_suffix"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.added = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.names = {i: name for name, i in {**self.ids, **self.added}.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges([(self.ids[left], self.ids[right]) for left, right in pairs],
                             [self.ids[left + right] for left, right in pairs])
        self.longest = max(len(name.removesuffix(self.end)) for name in self.ids)
        self.bytes = byte_characters()
        # The id of each byte within a word and at its end, -1 where the vocabulary has none.
        self.inner, self.final = (np.array([self.ids.get(c + end, -1) for c in self.bytes], np.int32) for end in ("", self.end))
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) \
            if self.added else None
        self.words, self.pairs, self.alone = Memo(MEMO_WORDS), Memo(MEMO_PAIRS), Memo(2 * len(self.names))

    # The exact algorithm.

    def characters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the bytes of all words, one word after another, and how many each word has."""
        whole = "".join(words)
        sizes = map(len, words) if whole.isascii() else (len(w.encode()) for w in words)
        lengths = np.fromiter(sizes, np.int64, len(words))
        found = np.frombuffer(whole.encode(), np.uint8)
        ends = np.cumsum(lengths)[lengths > 0] - 1
        symbols = self.inner[found]
        symbols[ends] = self.final[found[ends]]
        known = symbols >= 0
        if not known.all():
            counts = np.concatenate([[0], np.cumsum(known)])
            lengths = counts[np.cumsum(lengths)] - counts[np.cumsum(lengths) - lengths]
            symbols = symbols[known]
        return symbols, lengths

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words by exact merging, one word after another, and how many each word has."""
        return self.merges.merge_all(*self.characters(words))

    def spelled(self, token: int) -> list[int]:
        """The single characters of a token, as ids."""
        name = self.names[token]
        at_end = name.endswith(self.end) and name != self.end
        name = name[:-len(self.end)] if at_end else name
        return [self.ids[c] for c in name[:-1]] + [self.ids[name[-1] + (self.end if at_end else "")]]

    def _merge_back(self, spellings: list[list[int]], tokens: list[list[int]]) -> list[bool]:
        """Whether each spelling, merged, gives the tokens it was made from."""
        sizes = np.fromiter(map(len, spellings), np.int64, len(spellings))
        found, lengths = self.merges.merge_all(np.fromiter(chain.from_iterable(spellings), np.int64, int(sizes.sum())), sizes)
        ends = np.cumsum(lengths).tolist()
        return [found[end - n:end].tolist() == own for end, n, own in zip(ends, lengths.tolist(), tokens)]

    # Speculation and its check.

    def propose(self, word: str) -> list[int]:
        """Longest match from the left; nothing if some part is in no token."""
        ids, end, at, size, found = self.ids, self.end, 0, len(word), []
        whole = ids.get(word + end)
        if whole is not None:
            return [whole]
        while at < size:
            token = ids.get(word[at:] + end) if size - at <= self.longest else None
            if token is not None:
                found.append(token)
                return found
            for stop in range(min(size - 1, at + self.longest), at, -1):
                token = ids.get(word[at:stop])
                if token is not None:
                    break
            else:
                return []
            found.append(token)
            at = stop
        return found

    def _pairs_hold(self, keys: list[int]) -> list[bool]:
        """Whether two tokens next to each other, spelled out and merged, give the same two tokens."""
        pairs = [list(divmod(key, 1 << 20)) for key in keys]
        return self._merge_back([self.spelled(left) + self.spelled(right) for left, right in pairs], pairs)

    def _token_holds(self, tokens: list[int]) -> list[bool]:
        """Whether a token, spelled out and merged, gives itself."""
        return self._merge_back([self.spelled(t) for t in tokens], [[t] for t in tokens])

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Propose for all words, test all adjacent pairs at once, merge the failing words exactly.

        A split into tokens is the result of merging exactly if every pair of
        neighbours is the result of merging its own characters.
        """
        shown = self.bytes
        spelled = [w if w.isascii() and w.isprintable() else "".join([shown[b] for b in w.encode()]) for w in words]
        proposed = [self.propose(word) for word in spelled]
        lengths = np.fromiter(map(len, proposed), np.int64, len(words))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        fails = lengths == 0
        inside = owner[1:] == owner[:-1]
        keys, place = np.unique(((flat[:-1] << 20) + flat[1:])[inside], return_inverse=True)
        self.pairs.fill(set(keys.tolist()), self._pairs_hold)
        holds = np.fromiter(map(self.pairs.__getitem__, keys.tolist()), bool, len(keys))
        fails[owner[1:][inside][~holds[place]]] = True
        single = np.flatnonzero(lengths == 1)
        tokens = [proposed[i][0] for i in single]
        self.alone.fill(set(tokens), self._token_holds)
        fails[single[[not self.alone[t] for t in tokens]]] = True
        packed, ends = flat.astype("<u4").tobytes(), (np.cumsum(lengths) * 4).tolist()
        out = [packed[start:end] for start, end in zip([0, *ends], ends)]
        failing = np.flatnonzero(fails).tolist()
        exact, sizes = self.merged([words[at] for at in failing])
        packed, ends = exact.astype("<u4").tobytes(), (np.cumsum(sizes) * 4).tolist()
        for at, start, end in zip(failing, [0, *ends], ends):
            out[at] = packed[start:end]
        return out

    def split(self, text: str) -> list[str]:
        """Normalised words of the text; a special string is a word of its own."""
        if self.special is None:
            return self.ordinary(text)
        out, at = [], 0
        for match in self.special.finditer(text):
            out += self.ordinary(text[at:match.start()])
            out.append(match.group())
            at = match.end()
        return out + self.ordinary(text[at:])

    def ordinary(self, text: str, breaks: bool = False) -> list[str]:
        """Normalised words of a text without special strings; with ``breaks`` its line breaks too."""
        if text.isascii():
            return (_ASCII_WORD_OR_BREAK if breaks else _ASCII_WORD).findall(text.lower())
        plain = unicodedata.normalize("NFC", text)
        # In the vocabulary's normalizer no letter depends on its neighbours; in Python only this one does.
        plain = plain.lower() if "\u03a3" not in plain else "".join(map(str.lower, plain))
        return (_WORD_OR_BREAK if breaks else _WORD).findall(plain)

    def split_all(self, pieces: list[str]) -> tuple[list[str], np.ndarray]:
        """The words of all pieces, which hold neither white space nor special strings, and how many each piece has."""
        found = self.ordinary("\n".join(pieces), True)
        breaks = np.array([-1, *[at for at, word in enumerate(found) if word == "\n"], len(found)])
        return [word for word in found if word != "\n"], np.diff(breaks)[:len(pieces)] - 1

    def _encode_unknown(self, words: list[str]) -> list[bytes]:
        ordinary = [w for w in words if w not in self.added]
        found = dict(zip(ordinary, self._encode_words(ordinary)))
        return [found[w] if w in found else np.array([self.added[w]], "<u4").tobytes() for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        parts = [(at, part) for at, text in enumerate(texts) for part in segments(text, BATCH_CHARS)]
        done = 0
        for group in by_size([part for _, part in parts], BATCH_CHARS):
            cut = [self.split(part) for part in group]
            self.words.fill(set().union(*cut), self._encode_unknown)
            for (at, _), found in zip(parts[done:], cut):
                out[at].append(b"".join(map(self.words.__getitem__, found)))
            done += len(cut)
        return [b"".join(ids) for ids in out]

    def decode(self, ids: bytes) -> str:
        """The tokens' own spelling with a space between; the file names no decoder."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load_word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit) of every row; null and empty texts have no ids."""
    kind = dict(docs.dtypes)[id_col]
    return arrow_map(id_and_text(docs, id_col, text_col), f"doc_id {kind}, ids binary",
                     lambda ids, texts: {"doc_id": ids, "ids": load_word_bpe(path).encode(texts)})


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of every row of encoded ids; null ids decode to the empty text."""
    kind = dict(encoded.dtypes)[id_col]
    return arrow_map(encoded.select(id_col, ids_col), f"doc_id {kind}, text string", lambda ids, rows: {
        "doc_id": ids, "text": [load_word_bpe(path).decode(row or b"") for row in rows]})


def round_trips(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, encoded and decoded again.

    Both steps run in one Arrow function, so neither ids nor texts are
    shuffled or written. A null text counts as empty (no tokens, empty text);
    repeated rows are encoded again; an empty table gives no rows. Long texts
    are cut at sure token borders, the hashes cover the whole.
    """

    def rows(ids, texts):
        bpe = load_word_bpe(path)
        encoded = bpe.encode(texts)
        return {"doc_id": ids, "n_tokens": [len(e) // 4 for e in encoded],
                "ids_sha256": [hashlib.sha256(e).hexdigest() for e in encoded],
                "decoded_sha256": [hashlib.sha256(bpe.decode(e).encode()).hexdigest() for e in encoded]}

    kind = dict(docs.dtypes)[id_col]
    return arrow_map(id_and_text(docs, id_col, text_col),
                     f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", rows)
