"""Text expressions: prefixes, digits, region codes, tokens, synonyms."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, functions as F

# Identity-card wording, both meaning the same document.
ID_DOCUMENT_SYNONYMS = {"居民身份证": "身份证"}

FULL_WIDTH_DIGITS = "０１２３４５６７８９"
# The first and the last Han character of the basic block.
HAN_FIRST, HAN_LAST = "一", "鿿"
HAN = f"{HAN_FIRST}-{HAN_LAST}"
# Every ASCII character that is no letter or digit, and common CJK punctuation.
SEPARATORS = "".join(chr(i) for i in range(128) if not chr(i).isalnum()) + "，。、；：！？（）【】《》“”‘’·…—　"
# One run of Han characters, or one run of anything else between spaces.
RUN = f"[{HAN}]+|[^ {HAN}]+"


def prefix(text: Column, length: int) -> Column:
    """The first ``length`` characters (not bytes)."""
    return F.substring(text, 1, length)


def first_int(text: Column) -> Column:
    """The first run of digits as a number; full-width digits count too."""
    plain = F.translate(text, FULL_WIDTH_DIGITS, "0123456789")
    return F.regexp_extract(plain, r"\d+", 0).try_cast("bigint")


def region_code_parts(code: Column, name: str) -> dict[str, Column]:
    """Province, city, county (two digits each) and the two longer prefixes."""
    digits = F.lpad(code.cast("string"), 6, "0")
    return {
        f"{name}_province": F.substring(digits, 1, 2),
        f"{name}_city": F.substring(digits, 3, 2),
        f"{name}_county": F.substring(digits, 5, 2),
        f"{name}_province_city": F.substring(digits, 1, 4),
        f"{name}_full": F.substring(digits, 1, 6),
    }


def normalise_synonyms(text: Column, synonyms: dict[str, str]) -> Column:
    """Replace whole values that are known synonyms; leave the others."""
    pairs = [F.lit(part) for pair in synonyms.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), text), text)


def tokenize(text: Column, ngram: int = 2) -> Column:
    """Terms of a text, punctuation removed; null for null text.

    Words between separators are terms as they are. A run of Han characters
    longer than ``ngram`` gives its overlapping ``ngram``-character pieces,
    which stand in for a dictionary segmenter.
    """
    spaced = F.translate(text, SEPARATORS, " " * len(SEPARATORS))
    words = F.array_remove(F.split(spaced, " "), "")
    runs = F.regexp_extract_all(spaced, F.lit(RUN), F.lit(0))

    def pieces(run: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(1), F.length(run) - ngram + 1),
            lambda start: F.substr(run, start, F.lit(ngram)),
        )
        is_han = (run >= HAN_FIRST) & (run < chr(ord(HAN_LAST) + 1))
        return F.when(is_han & (F.length(run) > ngram), grams).otherwise(F.array(run))

    # Text without Han characters needs neither the runs nor the pieces.
    return F.when(text.rlike(f"[{HAN}]"), F.flatten(F.transform(runs, pieces))).otherwise(words)


def user_tokenizer(cut: Callable[[str], Iterable[str]]) -> Callable[[Column], Column]:
    """A tokenizer from a function on one text, such as a dictionary segmenter.

    The texts travel in Arrow batches; null stays null.
    """

    @F.pandas_udf("array<string>")
    def tokens(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: list(cut(text)), na_action="ignore")

    return tokens
