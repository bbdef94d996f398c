"""Repetition coverage rules: rolling hashes of several n-gram lengths over the words of one text, in numpy.

Every document is judged by itself, so the operator is one pass over the rows without a shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlane.llm.common import Rolling, WordHashes, add_columns, byte_texts, covered

#: Share of word characters inside duplicated n-grams above which a text fails, and the same for duplicated lines:
#: the published thresholds of the Gopher repetition rules.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20
MIN_WORDS, WINDOW, MAX_REPEAT = 20, 8, 30
SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(c for c in range(256) if c not in SYMBOLS)
_CONTINUATION = bytes(range(0x80, 0xC0))
_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

COLUMNS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("dup_line_chars", T.DoubleType()), T.StructField("dup_ngram_chars", T.MapType(T.IntegerType(), T.DoubleType()))]
    + [T.StructField(n, T.BooleanType()) for n in ("base_failed", "kept")]
)


def repeated(hashes: np.ndarray) -> np.ndarray:
    """Starts of the windows whose hash occurs more than once, the first occurrence included."""
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    return order[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(order) else order


def judged(text: bytes, hash_words: WordHashes, rolling: Rolling) -> tuple:
    words = text.split()
    n = len(words)
    word_chars = len(text.translate(None, _CONTINUATION + _SPACES))
    n_symbols = len(text.translate(None, _NOT_SYMBOLS))
    seen: set[bytes] = set()
    n_dup_lines = line_chars = 0
    for line in text.split(b"\n"):
        if line in seen:
            n_dup_lines += 1
            line_chars += len(line.translate(None, _CONTINUATION + _SPACES))
        elif line and not line.isspace():
            seen.add(line)
    prefix = rolling.prefix(hash_words(words))
    # Characters of each word: all of a word's bytes but the continuation bytes of UTF-8.
    ascii_only = len(text) == len(text.translate(None, _CONTINUATION))
    sizes = np.fromiter(map(len, words) if ascii_only else (len(w.translate(None, _CONTINUATION)) for w in words), np.int64, n)
    shares, n_repeat = {}, 0
    for length in sorted({WINDOW, *NGRAM_LIMITS}):
        starts = repeated(rolling.windows(prefix, length))
        inside = covered(starts, starts + length, n) if len(starts) else None
        if length == WINDOW and inside is not None:
            n_repeat = int(inside.sum())
        if length in NGRAM_LIMITS:
            shares[length] = float(sizes[inside].sum()) / word_chars if inside is not None else 0.0
    base_failed = n < MIN_WORDS or 100 * n_repeat > MAX_REPEAT * n
    line_share = line_chars / word_chars if word_chars else 0.0
    kept = not base_failed and line_share <= LINE_LIMIT and all(shares[k] <= v for k, v in NGRAM_LIMITS.items())
    return n, word_chars, n_symbols, n_dup_lines, n_repeat, line_share, list(shares.items()), base_failed, kept


def quality_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``COLUMNS``; columns of the same names are replaced.

    Words are runs of ``[^\\x20\\x09-\\x0D]``. Null and empty texts have no words and fail. A line counts as duplicated
    if it has a word and equals an earlier line. dup_line_chars and dup_ngram_chars are shares of word_chars that lie in
    duplicated lines (the first one excluded) and in n-grams that occur twice or more (the first one included).
    """

    def work(batches):
        hash_words, rolling = WordHashes(), Rolling()
        for b in batches:
            rows = [judged(t, hash_words, rolling) for t in byte_texts(b[text_col])]
            columns = zip(*rows, strict=True) if rows else [()] * len(COLUMNS)
            yield {f.name: list(c) for f, c in zip(COLUMNS, columns, strict=True)}

    return add_columns(docs, [text_col], COLUMNS, work)


__all__ = ["quality_rules", "judged", "repeated"]
