"""Benchmark decontamination with an FM-index per training shard.

Each batch of documents is a shard. Its words, as numbers of the phrases' alphabet, form a text over which an FM-index
is built: suffix array by prefix doubling, Burrows-Wheeler transform, wavelet matrix for ranks, and suffix positions
sampled at every 8th place. All phrases are searched backward at once; occurrences are located by walking to a sampled
suffix, and their spans are merged. Runs of words that contain a word foreign to all phrases can't hold an occurrence,
so words outside the alphabet, and runs shorter than the shortest phrase, are not indexed; this loses nothing.

The phrases come from the driver in blocks of at most ``block_windows``, each of which is broadcast; a further block is
a further pass over the rows, which the pass before it has written. Neither a task nor the driver ever holds more than
one block. Nothing is shuffled. The index keeps a bit for each symbol and wavelet level, with a count for each 64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlane.llm.common import ASCII_WORD, LOWER, Scratch, add_columns, byte_texts, covered, runs, without

SAMPLE = 8
#: Turns A-Z into a-z and every byte that is in no word into a space.
_WORDS = bytes(c if c >= 0x80 or ASCII_WORD.match(bytes([c])) else 0x20 for c in bytes(range(256)).translate(LOWER))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


@dataclass
class Phrases:
    """One block: distinct windows by length, as numbers of words, and the items of each."""

    vocabulary: dict[bytes, int]
    by_length: dict[int, np.ndarray]
    items: dict[int, list[list[str]]]

    @classmethod
    def of(cls, rows: list[tuple[str | None, tuple[bytes, ...]]]) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        groups: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, window in rows:
            key = tuple(vocabulary.setdefault(w, len(vocabulary) + 1) for w in window)
            owners = groups.setdefault(len(key), {}).setdefault(key, set())
            if item is not None:
                owners.add(item)
        return cls(vocabulary, {n: np.array(list(g), np.int64).reshape(len(g), n) for n, g in groups.items()}, {n: [sorted(x) for x in g.values()] for n, g in groups.items()})


class Bits:
    """A packed row of bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray) -> None:
        raw = np.packbits(bits.astype(bool), bitorder="little")
        padded = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        padded[: len(raw)] = raw
        self.words = padded.view(np.uint64)
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.zeros = len(bits) - int(np.count_nonzero(bits))

    def ones(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class FMIndex:
    """Over positive symbols; zeros separate runs, and no match crosses them."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        self.n = len(text)
        order = self._suffixes(text)
        bits = text[order - 1]
        # Beside every 8th position the first of each run is sampled: walks then never cross a separator.
        self.sampled = Bits((order % SAMPLE == 0) | (bits == 0))
        self.positions = order[(order % SAMPLE == 0) | (bits == 0)]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        self.levels: list[Bits] = []
        for level in reversed(range(max(1, int(symbols - 1).bit_length()))):
            ones = ((bits >> level) & 1).astype(bool)
            self.levels.append(Bits(ones))
            bits = np.concatenate((bits[~ones], bits[ones]))
        self.start = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        n, gaps = len(text), text == 0
        rank = text.astype(np.int64) + int(gaps.sum())
        rank[gaps] = np.arange(int(gaps.sum()))  # each separator is a symbol of its own
        step = 1
        while True:
            key = rank * (int(rank.max()) + 2)
            key[: n - step] += rank[step:] + 1
            order = np.argsort(key)
            key = key[order]
            fresh = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
            rank[order] = fresh
            if fresh[-1] == n - 1 or step >= n:
                return order.astype(np.int32)
            step *= 2

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        depth = len(self.levels)
        for k, bits in enumerate(self.levels):
            ones = bits.ones(i)
            i = np.where((symbol >> (depth - 1 - k)) & 1, bits.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._down(symbol, i) - self.start[symbol]

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix one position earlier."""
        symbol, i = np.zeros(len(row), np.int64), row
        for bits in self.levels:
            one, ones = bits.at(i), bits.ones(i)
            symbol = 2 * symbol + one
            i = np.where(one, bits.zeros + ones, i - ones)
        return self.first[symbol] + i - self.start[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase the range of rows that begin with it."""
        last = phrases[:, -1]
        low, high = self.first[last], self.first[last + 1]
        live = np.flatnonzero(low < high)
        for k in range(phrases.shape[1] - 2, -1, -1):
            c = phrases[live, k]
            low[live] = self.first[c] + self.rank(c, low[live])
            high[live] = self.first[c] + self.rank(c, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, steps, todo = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            done = self.sampled.at(rows[todo])
            hit = todo[done]
            out[hit] = self.positions[self.sampled.ones(rows[hit])] + steps[hit]
            todo = todo[~done]
            rows[todo] = self.back(rows[todo])
            steps[todo] += 1
        return out


def occurrences(ids: np.ndarray, doc_ends: np.ndarray, phrases: Phrases, longest_shard: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, phrase, start) of every occurrence of a phrase in one batch of documents' word numbers (0: foreign)."""
    shortest = min(phrases.by_length)
    known = ids > 0
    known_breaks = np.zeros(len(ids) + 1, bool)
    known_breaks[doc_ends[:-1]] = True
    starts, ends = runs(known)
    cuts = np.flatnonzero(known_breaks[:-1] & known)  # a run that goes on over a document's end is cut there
    starts, ends = np.union1d(starts, cuts), np.union1d(ends, cuts[np.isin(cuts, starts, invert=True)])
    keep = ends - starts >= shortest
    starts, ends = starts[keep], ends[keep]
    sizes = ends - starts + 1
    shard = np.cumsum(sizes) // longest_shard
    for s in np.unique(shard):
        a, b = starts[shard == s], ends[shard == s]
        size = b - a + 1
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)
        last = np.cumsum(size) - 1
        text = ids[np.minimum(at, len(ids) - 1)]
        text[last] = 0
        index = FMIndex(text, len(phrases.vocabulary) + 1)
        for length, block in phrases.by_length.items():
            low, high = index.search(block)
            found = np.flatnonzero(low < high)
            if len(found):
                count = high[found] - low[found]
                rows = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[found], count)
                yield length, np.repeat(found, count), at[index.locate(rows)]


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", _SPAN), T.StructField("item_ids", T.ArrayType(T.StringType()))])


def cut_spans(text: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans; what stood before the first of these words meets what stood behind the last."""
    places = [m.span() for m in ASCII_WORD.finditer(text.translate(LOWER))]
    parts, done = [], 0
    for s in spans:
        parts.append(text[done : places[s["start"]][0]])
        done = places[s["end"] - 1][1]
    return b"".join([*parts, text[done:]])


def _search(docs: DataFrame, text_col: str, block, further: bool, longest_shard: int, cut: bool) -> DataFrame:
    """One pass over the rows for one block of phrases; with ``cut`` the spans are cut out of the texts at once."""

    def work(batches):
        phrases: Phrases = block.value
        number = phrases.vocabulary
        for b in batches:
            split = [words_of(t) for t in byte_texts(b[text_col])]
            lengths = np.array([len(x) for x in split], np.int64)
            ends = np.cumsum(lengths)
            ids = np.fromiter(map(number.get, chain.from_iterable(split), repeat(0)), np.int32, int(ends[-1]) if len(ends) else 0)
            del split
            spans: list[list[dict]] = [[] for _ in lengths]
            items: list[set[str]] = [set() for _ in lengths]
            if further:
                spans, items = b["spans"].to_pylist(), [set(x) for x in b["item_ids"].to_pylist()]
            if len(ids) and number:
                all_starts, all_ends = [], []
                for length, which, start in occurrences(ids, ends, phrases, longest_shard):
                    all_starts.append(start)
                    all_ends.append(start + length)
                    doc = np.searchsorted(ends, start, "right")
                    pairs = np.unique(doc * len(phrases.by_length[length]) + which)
                    for d, p in zip(*np.divmod(pairs, len(phrases.by_length[length])), strict=True):
                        items[d].update(phrases.items[length][p])
                if all_starts:
                    s, e = np.concatenate(all_starts), np.concatenate(all_ends)
                    order, begins = np.argsort(s), ends - lengths
                    s, e = s[order], e[order]
                    for d in np.unique(np.searchsorted(ends, s, "right")):
                        mine = slice(*np.searchsorted(s, (begins[d], ends[d])))
                        flags = covered(s[mine] - begins[d], e[mine] - begins[d], int(lengths[d]))
                        for old in spans[d]:
                            flags[old["start"] : old["end"]] = True
                        spans[d] = [{"start": int(x), "end": int(y)} for x, y in zip(*runs(flags), strict=True)]
            out = {"n_words": pa.array(lengths), "spans": spans, "item_ids": [sorted(x) for x in items]}
            if cut:
                texts = b[text_col].to_pylist()
                out[text_col] = [cut_spans(t.encode(), s).decode() if s else t for t, s in zip(texts, spans, strict=True)]
            yield out

    new = T.StructType([*_FOUND.fields, T.StructField(text_col, T.StringType())]) if cut else _FOUND
    return add_columns(docs, [text_col, *(["spans", "item_ids"] if further else [])], new, work)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, block_windows: int = 200_000, longest_shard: int = 1 << 17, cut: bool = False) -> DataFrame:
    """``docs`` with n_words, spans (merged intervals of words inside occurrences) and item_ids (sorted as strings).

    Words: runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. Phrases: every ``window`` words in a
    row of an item, or all its words if it has fewer. Null and empty texts have no words and no spans. Items without
    words have no phrases; items with a null id mark words but are in no list. Repeated rows are judged one by one; ids
    of documents play no part. Columns of ``docs`` named like a new one are replaced. With ``cut`` the texts come
    without the spans (which count the words of the input), as by ``remove_spans``, in the same pass.
    """
    spark = docs.sparkSession
    order = [*without(docs, _FOUND.names), *_FOUND.names]
    scratch, rows = Scratch(spark, "decontaminate"), []
    out, block, held = docs, None, []
    for r in benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text_col).alias("t")).toLocalIterator():
        words = words_of((r.t or "").encode())
        rows += [(r.i, tuple(words[k : k + window])) for k in range(max(1, len(words) - window + 1)) if words]
        while len(rows) > block_windows:
            # A table between two blocks: no stage and no worker ever holds more than one.
            block = spark.sparkContext.broadcast(Phrases.of(rows[:block_windows]))
            out = scratch.write(_search(out, text_col, block, bool(held), longest_shard, False))
            block.destroy()
            scratch.drop(*held)
            held, rows = [out], rows[block_windows:]
    last = spark.sparkContext.broadcast(Phrases.of(rows))
    return _search(out, text_col, last, bool(held), longest_shard, cut).select(*order)


def remove_spans(found: DataFrame, text_col: str = "text") -> DataFrame:
    """``decontaminate``'s rows with the spans cut out of the text; untouched texts stay as they are, byte for byte.

    Nothing is put in the place of a span: what separated its first word from the one before it, and its last word from
    the next one, both stay.
    """

    def work(batches):
        for b in batches:
            texts = b[text_col].to_pylist()
            yield {text_col: [cut_spans(t.encode(), s).decode() if s else t for t, s in zip(texts, b["spans"].to_pylist(), strict=True)]}

    order = found.columns
    new = T.StructType([T.StructField(text_col, T.StringType())])
    return add_columns(found, [text_col, "spans"], new, work).select(*order)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return found.select(
        F.col(id_col),
        F.col("n_words"),
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


__all__ = ["FMIndex", "decontaminate", "digest", "remove_spans", "words_of"]
