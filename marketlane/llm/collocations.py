"""Phrase collocations: suffix arrays over word numbers in each shard of texts, counts merged by phrase over all shards.

A shard is some ``SHARD_BYTES`` of the texts of one language. Prefix doubling in numpy sorts its suffixes by their first
words; the intervals of the array whose longest common prefix has k words are the phrases of k words with their counts.
A shard sends each distinct phrase once.

A phrase is as frequent as each of its parts at most. So three passes over the texts count words, then pairs of frequent
words, then longer phrases all of whose pairs are frequent. What is frequent goes to the shards as a bitmap of hashes of
at most ``MAX_BITS`` bits, whatever the corpus: a false hit there costs a row and changes no count, as phrases are merged
by their text. Parts of a candidate are frequent themselves, so its scores are joins among the merged counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlane.llm.common import Scratch, bounded, byte_texts, sliced
from marketlane.llm.tokens import byte_map, cut, numbered

SHARD_BYTES = 16 << 20
#: Rows that leave a worker at once.
ROWS = 1 << 16
#: Bits of a bitmap at most (64 MB). Where more is frequent than fits, more phrases are counted for nothing.
MAX_BITS = 1 << 29
#: Copies of each count that meet the parts of candidates, so that a part of very many phrases isn't one task's.
SALTS = 8
_BYTES = byte_map(b"\t", b".,;:!?\n\x0b\x0c\r")
_COUNTS = "lang string, length int, phrase binary, c long"
_ARROW = pa.schema([("lang", pa.string()), ("length", pa.int32()), ("phrase", pa.binary()), ("c", pa.int64())])


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, in order of their first ``depth`` symbols at least: ranks by 1, 2, 4, ... symbols."""
    rank, known, n = symbols.astype(np.int64), 1, len(symbols)
    while True:
        order = np.argsort(rank, kind="stable").astype(np.int32)
        if known >= depth or n == 0:
            return order
        ascending = rank[order]
        dense = np.empty(n, np.int32)
        dense[order] = np.cumsum(np.concatenate(([True], ascending[1:] != ascending[:-1])), dtype=np.int32)
        del ascending
        if dense[order[-1]] == n:
            return order
        rank = dense * np.int64(n + 1)
        rank[:-known] += dense[known:]
        known *= 2


def common_prefixes(symbols: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each place of the array: symbols that it shares with the one before, ``depth`` at most; symbol 0 ends both."""
    padded = np.concatenate((symbols, np.zeros(depth, symbols.dtype)))
    out = np.zeros(len(order), np.int8)
    alike = np.arange(1, len(order), dtype=np.int32)
    for k in range(depth):
        a, b = padded[order[alike - 1] + k], padded[order[alike] + k]
        alike = alike[(a == b) & (a != 0)]
        out[alike] += 1
    return out


def _run_lengths(good: np.ndarray) -> np.ndarray:
    """From each place, how many good ones follow without a gap, itself included."""
    bad = np.append(np.flatnonzero(~good), len(good))
    return bad[np.searchsorted(bad, np.arange(len(good)))] - np.arange(len(good))


class Bitmap:
    """Hashes of frequent phrases, as ``xxhash64(lang, phrase)`` gives them in Spark."""

    def __init__(self, data: bytes, lang: str) -> None:
        self.bits, self.mask = np.frombuffer(data, np.uint8), 8 * len(data) - 1
        self.seed = xxhash.xxh64_intdigest(lang.encode(), 42)

    def hits(self, phrases: list[bytes]) -> np.ndarray:
        digest, seed, mask = xxhash.xxh64_intdigest, self.seed, self.mask
        at = np.fromiter((digest(x, seed) & mask for x in phrases), np.int64, len(phrases))
        return self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def _joined(words: pa.Array, *numbers: np.ndarray) -> pa.Array:
    return pc.binary_join_element_wise(*(words.take(pa.array(x)) for x in numbers), pa.scalar(b" ", words.type)) if len(numbers) > 1 else words.take(pa.array(numbers[0]))


def _shard_counts(part: bytes, lang: str, lengths: range, words_in: bytes | None, pairs_in: bytes | None) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of ``lengths`` in one shard; length 0 stands for all its words."""

    def rows(length: int, phrases: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(counts), ROWS):
            some = counts[k : k + ROWS].astype(np.int64)
            n = len(some)
            columns = [pa.array([lang] * n, pa.string()), pa.array(np.full(n, length, np.int32)), phrases.slice(k, n).cast(pa.binary()), pa.array(some)]
            yield pa.record_batch(columns, schema=_ARROW)

    _, number, words = numbered([part.replace(b"\n", b" \n ")])
    end = words.index(b"\n").as_py()
    if words_in is None:
        counts = np.bincount(number[number != end], minlength=len(words))
        present = np.flatnonzero(counts)
        yield from rows(1, words.take(pa.array(present)), counts[present])
        yield from rows(0, pa.array([b""], pa.binary()), counts.sum(keepdims=True))
        return
    frequent = Bitmap(words_in, lang).hits(words.to_pylist())
    if end >= 0:
        frequent[end] = False
    # Symbols: 0 ends a phrase, word w is w + 1. Several ends in a row say no more than one.
    symbols = np.where(frequent[number], number + np.int32(1), np.int32(0))
    symbols = symbols[(symbols != 0) | np.concatenate(([False], symbols[:-1] != 0))]
    reach = _run_lengths(symbols != 0)
    if pairs_in is not None and len(symbols):
        inside = np.flatnonzero(reach[:-1] >= 2)
        distinct, place = np.unique(symbols[inside] * np.int64(len(words) + 1) + symbols[inside + 1], return_inverse=True)
        hit = Bitmap(pairs_in, lang).hits(_joined(words, distinct // (len(words) + 1) - 1, distinct % (len(words) + 1) - 1).to_pylist())
        good = np.zeros(len(symbols), bool)
        good[inside] = hit[place]
        reach = np.where(reach > 0, _run_lengths(good) + 1, 0)
    order = suffix_array(symbols, lengths[-1])
    shared = common_prefixes(symbols, order, lengths[-1])
    for k in lengths:
        starts = np.flatnonzero(shared < k)
        counts = np.diff(np.append(starts, len(order)))
        whole = reach[order[starts]] >= k
        at = order[starts[whole]]
        if len(at):
            yield from rows(k, _joined(words, *(symbols[at + j] - 1 for j in range(k))), counts[whole])


def _counted(docs: DataFrame, lengths: range, least: int, words_in=None, pairs_in=None) -> DataFrame:
    """Phrases that occur ``least`` times or more, over all shards: lang, length, phrase, c."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                for part in cut(b"\n".join(texts).translate(_BYTES), SHARD_BYTES):
                    yield from _shard_counts(part, lang, lengths, words_in and words_in.value, pairs_in and pairs_in.value)
            held.clear()

        for b in sliced(batches, 1):
            for lang, text in zip(b.column(0).to_pylist(), byte_texts(b.column(1)), strict=True):
                held.setdefault(lang, []).append(text)
                size += len(text)
            if size >= SHARD_BYTES:
                yield from flush()
                size = 0
        yield from flush()

    found = docs.mapInArrow(run, _COUNTS).withColumn("phrase", F.col("phrase").cast("string"))
    merged = found.groupBy("lang", "length", "phrase").agg(F.sum("c").alias("c"))
    return merged.filter((F.col("c") >= least) | (F.col("length") == 0))


def _bitmap(frequent: DataFrame):
    """A broadcast bitmap of the phrases' hashes: 16 bits for each phrase or more, ``MAX_BITS`` at most."""
    bits = 1 << 16
    while bits < min(16 * frequent.count(), MAX_BITS):
        bits *= 2
    place = frequent.select((F.pmod(F.xxhash64("lang", "phrase"), F.lit(bits)) + 1).alias("b"))
    parts = place.groupBy(F.bitmap_bucket_number("b").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits"))
    out = bytearray(bits // 8)
    for part, data in parts.collect():  # bits / 32768 rows of 4 KB at most
        at = (part - 1) * 4096
        out[at : at + 4096] = data[: len(out) - at]
    return frequent.sparkSession.sparkContext.broadcast(bytes(out))


def _salted(df: DataFrame, salts: int) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def scored(counts: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut, without those that a longer one covers: lang, phrase, a, l, r, n, score."""
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    candidates = counts.filter("length >= 2")
    first, rest = F.expr("substring_index(phrase, ' ', k)"), F.expr("substring(phrase, char_length(substring_index(phrase, ' ', k)) + 2)")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("c").alias("a"), "k", first.alias("first"), rest.alias("rest"), salt.alias("salt"))
    parts = _salted(counts.filter("length >= 1").select("lang", "phrase", "c"), SALTS)
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(part), F.col("c").alias(name), "salt"), ["lang", part, "salt"])
    totals = _salted(counts.filter("length = 0").select("lang", F.col("c").alias("n")), SALTS)
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    dividend = (wide("a") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(23,0)") * wide("n").cast("decimal(15,0)")
    divisor = (wide("l") * wide("r")).cast("decimal(38,0)")
    cuts = cuts.join(totals, ["lang", "salt"]).withColumn("x", dividend).withColumn("y", divisor)
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr("x div y").alias("score"), "k", "l", "r")).alias("cut"))
    # A longer candidate that occurs as often contains one that is longer by a word and occurs as often, too.
    shorter = F.array(F.expr("substring_index(phrase, ' ', length - 1)"), F.expr("substring(phrase, char_length(substring_index(phrase, ' ', 1)) + 2)"))
    longer = candidates.filter("length >= 3").select("lang", F.explode(shorter).alias("phrase"), "c").groupBy("lang", "phrase").agg(F.max("c").alias("most"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter("most IS NULL OR 100 * most < 100 * a")
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 100, max_words: int = 5, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts, A-Z lower-cased, are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, and pieces at blanks and tabs into words. A
    candidate has 2 to ``max_words`` words and occurs ``min_count`` times or more within pieces, overlaps included. Its
    score is floor(1000 * a * n / (l * r)) at the cut where that is least, the first of equal ones; a candidate goes if a
    longer one that contains it occurs as often. A null language counts as ``und``; null and empty texts have no words; rows
    that repeat count again, ids play no part. Ties go by a, then by phrase in byte order. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    bounded(docs.sparkSession)
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    words = scratch.write(_counted(source, range(1, 2), min_count))
    words_in = _bitmap(words.filter("length = 1"))
    pairs = scratch.write(_counted(source, range(2, 3), min_count, words_in))
    counts = words.unionByName(pairs)
    if max_words > 2:
        pairs_in = _bitmap(pairs.filter("length = 2"))
        longer = scratch.write(_counted(source, range(3, max_words + 1), min_count, words_in, pairs_in))
        counts = counts.unionByName(longer)
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = scored(counts).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(8 * SALTS)))
    some = found.withColumn("nth", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*by))).filter(F.col("nth") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long")).filter(F.col("rank") <= top)
    out = scratch.write(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    scratch.drop(words, pairs, *([longer] if max_words > 2 else []))
    return out


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang),
places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM worded, (SELECT unnest(range(1, 6)) AS k) AS lengths),
counts AS (
  SELECT lang, k, phrase, count(*) AS c FROM (SELECT lang, k, array_to_string(w[pos:pos + k - 1], ' ') AS phrase FROM places) AS x
  GROUP BY lang, k, phrase HAVING count(*) >= 100),
candidates AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2),
cuts AS (SELECT *, unnest(range(1, k)) AS pos FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.pos, l.c AS l, r.c AS r, t.n, (1000::HUGEINT * c.a * t.n) // (l.c::HUGEINT * r.c) AS score
  FROM cuts AS c JOIN counts AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.pos], ' ')
  JOIN counts AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.pos + 1:], ' ') JOIN totals AS t ON t.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, pos) AS nth FROM scored),
kept AS (
  SELECT * FROM best AS b WHERE nth = 1 AND NOT EXISTS (
    SELECT 1 FROM candidates AS c WHERE c.lang = b.lang AND c.k > b.k AND 100 * c.a >= 100 * b.a AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
