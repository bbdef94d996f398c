"""Substring dedup: Rabin-Karp hashes of every window of ``window`` words, counted in Spark.

Documents are dealt into batches of about ``BATCH_BYTES`` of text, by id and text, so that neither a large table nor many
rows of one id make a batch larger. A batch hashes all of its windows and keeps each distinct hash once, with the
document where it first occurs (the combine before the shuffle: however often a window repeats, a batch sends it once).
Sorted hashes leave as packed arrays, one row for each batch and range of hashes, told apart by leading bits. A range's
reducer counts its hashes, finds the smallest document of each, and answers with a bitmap for each batch; the batch,
computed anew, unites the bitmaps with its own repeats and merges the covered words into maximal removal intervals. As
rows of hash and place the windows of a text would take six times its bytes; packed, they take two.

A batch splits into ``2**FAN_BITS`` ranges at most, so a row keeps some 64 KB and a table of n times the size has n times
the rows. Where that leaves ranges above ``RANGE_BYTES``, as many batches are merged, range by range, into a group that
splits again, and so on: each level moves the hashes once and multiplies the ranges, and answers come back the same way.

Both passes over the documents read one exchange. Hashes have 64 bits: of N windows, one is taken for another's repeat
with a probability of N / 2**64.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane.llm.common import Rolling, WordHashes, byte_texts, covered, id_key, partitions, runs

#: Bytes of text in a batch, and of packed hashes in a range, on average. A longer text is a batch of its own size.
BATCH_BYTES, RANGE_BYTES = 8 << 20, 16 << 20
#: Bits of a hash that tell the ranges of one level apart; as many batches make a group of the next level.
FAN_BITS = 8
_SPLIT = "bucket long, unit long, docs binary, firsts binary, hashes binary"
_FLAGS = "unit long, bucket long, flags binary"


def packed(hashes: np.ndarray) -> bytes:
    """Ascending hashes as differences, one plane of bytes after another, so that high zero bytes compress."""
    return np.ascontiguousarray(np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


class Batch:
    """The windows of some documents, which are sorted by id and the text's hash."""

    def __init__(self, table: pa.Table, window: int) -> None:
        keys = np.stack((table["__key"].to_numpy(), table["__hash"].to_numpy()), axis=1)
        texts = byte_texts(table["__text"].combine_chunks())
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        self.keys = keys[order]
        self.order, self.words = order.tolist(), [texts[i].split() for i in order]
        hash_words, rolling = WordHashes(), Rolling()
        hashes = [rolling.windows(rolling.prefix(hash_words(w)), window) if len(w) >= window else np.zeros(0, np.uint64) for w in self.words]
        self.ends = np.cumsum([len(h) for h in hashes])
        flat = np.concatenate(hashes)
        by = np.argsort(flat)
        ascending = flat[by]
        self.starts = np.flatnonzero(np.concatenate(([True], ascending[1:] != ascending[:-1]))) if len(flat) else np.zeros(0, np.int64)
        self.by, self.distinct = by, ascending[self.starts]
        self.first = np.minimum.reduceat(by, self.starts) if len(flat) else by

    def flagged(self, later: np.ndarray) -> np.ndarray:
        """For every window: does it start earlier, here or (``later``, by distinct hash) in another batch?"""
        out = np.ones(len(self.by), bool)
        out[self.first[~later]] = False
        return out


def _borders(hashes: np.ndarray, bits: int, at: int = 0, known: int = 0) -> np.ndarray:
    """Where each range of ``bits`` further leading bits starts among ascending hashes that share the first ``known``, ``at``."""
    if not bits:
        return np.array([0, len(hashes)])
    first = (np.uint64(at) << np.uint64(bits)) + np.arange(1 << bits, dtype=np.uint64)
    return np.append(np.searchsorted(hashes, first << np.uint64(64 - known - bits)), len(hashes))


def _split_rows(unit: int, at: int, borders: np.ndarray, docs: np.ndarray, doc: np.ndarray, hashes: np.ndarray) -> pa.Table:
    """A row for each range that has hashes: the documents in it, the place of each hash's first among them, the hashes."""
    small = np.uint16 if len(docs) < 65536 else np.uint32
    rows: dict[str, list] = {"bucket": [], "docs": [], "firsts": [], "hashes": []}
    for k in np.flatnonzero(borders[1:] > borders[:-1]).tolist():
        part = slice(borders[k], borders[k + 1])
        present, place = np.unique(doc[part], return_inverse=True)
        rows["bucket"].append(at + k)
        rows["docs"].append(np.ascontiguousarray(docs[present]).tobytes())
        rows["firsts"].append(place.astype(small).tobytes())
        rows["hashes"].append(packed(hashes[part]))
    bucket = pa.array(rows["bucket"], pa.int64())
    return pa.table({"bucket": bucket, "unit": pa.array([unit] * len(bucket), pa.int64()), **{c: pa.array(rows[c], pa.binary()) for c in ("docs", "firsts", "hashes")}})


def _emit(window: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        batch = Batch(table, window)
        doc = np.searchsorted(batch.ends, batch.first, "right")
        return _split_rows(table["__batch"][0].as_py(), 0, _borders(batch.distinct, bits), batch.keys, doc, batch.distinct)

    return run


class Merged:
    """The hashes of several units in one range: in order of hash and document, with the unit that each comes from."""

    def __init__(self, table: pa.Table) -> None:
        hashes = [unpacked(x) for x in table["hashes"].to_pylist()]
        docs = []
        for d, f, h in zip(table["docs"].to_pylist(), table["firsts"].to_pylist(), hashes, strict=True):
            keys = np.frombuffer(d, np.int64).reshape(-1, 2)
            docs.append(keys[np.frombuffer(f, np.uint16 if len(f) == 2 * len(h) else np.uint32)])
        self.table, self.cuts = table, np.cumsum([len(h) for h in hashes])[:-1]
        flat, self.doc = np.concatenate(hashes), np.concatenate(docs)
        self.order = np.argsort(flat)
        self.hashes = flat[self.order]
        self.again = np.concatenate(([False], self.hashes[1:] == self.hashes[:-1]))
        # Only hashes of several units have to be put in order by document: equal ones stand together already.
        some = np.flatnonzero(self.again | np.append(self.again[1:], False))
        by = np.lexsort((self.doc[self.order[some], 1], self.doc[self.order[some], 0], self.hashes[some]))
        self.order[some] = self.order[some[by]]

    def answers(self, later: np.ndarray) -> pa.Table:
        """For each unit's hashes, by place in the merged order: which of them occur in a smaller document elsewhere."""
        flags = np.zeros(len(later), bool)
        flags[self.order] = later
        bits = [np.packbits(x).tobytes() if x.any() else None for x in np.split(flags, self.cuts)]
        out = pa.table({"unit": self.table["unit"], "bucket": self.table["bucket"], "flags": pa.array(bits, pa.binary())})
        return out.filter(pa.array([b is not None for b in bits]))


def _later(table: pa.Table) -> pa.Table:
    """For each unit's hashes in one range: which of them occur in a smaller document of another unit."""
    merged = Merged(table)
    return merged.answers(merged.again)


def _group_rows(bits: int, known: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, group = (k.as_py() for k in key)
        merged = Merged(table)
        first = ~merged.again
        docs, doc = np.unique(merged.doc[merged.order[first]], axis=0, return_inverse=True)
        hashes = merged.hashes[first]
        return _split_rows(group, bucket << bits, _borders(hashes, bits, bucket, known), docs, doc.reshape(-1), hashes)

    return run


def _group_answers(bits: int, known: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"unit": pa.array([], pa.int64()), "bucket": pa.array([], pa.int64()), "flags": pa.array([], pa.binary())})
        bucket = key[0].as_py()
        merged = Merged(left)
        hashes = merged.hashes[~merged.again]
        borders, elsewhere = _borders(hashes, bits, bucket, known), np.zeros(len(hashes), bool)
        for at, data in zip(right["bucket"].to_pylist(), right["flags"].to_pylist(), strict=True):
            k = at - (bucket << bits)
            elsewhere[borders[k] : borders[k + 1]] = np.unpackbits(np.frombuffer(data, np.uint8), count=borders[k + 1] - borders[k]).astype(bool)
        return merged.answers(merged.again | elsewhere[np.cumsum(~merged.again) - 1])

    return run


def _judged(rows: DataFrame, known: int, rest: int) -> DataFrame:
    """Answers (unit, bucket, flags) for rows whose ranges have ``known`` leading bits and need ``rest`` more to be small."""
    if rest <= 0:
        return rows.groupBy("bucket").applyInArrow(_later, _FLAGS)
    bits = min(rest, FAN_BITS)
    grouped = rows.withColumn("group", F.shiftright("unit", FAN_BITS)).groupBy("bucket", "group")
    finer = grouped.applyInArrow(_group_rows(bits, known), _SPLIT)
    flags = _judged(finer, known + bits, rest - bits)
    back = flags.withColumn("above", F.shiftright("bucket", bits)).groupBy("above", "unit")
    return grouped.cogroup(back).applyInArrow(_group_answers(bits, known), _FLAGS)


def _removed(table: pa.Table, flags: pa.Table, window: int, bits: int):
    """The batch, and for each of its documents a flag for each word: is it covered by a repeated window?"""
    batch = Batch(table, window)
    borders = _borders(batch.distinct, bits)
    later = np.zeros(len(batch.distinct), bool)
    for bucket, bits in zip(flags["bucket"].to_pylist(), flags["flags"].to_pylist(), strict=True):
        size = borders[bucket + 1] - borders[bucket]
        later[borders[bucket] : borders[bucket + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool)
    repeated = batch.flagged(later)
    begin = 0
    for i, words in enumerate(batch.words):
        starts = np.flatnonzero(repeated[begin : batch.ends[i]])
        begin = batch.ends[i]
        yield batch.order[i], words, covered(starts, starts + window, len(words)) if len(starts) else None


def _planned(docs: DataFrame, text_col: str, id_col: str, window: int, finish, schema: str, carry: list[str]) -> DataFrame:
    text_bytes = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    batches, wanted = text_bytes // BATCH_BYTES + 1, (2 * text_bytes // RANGE_BYTES).bit_length()
    bits = min(wanted, FAN_BITS)
    source = docs.select(*carry, id_key(id_col).alias("__key"), F.xxhash64(text_col).alias("__hash"), F.col(text_col).alias("__text"))
    source = source.withColumn("__batch", F.pmod(F.xxhash64("__key", "__hash"), F.lit(batches)))
    dealt = source.repartition(partitions(docs.sparkSession), "__batch")
    flags = _judged(dealt.groupBy("__batch").applyInArrow(_emit(window, bits), _SPLIT), bits, wanted - bits)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return finish(left, _removed(left, right, window, bits))

    return dealt.groupBy("__batch").cogroup(flags.groupBy("unit")).applyInArrow(run, schema)


def substring_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = 20) -> DataFrame:
    """One row per document: the id, n_words, spans (maximal intervals of removed words) and kept_text (null if nothing goes).

    Words are runs of ``[^\\x20\\x09-\\x0D]``. A word goes if a window of ``window`` words that covers it also starts
    earlier: in a document of smaller id, or earlier in the same one; all windows are judged on the input. Null and
    empty texts have no words; texts shorter than a window lose none. A null id counts as smaller than any other; rows
    that share an id are ordered by their texts' hashes. Ids are whole numbers. kept_text has the words that stay, joined by one space.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def finish(table: pa.Table, found) -> pa.Table:
        n = table.num_rows
        sizes, spans, texts = [0] * n, [[]] * n, [None] * n
        for at, words, gone in found:
            sizes[at] = len(words)
            if gone is not None:
                spans[at] = [{"start": int(a), "end": int(b)} for a, b in zip(*runs(gone), strict=True)]
                texts[at] = b" ".join([w for w, g in zip(words, gone, strict=True) if not g]).decode()
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table({"id": table["__id"], "n_words": pa.array(sizes, pa.int64()), "spans": pa.array(spans, span), "kept_text": pa.array(texts, pa.string())})

    return _planned(docs.select(F.col(id_col).alias("__id"), F.col(id_col), F.col(text_col)), text_col, id_col, window, finish, f"id {kind}, n_words long, spans array<struct<start:int,end:int>>, kept_text string", ["__id"]).withColumnRenamed("id", id_col)


def digest(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = 20) -> DataFrame:
    """One row per document: the id, n_words, n_removed, kept_sha256 of the words that stay."""
    kind = docs.schema[id_col].dataType.simpleString()

    def finish(table: pa.Table, found) -> pa.Table:
        n = table.num_rows
        sizes, gone_words, digests = [0] * n, [0] * n, [""] * n
        for at, words, gone in found:
            sizes[at] = len(words)
            if gone is not None:
                gone_words[at] = int(gone.sum())
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            digests[at] = hashlib.sha256(b" ".join(words)).hexdigest()
        return pa.table({"id": table["__id"], "n_words": pa.array(sizes, pa.int64()), "n_removed": pa.array(gone_words, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})

    return _planned(docs.select(F.col(id_col).alias("__id"), F.col(id_col), F.col(text_col)), text_col, id_col, window, finish, f"id {kind}, n_words long, n_removed long, kept_sha256 string", ["__id"]).withColumnRenamed("id", id_col)
