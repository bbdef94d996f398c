"""Ranked lexical search with block-max pruning over a forward index.

The index is a table with one row for each block: a run of consecutive documents, with the block's terms, each with its
greatest occurrence count and the length of the shortest document that holds it, and the documents' own terms and counts
(the forward part). Blocks are made where the documents lie; nothing is shuffled.

A search takes items in blocks of bounded size, which are broadcast. Its steps read only the columns they need:

1. the blocks' terms and document counts give df, N and L, and so the terms' weights;
2. the blocks' maxima give each block's bound for each item; every item names its most promising block;
3. these few blocks are scored for all items, and the tenth score of each item is a threshold for all tasks;
4. every task sorts its blocks by bound for each item, and scores them until the bound falls below the threshold, which
   rises with the task's own results. What it found is merged by a window that keeps few rows of each item and task.

A document's contribution rises with tf and falls with length, so a bound from the greatest tf and the least length never
lies below a score, and pruning loses nothing. Scores are 64-bit integers throughout.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marketlane.llm.common import Scratch, bounded, byte_texts, sliced
from marketlane.llm.tokens import byte_map, numbered

#: Documents and bytes of text in a block at most; a longer text is a block of its own.
BLOCK_DOCS, BLOCK_BYTES = 256, 1 << 20
#: Bytes of item texts that are searched for at once, and packed bytes of blocks that a task holds.
ITEM_BYTES, HELD_BYTES = 4 << 20, 32 << 20
_APART = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_BYTES = byte_map(_APART)
_HEAD = "block long, n_docs long, n_terms long, terms binary, df binary, max_tf binary, min_length binary, lengths binary, sizes binary, posts binary, tfs binary"


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in the fewest bytes that hold the greatest; the first byte tells how many."""
    most = int(values.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _block(texts: list[bytes]) -> dict | None:
    """The index row of some documents, and which of them have terms; None if none has."""
    doc, number, words = numbered([t.translate(_BYTES) for t in texts])
    if not len(doc):
        return None
    lengths = np.bincount(doc, minlength=len(texts))
    held = np.flatnonzero(lengths)
    renumbered = np.cumsum(lengths > 0) - 1
    pairs, tf = np.unique(renumbered[doc] * len(words) + number, return_counts=True)
    at, term = pairs // len(words), pairs % len(words)
    most, least = np.zeros(len(words), np.int64), np.full(len(words), np.iinfo(np.int64).max)
    np.maximum.at(most, term, tf)
    np.minimum.at(least, term, lengths[held][at])
    numbers = {"df": np.bincount(term), "max_tf": most, "min_length": least, "lengths": lengths[held], "sizes": np.bincount(at), "posts": term, "tfs": tf}
    return {"held": held, "n_docs": len(held), "n_terms": int(lengths.sum()), "terms": b" ".join(words.to_pylist()), **{k: packed(v) for k, v in numbers.items()}}


def build_index(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The forward index, a row for each block of documents; documents without terms are in none."""
    bounded(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([*T.StructType.fromDDL(_HEAD).fields, T.StructField("ids", T.ArrayType(id_type))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, ids, texts, size = 0, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            if (found := _block(texts)) is not None:
                found |= {"block": (TaskContext.get().partitionId() << 32) + made, "ids": [ids[k] for k in found["held"].tolist()]}
                made += 1
                yield pa.RecordBatch.from_pylist([{k: found[k] for k in arrow.names}], schema=arrow)

        for b in sliced(batches, 1):
            for key, text in zip(b.column(0).to_pylist(), byte_texts(b.column(1)), strict=True):
                if texts and (len(texts) >= BLOCK_DOCS or size + len(text) > BLOCK_BYTES):
                    yield from flush()
                    ids, texts, size = [], [], 0
                ids.append(key)
                texts.append(text)
                size += len(text)
        yield from flush()

    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, schema)


def _m(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """8 * m of each document length; by Python's integers where 64 bits might not do."""
    if 75 * int(lengths.max(initial=0)) * n_docs < 2**63:
        return 8 * (25 + 75 * lengths * n_docs // n_terms)
    return np.array([8 * (25 + 75 * x * n_docs // n_terms) for x in lengths.tolist()], np.int64)


def _parts(tf: np.ndarray, m8: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + m8)


class Items:
    """Items of a search: their terms, and for each (item, term) the weight times its repeats, in order of item."""

    def __init__(self, texts: list[bytes]) -> None:
        self.n = len(texts)
        counts = [Counter(t.translate(_BYTES).split()) for t in texts]
        self.terms = {t: i for i, t in enumerate(dict.fromkeys(t for c in counts for t in c))}
        self.item = np.repeat(np.arange(self.n), [len(c) for c in counts])
        self.term = np.fromiter((self.terms[t] for c in counts for t in c), np.int64)
        self.weight = np.fromiter((x for c in counts for x in c.values()), np.int64)
        self.ends = np.searchsorted(self.item, np.arange(self.n + 1))

    def weigh(self, df: np.ndarray, n_docs: int, n_terms: int) -> None:
        w = np.fromiter((math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()), np.int64, len(df))
        self.weight, self.n_docs, self.n_terms = self.weight * w[self.term], n_docs, n_terms

    def known(self, terms: bytes) -> np.ndarray:
        """The number among the items' terms of each term of a block, or -1."""
        get = self.terms.get
        return np.fromiter((get(t, -1) for t in terms.split(b" ")), np.int64)

    def bounds(self, known: np.ndarray, max_tf: bytes, min_length: bytes) -> np.ndarray:
        """What a document of a block can score at most, for each item."""
        here = np.flatnonzero(known >= 0)
        part = np.zeros(len(self.terms), np.int64)
        part[known[here]] = _parts(unpacked(max_tf)[here], _m(unpacked(min_length)[here], self.n_docs, self.n_terms))
        sums = np.append(0, np.cumsum(self.weight * part[self.term]))
        return sums[self.ends[1:]] - sums[self.ends[:-1]]


class Block:
    """A block that is scored: the postings of the items' terms, turned so that those of a term stand together."""

    def __init__(self, items: Items, row: dict) -> None:
        self.items, self.ids, self.known = items, row["ids"], items.known(row["terms"])
        sizes = unpacked(row["sizes"])
        term = self.known[unpacked(row["posts"])]
        m8 = np.repeat(_m(unpacked(row["lengths"]), items.n_docs, items.n_terms), sizes)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        here = np.flatnonzero(term >= 0)
        here = here[np.argsort(term[here], kind="stable")]
        self.doc, self.part = doc[here], _parts(unpacked(row["tfs"])[here], m8[here])
        self.starts = np.searchsorted(term[here], np.arange(len(items.terms) + 1))

    def scores(self, item: int) -> np.ndarray:
        own = slice(self.items.ends[item], self.items.ends[item + 1])
        term = self.items.term[own]
        begin, size = self.starts[term], self.starts[term + 1] - self.starts[term]
        at = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
        out = np.zeros(len(self.ids), np.int64)
        np.add.at(out, self.doc[at], self.part[at] * np.repeat(self.items.weight[own], size))
        return out


def _order(hit: tuple[int, object]) -> tuple:
    score, key = hit
    return (-score, key is not None, key)


class Best:
    """The best documents of each item so far; those below the item's threshold are none."""

    def __init__(self, n: int, top: int, least: np.ndarray | None = None) -> None:
        self.top, self.hits = top, [[] for _ in range(n)]
        self.least = np.ones(n, np.int64) if least is None else least.copy()

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        found = np.flatnonzero(scores >= self.least[item])
        if not len(found):
            return
        if len(found) > self.top:  # ties of the last one stay, as ids decide among them
            found = found[scores[found] >= np.partition(scores[found], -self.top)[-self.top]]
        hits = self.hits[item] + [(s, ids[k]) for s, k in zip(scores[found].tolist(), found.tolist(), strict=True)]
        hits.sort(key=_order)
        self.hits[item] = hits[: self.top]
        if len(hits) >= self.top:
            self.least[item] = max(self.least[item], hits[self.top - 1][0])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _search(index: DataFrame, items: Items, top: int) -> DataFrame:
    """Rows (item, score, id): the ``top`` documents of each item in each task, where they may be of the ``top`` of all."""
    spark = index.sparkSession
    id_type = index.schema["ids"].dataType.elementType
    sums = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    hit = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("score", T.LongType()), T.StructField("id", id_type)])
    if not sums[0] or not items.terms:
        return spark.createDataFrame([], hit)
    plain = spark.sparkContext.broadcast(items)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(plain.value.terms), np.int64)
        for r in _rows(batches):
            known = plain.value.known(r["terms"])
            here = known >= 0
            df[known[here]] += unpacked(r["df"])[here]
        seen = np.flatnonzero(df)
        yield pa.record_batch({"term": pa.array(seen, pa.int64()), "df": pa.array(df[seen], pa.int64())})

    found = index.select("terms", "df").mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(len(items.terms), np.int64)
    for term, n in found:
        df[term] = n
    items.weigh(df, sums[0], sums[1])
    shared = spark.sparkContext.broadcast(items)

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most, where = np.zeros(shared.value.n, np.int64), np.zeros(shared.value.n, np.int64)
        for r in _rows(batches):
            bound = shared.value.bounds(shared.value.known(r["terms"]), r["max_tf"], r["min_length"])
            better = bound > most
            most[better], where[better] = bound[better], r["block"]
        some = np.flatnonzero(most)
        yield pa.record_batch({"item": pa.array(some.astype(np.int32)), "bound": pa.array(most[some]), "block": pa.array(where[some])})

    bounds = index.select("block", "terms", "max_tf", "min_length").mapInArrow(promising, "item int, bound long, block long")
    first = bounds.groupBy("item").agg(F.max(F.struct("bound", "block")).alias("best")).select("best.block").distinct()

    def scored(least=None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            best = Best(items.n, top, least and least.value)

            def work(held: list[dict]) -> None:
                bound = np.array([items.bounds(items.known(r["terms"]), r["max_tf"], r["min_length"]) for r in held])
                blocks: list[Block | None] = [None] * len(held)
                for item in range(items.n):
                    for k in np.argsort(-bound[:, item], kind="stable").tolist():
                        if bound[k, item] < best.least[item]:
                            break
                        blocks[k] = blocks[k] or Block(items, held[k])
                        best.add(item, blocks[k].scores(item), blocks[k].ids)

            held, size = [], 0
            for r in _rows(batches):
                held.append(r)
                size += sum(len(r[c]) for c in ("terms", "posts", "tfs"))
                if size >= HELD_BYTES:
                    work(held)
                    held, size = [], 0
            if held:
                work(held)
            flat = [(i, s, key) for i, hits in enumerate(best.hits) for s, key in hits]
            yield pa.RecordBatch.from_pylist([dict(zip(("item", "score", "id"), x, strict=True)) for x in flat], schema=to_arrow_schema(hit))

        return run

    # One block for each item at most, and so their ids: what is collected is bounded by the items.
    names = [r.block for r in first.collect()]
    seeds = index.filter(F.col("block").isin(names)).mapInArrow(scored(), hit)
    nth = seeds.withColumn("nth", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).filter(F.col("nth") == top)
    least = np.ones(items.n, np.int64)
    for r in nth.collect():
        least[r.item] = r.score
    return index.mapInArrow(scored(spark.sparkContext.broadcast(least)), hit)


def _item_blocks(items: DataFrame, text_col: str, item_col: str) -> Iterator[tuple[list, list[bytes]]]:
    keys, texts, size = [], [], 0
    for key, text in items.select(item_col, text_col).toLocalIterator():
        data = (text or "").encode()
        if keys and size + len(data) > ITEM_BYTES:
            yield keys, texts
            keys, texts, size = [], [], 0
        keys.append(key)
        texts.append(data)
        size += len(data) + 64
    if keys:
        yield keys, texts


def search(index: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", top: int = 10) -> DataFrame:
    """The ``top`` documents of each row of ``items``: its id, rank (from 1), the document's id, score.

    Terms are the runs of ASCII letters and digits and of all other characters, A-Z lower-cased; repeats in an item count.
    Only scores above 0 are listed; equal ones go by ascending id, null first. Null and empty items have no terms and no
    documents; rows of ``items`` that share an id are items of their own, as are documents that repeat.
    """
    spark = index.sparkSession
    scratch = Scratch(spark, "ranked-search")
    item_type = items.schema[item_col].dataType
    id_type = index.schema["ids"].dataType.elementType
    out = None
    for keys, texts in _item_blocks(items, text_col, item_col):
        hits = _search(index, Items(texts), top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("id"))
        ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(keys)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("key", item_type)]))
        # At most ITEM_BYTES / 64 names.
        part = ranked.join(F.broadcast(names), "item").select(F.col("key").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        part = scratch.write(part)
        out = part if out is None else out.unionByName(part)
    if out is None:
        fields = [T.StructField(item_col, item_type), T.StructField("rank", T.IntegerType()), T.StructField(id_col, id_type), T.StructField("score", T.LongType())]
        return spark.createDataFrame([], T.StructType(fields))
    return out


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", top: int = 10) -> DataFrame:
    """``search`` over an index of ``docs`` that is made, written to the shared folder and deleted again. Other columns are not read."""
    scratch = Scratch(docs.sparkSession, "search-index")
    index = scratch.write(build_index(docs, text_col, id_col))
    out = search(index, items, id_col, text_col, item_col, top)
    scratch.drop(index)
    return out


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH docs AS (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, {_WORDS} AS w FROM documents) AS x WHERE len(w) > 0),
whole AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM docs),
asked AS (SELECT item_id, t, count(*) AS qtf FROM (SELECT item_id, unnest({_WORDS}) AS t FROM benchmark) AS x GROUP BY item_id, t),
held AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM docs) AS x WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, n, t),
df AS (SELECT t, count(*) AS df FROM held GROUP BY t),
weights AS (SELECT a.item_id, a.t, a.qtf, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM asked AS a JOIN df ON a.t = df.t, whole),
scores AS (
  SELECT w.item_id, h.doc_id, sum(w.qtf * w.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (25 + (75 * h.n * n_docs) // n_terms)))) AS score
  FROM weights AS w JOIN held AS h ON w.t = h.t, whole GROUP BY w.item_id, h.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""
