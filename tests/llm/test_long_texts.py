"""Texts above a slice of 2 MB, beside short ones: where batches of one row begin. Against the plain-Python versions."""

import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import brute  # noqa: E402

from marketlane.llm import common, decontaminate, line_dedup, near_dup, quality_classifier, quality_rules, sentencepiece_codec, substring_dedup, warc  # noqa: E402


@pytest.fixture(scope="module")
def pairs():
    r = random.Random(8)
    stock = [f"word{k}" for k in range(40_000)]
    say = lambda n: " ".join(r.choices(stock, k=n))
    passage = say(60)
    long = say(150_000) + "\n" + passage + "\n" + say(150_000)
    assert len(long) > 1.2 * common.SLICE_BYTES
    near = long.replace("word7 ", "other7 ")
    return [(1, "short " + passage), (2, long), (3, near), (4, None), (5, say(30)), (6, passage + " " + say(5)), (7, "same line\n" * 300_000)]


@pytest.fixture(scope="module")
def docs(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, text string").coalesce(2)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(got, want):
    assert got == sorted(want, key=repr)


def test_decontaminate(spark, docs, pairs):
    items = [(1, " ".join(pairs[0][1].split()[1:30])), (2, "no such words anywhere")]
    found = decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    same(rows(decontaminate.digest(found), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"), brute.op1(pairs, items))


def test_substring_dedup(docs, pairs):
    same(rows(substring_dedup.digest(docs), "doc_id", "n_words", "n_removed", "kept_sha256"), brute.op2(pairs))


def test_sentencepiece(docs, pairs):
    got = {r.doc_id: r for r in sentencepiece_codec.encode(docs).select("doc_id", "n_tokens", "round_trip").collect()}
    v = sentencepiece_codec.Vocabulary.of(sentencepiece_codec.read_model(None, sentencepiece_codec.DEFAULT_MODEL))
    assert all(r.round_trip for r in got.values()) and got[2].n_tokens > 500_000
    # A whole text by one stream that remembers nothing.
    stream, marked = sentencepiece_codec.Stream(v), sentencepiece_codec.MARK + pairs[1][1].replace(" ", sentencepiece_codec.MARK)
    assert len(stream.feed(marked)) + len(stream.finish()) == got[2].n_tokens and stream.widest < 300


def test_warc(spark, pairs):
    pages = [(i, f"https://example.com/{i}", t) for i, t in pairs] + [(9, "https://example.com/9", pairs[1][1])]
    index = warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"))
    same(rows(warc.digest(index), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), brute.op4([(i, t) for i, _, t in pages]))


def test_line_dedup(docs, pairs):
    same(rows(line_dedup.digest(line_dedup.line_dedup(docs)), "doc_id", "n_lines", "n_removed_lines", "kept_sha256"), brute.op5(pairs))


def test_near_dup(docs, pairs):
    found = near_dup.near_dup(docs, shingle=2)
    same(rows(found, "doc_id", "n_shingles", "component_id", "kept"), brute.op7(pairs))
    assert {r.doc_id: r.component_id for r in found.collect()}[3] == 2


def test_quality_rules(docs, pairs):
    found = quality_rules.quality_rules(docs)
    same(rows(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), brute.op10(pairs))


def test_quality_classifier(spark, docs):
    """A long text may be labelled, and is scored like any other."""
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 0), (5, 0, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    judged = quality_classifier.classify(docs, quality_classifier.fit(docs, labels))
    assert judged.count() == docs.count() and judged.filter(F.col("kept").isNull()).count() == 0
