"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs; all but the last return the columns of ``documents``, with n_chars that fits the text. Nulls, empty texts,
repeated rows and extra columns are treated as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane.llm import decontaminate, line_dedup, near_dup, quality_classifier, sentencepiece_codec
from marketlane.llm.common import table, written


def _measured(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*(F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay whose highest grade is as likely as the model's cut asks, and likelier than not."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.classify(docs, model).filter("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line windows go; so do documents of which nothing but blanks is left, if they lost lines."""
    found = line_dedup.line_dedup(docs)
    return _measured(found.filter((F.col("n_removed_lines") == 0) | F.col("text").rlike(r"\S")), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id.

    Rows that share the id are that document, so all of them stay, as do rows without an id in a group that has one.
    """
    kept = near_dup.near_dup(docs).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out of the texts, in the pass that finds them."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), cut=True)
    return _measured(found, docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, decoded again to prove them: doc_id, lang, source, ids, n_tokens, round_trip."""
    return sentencepiece_codec.encode(docs).select("doc_id", "lang", "source", "ids", "n_tokens", "round_trip")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
