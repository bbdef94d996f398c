"""Sharding by proportional, stratified interleaving, in DataFrame functions only.

The rows of each source are shuffled by a seeded digest; a row's fractional rank is its place among them over their
number. Sorted by fractional rank, every stretch of the order has the mixture of the whole, so equal cuts of it are shards
that do. A source's ranks are moved by a seeded part of one step, so that many small sources don't all meet at one half.

Neither of the two orders is made in one task. Rows fall into buckets of about ``ROWS_PER_BUCKET`` by the leading digits of
the digest, later by fractional rank; a bucket numbers its own rows, and the counts of the buckets give each its start. Rows
that are alike in all columns become one with its number of copies before anything is shuffled, and part again as ranks
are given out, so however often a row repeats, no bucket grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlane.llm.common import Scratch, without

ROWS_PER_BUCKET = 2048
_COPIES = 4096
NEW = ("law", "shard", "slot", "grown_shard")


def _digits(text: F.Column, n: int) -> F.Column:
    """The leading ``n`` hexadecimal digits of a digest as a number."""
    return F.conv(F.substring(text, 1, n), 16, 10).cast("long")


def _starts(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """``counts`` (by, __bucket, __c) with the rows before each bucket, over blocks of 1024 buckets and the blocks' sums."""
    blocks = counts.withColumn("__block", F.expr("__bucket div 1024"))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    inner = blocks.withColumn("__inner", F.coalesce(F.sum("__c").over(before(*by, "__block").orderBy("__bucket")), F.lit(0)))
    sums = blocks.groupBy(*by, "__block").agg(F.sum("__c").alias("__c"))
    sums = sums.select(*by, "__block", F.coalesce(F.sum("__c").over(before(*by).orderBy("__block")), F.lit(0)).alias("__outer"))
    return inner.join(sums, [*by, "__block"]).select(*by, "__bucket", (F.col("__inner") + F.col("__outer")).alias("__start"))


def _ranked(rows: DataFrame, source_col: str, seed: int, buckets: int) -> DataFrame:
    """A row for each of ``rows``: its columns, __source and its fractional rank, __at; and __rank, which parts equal ones."""
    columns = rows.columns
    text = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *(text(c) for c in columns)))
    keyed = rows.withColumn("__source", text(source_col)).withColumn("__digest", digest)
    copies = keyed.groupBy(*columns, "__source", "__digest").agg(F.count("*").alias("__copies"))
    copies = copies.withColumn("__bucket", F.shiftright(_digits(F.col("__digest"), 8) * buckets, 32))
    counts = copies.groupBy("__source", "__bucket").agg(F.sum("__copies").alias("__c"))
    totals = counts.groupBy("__source").agg(F.sum("__c").alias("__total"))
    starts = _starts(counts, ["__source"]).join(totals, "__source")
    order = Window.partitionBy("__source", "__bucket").orderBy("__digest")
    before = F.coalesce(F.sum("__copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = copies.join(starts, ["__source", "__bucket"]).withColumn("__first", F.col("__start") + before)
    # Copies in chunks, so that no array is longer than a chunk.
    chunk = placed.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__copies - 1) div {_COPIES}"))))
    copy = F.explode(F.sequence(F.col("__chunk") * _COPIES, F.least(F.col("__copies"), (F.col("__chunk") + 1) * _COPIES) - 1))
    one = chunk.withColumn("__copy", copy).withColumn("__rank", F.col("__first") + F.col("__copy"))
    part = (_digits(F.md5(F.concat_ws("|", F.lit(str(seed)), "__source")), 4) + 0.5) / 65536
    return one.select(*columns, "__source", "__rank", ((F.col("__rank") + part) / F.col("__total")).alias("__at"))


def interleaved(rows: DataFrame, shards: int = 40, source_col: str = "source", seed: int = 42) -> DataFrame:
    """``rows`` with law (``rows``), shard (from 0), slot (from 0, gapless in each shard) and grown_shard (null: no keyed law).

    Shards' sizes differ by one row at most. Each shard has of each source its share of the whole, but for two rows or so
    where sources are few; of many that have fewer rows than there are shards, it has about its share by chance. Rows
    without a source are a source of their own. The shuffle goes by a digest of all columns, so many rows of one id, or of
    none, fall apart as others do; rows alike in all columns are interchangeable, and each gets a slot of its own. With
    fewer rows than shards some stay empty. New columns replace those of the same names.
    """
    rows = rows.select(*without(rows, NEW))
    n = rows.count()
    buckets = n // ROWS_PER_BUCKET + 1
    ranked = Scratch(rows.sparkSession, "sharding").write(_ranked(rows, source_col, seed, buckets))
    ranked = ranked.withColumn("__bucket", F.least(F.floor(F.col("__at") * buckets), F.lit(buckets - 1)))
    starts = _starts(ranked.groupBy("__bucket").agg(F.count("*").alias("__c")), [])
    order = Window.partitionBy("__bucket").orderBy("__at", "__source", "__rank")
    at = ranked.join(starts, "__bucket").withColumn("__place", F.col("__start") + F.row_number().over(order) - 1)
    at = at.withColumn("shard", F.expr(f"(__place * {shards}) div {max(n, 1)}"))
    return at.select(
        *rows.columns,
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.expr(f"__place - (shard * {n} + {shards - 1}) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(rows: DataFrame, path: str, shards: int = 40, source_col: str = "source", seed: int = 42) -> None:
    """All columns of ``rows`` as Parquet files below ``path/shard=<n>``, each file in order of slot.

    Whole rows move as narrow ones do. A bucket of the order lies in one shard or two, so the files need no further shuffle.
    """
    out = interleaved(rows, shards, source_col, seed).drop("law", "grown_shard")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digest(docs: DataFrame, shards: int = 40, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", seed: int = 42) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard. Texts are measured as they are read and don't move.

    A null text has no bytes, and so the check sum of none, 0.
    """
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 16
    narrow = docs.select(id_col, F.col(source_col).alias("__stratum"), size.alias("size"), F.crc32(F.coalesce(F.encode(text_col, "UTF-8"), F.lit(b""))).alias("text_crc32"))
    return interleaved(narrow, shards, "__stratum", seed).drop("__stratum")


# The check sum byte by byte, with the table of the reversed polynomial 0xEDB88320.
SQL = """
WITH RECURSIVE bits(i, k, v) AS (
  SELECT CAST(i AS BIGINT), 0, CAST(i AS BIGINT) FROM range(256) AS t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
steps AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
sums AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 AS size,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda h: CAST('0x' || h AS BIGINT))),
                         lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS BIGINT)])), 4294967295) AS text_crc32
  FROM documents, steps),
keyed AS (SELECT *, coalesce('=' || source, '') AS s, md5('42|' || coalesce('=' || doc_id, '') || '|' || coalesce('=' || source, '') || '|=' || size || '|=' || text_crc32) AS h FROM sums),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY h) - 1 AS r, count(*) OVER (PARTITION BY s) AS n,
         (CAST('0x' || substr(md5('42|' || s), 1, 4) AS BIGINT) + CAST(0.5 AS DOUBLE)) / 65536 AS part
  FROM keyed),
placed AS (SELECT *, row_number() OVER (ORDER BY (r + part) / n, s, r) - 1 AS place, count(*) OVER () AS total FROM ranked)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(place * 40 // total AS INTEGER) AS shard,
       CAST(place - ((place * 40 // total) * total + 39) // 40 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""
