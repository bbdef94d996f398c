"""Readers of the file shapes that dictionaries, reports and exports come in, with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_table(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A CSV with a header, by name; a byte order mark before the first name doesn't matter."""
    names = [f.name for f in T._parse_datatype_string(schema).fields]
    raw = spark.read.option("header", True).option("sep", sep).option("enforceSchema", True).csv(path)
    raw = raw.toDF(*(c.lstrip("﻿").strip() for c in raw.columns))
    kinds = {f.name: f.dataType for f in T._parse_datatype_string(schema).fields}
    return raw.select(*(F.col(n).try_cast(kinds[n]).alias(n) for n in names))


def keyed_lists(spark: SparkSession, path: str, key: int, value: int) -> DataFrame:
    """key, values of a positional CSV: rows whose key is a number, distinct values in the order of their first appearance."""
    raw = spark.read.option("header", False).csv(path)
    # Rows of a file's block come one after another, so their numbers rise within it.
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    rows = raw.select(F.col(f"_c{key}").alias("key"), F.col(f"_c{value}").alias("value"), place.alias("place")).filter(F.col("key").rlike("^[0-9]+$"))
    firsts = rows.groupBy(F.col("key").cast("long").alias("key"), "value").agg(F.min("place").alias("place"))
    return firsts.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("values"))


def urls(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("url")).filter(F.col("url").startswith("http"))


def items_of(spark: SparkSession, path: str, item: str, lines: bool = False) -> DataFrame:
    """The rows of JSON documents ``{collected_at, items: [...]}``, one a file or one a line; ``item`` is the schema of one."""
    doc = spark.read.schema(f"collected_at string, items array<struct<{item}>>").option("multiLine", not lines).json(path)
    return doc.select("collected_at", F.explode("items").alias("i")).select("collected_at", "i.*")


def jdbc(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A database table in ``parts`` ranges of a numeric column; all connection settings come from the caller."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts), **options).load()


def newest(spark: SparkSession, table: str, order: str, n: int = 100) -> DataFrame:
    """A table browser's page: the newest rows, or any rows if the order column doesn't exist."""
    df = spark.table(table)
    return (df.orderBy(F.desc(order)) if order in df.columns else df).limit(n)
