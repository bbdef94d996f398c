"""Writers: merges as a rebuilt table, partitions that are replaced, and text exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of the warehouse where it is unset and Spark runs in one process.

    On a cluster it has to be set: the warehouse's default is a local folder of each machine.
    """
    own = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if own:
        return own.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet; what is written there goes when the session's process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    files, at = _file_system(spark, path)
    files.mkdirs(at)
    files.deleteOnExit(at)
    return path


def removed(spark: SparkSession, path: str) -> None:
    files, at = _file_system(spark, path)
    files.delete(at, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: what reads it several times scans its sources once."""
    path = f"{new_path(df.sparkSession, name)}/table"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` made, as soon as nothing reads them any more."""
    for t in tables:
        if (path := getattr(t, "_stored_path", None)) is not None:
            removed(t.sparkSession, path.rsplit("/", 1)[0])


def overwrite(df: DataFrame, path: str, partition: str | None = None) -> None:
    """With a partition column only the partitions that ``df`` has are replaced."""
    writer = df.write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def json_lines(df: DataFrame, path: str) -> None:
    """Adds one JSON text a row to the log at ``path``; what is there stays."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)


def json_export(df: DataFrame, path: str, name: str | None = None, group: int = 10_000) -> None:
    """JSON arrays of up to ``group`` rows, one a line; with ``name``, scripts that add each to a list of that name.

    ``window.name = (window.name || []).concat([...]);`` loads as a script, in as many pieces as there are lines, so
    the whole table never has to be one text.
    """
    texts = df.select(F.to_json(F.struct("*")).alias("row")).withColumn("n", F.monotonically_increasing_id())
    lists = texts.groupBy(F.spark_partition_id().alias("part"), F.expr(f"(n & ((1L << 33) - 1)) div {group}").alias("group"))
    joined = lists.agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "row"))), lambda x: x["row"]).alias("rows"))
    array = F.concat(F.lit("["), F.array_join("rows", ","), F.lit("]"))
    text = array if name is None else F.concat(F.lit(f"window.{name} = (window.{name} || []).concat("), array, F.lit(");"))
    joined.orderBy("part", "group").select(text.alias("value")).write.mode("overwrite").text(path)


def composite_save(parts: dict[str, DataFrame], base: str, number: int) -> None:
    """One batch of several tables, which readers see together or not at all.

    Each table's rows go to a folder of the batch, and a manifest with the batch's number comes last. A batch that is
    repeated, whole or after a failure between two tables, replaces its folders and is no double.
    """
    spark = next(iter(parts.values())).sparkSession
    for name, df in parts.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}/batch={number}")
    manifest = spark.createDataFrame([(number, sorted(parts))], "batch long, tables array<string>")
    manifest.coalesce(1).write.mode("overwrite").json(f"{base}/manifest/{number}")


def composite_batches(spark: SparkSession, base: str) -> list[int]:
    """The numbers of the batches that are whole."""
    files, at = _file_system(spark, f"{base}/manifest")
    if not files.exists(at):
        return []
    done = lambda f: files.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))
    return sorted(int(f.getPath().getName()) for f in files.listStatus(at) if done(f))


def composite_read(spark: SparkSession, base: str, name: str, schema: str) -> DataFrame:
    """A table's rows of all whole batches, with their batch number."""
    batches = composite_batches(spark, base)
    if not batches:
        return spark.createDataFrame([], f"{schema}, batch long")
    paths = [f"{base}/{name}/batch={n}" for n in batches]
    return spark.read.schema(f"{schema}, batch long").option("basePath", f"{base}/{name}").parquet(*paths)


def csv_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def edited(df: DataFrame, changes: DataFrame, key: str, allowed: list[str]) -> DataFrame:
    """``df`` after cell edits (key, column, value): only columns in ``allowed``, an empty value becomes null."""
    cells = changes.filter(F.col("column").isin(allowed)).groupBy(key, "column").agg(F.max("value").alias("value"))
    edits = cells.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("__edits"))
    joined = df.join(edits, key, "left")

    def cell(c: str) -> F.Column:
        new = F.nullif(F.trim(F.try_element_at("__edits", F.lit(c))), F.lit("")).try_cast(df.schema[c].dataType)
        return F.when(F.coalesce(F.map_contains_key("__edits", c), F.lit(False)), new).otherwise(F.col(c)).alias(c) if c in allowed else F.col(c)

    return joined.select(*map(cell, df.columns))
