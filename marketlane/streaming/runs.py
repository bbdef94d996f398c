"""Running a stream over what is there now, with results as a table in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlane.sources.sinks import new_path, removed


def file_stream(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    """A parquet folder or file as a stream, by a pattern that only it fits: a plain path would have to be a folder."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{path[:-1]}[{path[-1]}]")


def drained(stream: DataFrame, mode: str, name: str, checkpoint: str | None = None, out: str | None = None) -> DataFrame:
    """All rows that the stream emits for the files there are, with their batch number; restarts go on from ``checkpoint``.

    Each batch overwrites its own folder, so a batch that is repeated after a failure is not doubled.
    """
    spark = stream.sparkSession
    base = new_path(spark, name)
    out = out or f"{base}/out"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint or f"{base}/state").trigger(availableNow=True).foreachBatch(write).start()
    run.awaitTermination()
    return spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(out)


def latest_per_key(emitted: DataFrame, key: str) -> DataFrame:
    """The last update of each key."""
    rest = [c for c in emitted.columns if c not in (key, "batch")]
    return emitted.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(key, "r.*")


def span(spark: SparkSession, path: str, time: str) -> str:
    """An interval that no row of the table can be late by, in whatever order its files are read."""
    first, last = spark.read.parquet(path).agg(*(F.unix_seconds(f(F.col(time).cast("timestamp"))) for f in (F.min, F.max))).first()
    return f"{(last or 0) - (first or 0) + 1} seconds"


def scattered(rows: DataFrame, key: str, path: str, batches: int = 3) -> tuple[str, int]:
    """Writes ``rows`` as files by hash, for a stream of so many batches; returns their folder and the files of one batch.

    A batch is as many files as a shuffle has partitions, so that one is no single task's.
    """
    files = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(batches * files, key).write.parquet(path)
    # Partitions without rows write no file; a batch is a third of those there are.
    return path, max(1, -(-len(rows.sparkSession.read.parquet(path).inputFiles()) // batches))


def versioned(stream: DataFrame, step: Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]], base: str, state: str, prepared: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All rows that ``step`` gives, batch by batch: it gets a batch and the state table, and returns rows and the next state.

    ``state`` is the table's schema; ``step`` gets what ``prepared`` makes of a batch, once. Each batch writes its rows and its version of the table to folders of its own, built on
    the version before, so one that is repeated after a failure changes nothing; the newest two versions stay in ``base``.
    """
    spark = stream.sparkSession
    version = lambda n: f"{base}/v{n}"

    def write(batch: DataFrame, number: int) -> None:
        batch = (prepared(batch) if prepared else batch).persist()
        out, after = step(batch, spark.read.schema(state).parquet(version(number - 1)) if number else None)
        after.write.mode("overwrite").parquet(version(number))
        out.write.mode("overwrite").parquet(f"{base}/out/batch={number}")
        batch.unpersist()
        if number > 1:
            removed(spark, version(number - 2))

    stream.writeStream.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


def table_after(stream: DataFrame, step: Callable[[DataFrame, DataFrame | None], DataFrame], name: str, state: str) -> DataFrame:
    """The state table after all batches: ``step`` gets a batch and the table before it, none at first, and returns the next one.

    ``state`` is the table's schema. A batch writes a version of the table, built on the one before; the newest two stay.
    """
    spark = stream.sparkSession
    base = new_path(spark, name)
    version = lambda n: f"{base}/v{n}"

    def write(batch: DataFrame, number: int) -> None:
        step(batch, spark.read.schema(state).parquet(version(number - 1)) if number else None).write.mode("overwrite").parquet(version(number))
        if number > 1:
            removed(spark, version(number - 2))

    stream.writeStream.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    last = latest_batch(spark, f"{base}/state")
    return spark.createDataFrame([], state) if last is None else spark.read.schema(state).parquet(version(last))


def merged(stream: DataFrame, keys: list[str], order: str, name: str, keep: tuple[str, ...] = (), fill: tuple[str, ...] = (), base: str | None = None) -> DataFrame:
    """The table after merging every batch by key; one version per batch, of which the newest two stay.

    The row of the greatest ``order`` counts, in whatever batch it comes; of equal ones, that of the later batch. Columns
    in ``keep`` have their first non-null value by ``order``, those in ``fill`` their last. With ``base``, a folder of
    earlier runs, the stream goes on from there: a batch builds on the version of the batch before it.
    """
    spark = stream.sparkSession
    base = base or new_path(spark, name)
    rest = [c for c in stream.columns if c not in (*keys, *keep, *fill)]
    version = lambda n: f"{base}/v{n}"

    def write(batch: DataFrame, number: int) -> None:
        at = F.when(F.col(order).isNotNull(), F.struct(F.col(order).alias("order"), F.lit(number).cast("long").alias("batch")))
        held = lambda c: F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("v"))).alias(f"__{c}")
        rows = batch.select(*keys, at.alias("__at"), F.struct(*rest).alias("__row"), *map(held, (*keep, *fill)))
        if number:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(version(number - 1)))
        picked = [F.max_by("__row", "__at").alias("__row"), *(f(f"__{c}", F.col(f"__{c}.at")).alias(f"__{c}") for f, cs in ((F.min_by, keep), (F.max_by, fill)) for c in cs)]
        rows.groupBy(*keys).agg(F.max("__at").alias("__at"), *picked).write.mode("overwrite").parquet(version(number))
        if number > 1:
            removed(spark, version(number - 2))

    run = stream.writeStream.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(write).start()
    run.awaitTermination()
    last = latest_batch(spark, f"{base}/state")
    if last is None:
        return spark.createDataFrame([], stream.schema)
    shown = lambda c: c if c in keys else F.col(f"__{c}.v").alias(c) if c in (*keep, *fill) else F.col(f"__row.{c}").alias(c)
    return spark.read.parquet(version(last)).select(*map(shown, stream.columns))


def latest_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The number of the last batch that a stream has completed, by its checkpoint's log of commits."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
    return max((int(n) for n in done if n.isdigit()), default=None)
