"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Keys that stand in for a null id; they sort before every real one.
NULL_ID = -(2**63)
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_CACHE_WORDS = 150_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a folder of the warehouse where it is unset and Spark runs in one process."""
    own = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if own:
        return own.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


class Scratch:
    """Tables of one call in a folder of their own below the shared one.

    Readers of a table survive the loss of executors and repeat no work. The shuffle files of a write go with its end,
    and a table goes as soon as nothing reads it any more (``drop``).
    """

    _CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.folder, self.count = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def write(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        before = self.spark.conf.get(self._CLEANUP, None)
        self.spark.conf.set(self._CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(self._CLEANUP)
            else:
                self.spark.conf.set(self._CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Deletes tables that ``write`` made."""
        for t in tables:
            if (path := getattr(t, "_scratch_path", None)) is not None:
                at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: later readers survive the loss of executors and repeat no work."""
    return Scratch(df.sparkSession, name).write(df)


#: Bytes of text that a Python worker takes at once, but for a single longer text.
SLICE_BYTES = 2 << 20


def bounded(spark: SparkSession) -> None:
    """Batches that go to Python have ``2 * SLICE_BYTES`` at most, or one row."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{2 * SLICE_BYTES}b")


def sliced(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``SLICE_BYTES`` of that column at most, or of one row; nothing is copied."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1).tolist(), b.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield b.slice(start, end - start)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_key(column: str) -> F.Column:
    """A document's id, a whole number, as a never-null key; null ids stand together before all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns of ``df`` that don't clash with ``names`` (Spark's names ignore case)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def add_columns(df: DataFrame, inputs: Sequence[str], new: T.StructType, work: Callable[[Iterator[dict[str, pa.Array]]], Iterator[dict[str, pa.Array]]]) -> DataFrame:
    """``df`` with the columns ``new``, which replace columns of the same names; computed from batches of ``inputs``.

    ``work`` gets an iterator of ``{input: array}`` and yields ``{new column: array}`` for each in turn. Rows stay in
    their partitions: nothing is shuffled. Batches are cut by the bytes of the first text among ``inputs``.
    """
    kept = without(df, new.names)
    extra = [c for c in inputs if c not in kept]
    source = df.select(*kept, *(F.col(c).alias(f"__in_{c}") for c in extra))
    schema = T.StructType([*source.select(*kept).schema.fields, *new.fields])
    arrow = to_arrow_schema(schema)
    place = {c: (f"__in_{c}" if c in extra else c) for c in inputs}
    made = [(n, arrow.field(n).type) for n in new.names]
    widest = next((source.columns.index(place[c]) for c in inputs if dict(source.dtypes)[place[c]] in ("string", "binary")), None)
    bounded(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def feed() -> Iterator[dict[str, pa.Array]]:
            for b in batches if widest is None else sliced(batches, widest):
                held.append(b)
                yield {c: b.column(b.schema.get_field_index(at)) for c, at in place.items()}

        for out in work(feed()):
            b = held.pop(0)
            columns = [b.column(b.schema.get_field_index(c)) for c in kept]
            columns += [out[n] if isinstance(out[n], pa.Array) and out[n].type == kind else pa.array(out[n], kind) for n, kind in made]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *(n for n, _ in made)])

    return source.mapInArrow(run, schema)


class WordHashes:
    """64-bit hashes of words (bytes), remembered in a dictionary of bounded size."""

    def __init__(self, seed: int = 0) -> None:
        import xxhash

        self.hash, self.seed, self.known = xxhash.xxh3_64_intdigest, seed, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > _CACHE_WORDS:
                known.clear()
            for w in set(words).difference(known):
                known[w] = self.hash(w, self.seed)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64-bit values (public splitmix64 constants)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: An odd multiplier of the rolling hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Rabin-Karp hashes, modulo 2**64, of windows over a sequence of word hashes; powers are kept between calls."""

    def __init__(self) -> None:
        self.up, self.down = _powers(BASE, 1), _powers(BASE_INVERSE, 1)

    def prefix(self, words: np.ndarray) -> np.ndarray:
        n = len(words)
        if n >= len(self.up):
            size = max(2 * len(self.up), n + 1)
            self.up, self.down = _powers(BASE, size), _powers(BASE_INVERSE, size)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(words * self.up[:n], out=out[1:])
        return out

    def windows(self, prefix: np.ndarray, length: int) -> np.ndarray:
        """Hash of each window of ``length`` words, by its start."""
        n = len(prefix) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((prefix[length:] - prefix[:n]) * self.down[:n])


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in any of the intervals."""
    change = np.bincount(starts, minlength=n + 1)[: n + 1].astype(np.int64)
    change -= np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(change)[:n] > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edges = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


ASCII_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
