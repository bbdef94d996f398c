"""WARC records in seekable Zstandard files.

An archive is a ``.warc.zst`` file: independent frames that each hold some records, then the seek table of the public
seekable format, so any frame can be read without the others, and any Zstandard tool can read the whole. Tasks write
archives to a folder all executors share, each under a name of its own attempt, and rename them when they are whole. An
index table maps record identifiers to the archive, the frame and the offset within it; only what it names is part of
the bundle, so a lost or repeated task leaves at most a file that nothing refers to. Readers fetch the seek table and the
frames they need by ranged reads.

Which records revisit an equal payload is settled on digests alone; texts move once, by page, to meet their role. Rows
meet the kept record of their digest in a join salted by page, so one payload may be that of a third of all pages.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from datetime import UTC, datetime

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlane.llm.common import bounded, id_key, shared_dir, sliced, written

#: Fixed values of the seekable format: skippable frame, its footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Fixed values of the record format.
VERSION, END = b"WARC/1.1\r\n", b"\r\n\r\n"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Frames that one row of the reader's work stands for.
FRAMES_AT_ONCE = 16

_INDEX = "record_id string, path string, frame int, offset int, length int"
_READ = "record_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(record_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One record; a revisit has the HTTP header only, and the full payload's digest and (as an extension) length in its own header."""
    uri = (url or "").encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A")
    block = HTTP + payload if refers_to is None else HTTP
    head = [b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"), b"WARC-Record-ID: <" + record_id.encode() + b">", b"WARC-Date: " + date.encode(), b"WARC-Target-URI: " + uri]
    head += [b"WARC-Block-Digest: sha1:" + digest_of(block).encode(), b"WARC-Payload-Digest: sha1:" + digest_of(payload).encode(), b"X-Payload-Length: %d" % len(payload)]
    if refers_to is not None:
        head += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: <" + refers_to.encode() + b">"]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return VERSION + b"\r\n".join(head) + END + block + END


def parsed(data: bytes, at: int = 0) -> tuple[dict[bytes, bytes], bytes, int]:
    """Header, block and end of the record at ``at``."""
    stop = data.index(END, at)
    lines = data[at:stop].split(b"\r\n")
    if lines[0] + b"\r\n" != VERSION:
        raise ValueError("no record starts here")
    head = dict(x.split(b": ", 1) for x in lines[1:])
    start = stop + len(END)
    end = start + int(head[b"Content-Length"])
    if data[end : end + len(END)] != END:
        raise ValueError("a record's end is missing")
    return head, data[start:end], end + len(END)


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries)) + entries


class Archive:
    """An archive that is read in ranges: first the seek table at its end, then single frames."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, size = file, file.size()
        count, flags, magic = struct.unpack("<IBI", self._range(size - 9, 9))
        if magic != SEEKABLE or flags & 0x80:
            raise ValueError("no seek table of the kind written here")
        self.places, at = [], 0
        for packed, whole in struct.iter_unpack("<II", self._range(size - 9 - 8 * count, 8 * count)):
            self.places.append((at, packed, whole))
            at += packed

    def _range(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def frame(self, number: int) -> bytes:
        at, packed, whole = self.places[number]
        return zstandard.ZstdDecompressor().decompress(self._range(at, packed), max_output_size=max(1, whole))


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path there."""
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


class ArchiveWriter:
    """Writes records to archives of about ``archive_bytes``; ``add`` and ``close`` return the index of archives that are whole."""

    def __init__(self, folder: str, name: str, frame_bytes: int, archive_bytes: int) -> None:
        self.folder, self.name, self.frame_bytes, self.archive_bytes = folder, name, frame_bytes, archive_bytes
        self.system, self.place = store(folder)
        self.system.create_dir(self.place)
        self.zstd, self.count, self.file = zstandard.ZstdCompressor(level=3), 0, None

    def add(self, record_id: str, data: bytes) -> list[tuple]:
        if self.file is None:
            self.sizes, self.index, self.open, self.written = [], [], bytearray(), 0
            self.file = self.system.open_output_stream(f"{self.place}/{self.name}-{self.count}.part")
        self.index.append((record_id, len(self.sizes), len(self.open), len(data)))
        self.open += data
        if len(self.open) >= self.frame_bytes:
            self._frame()
        return self.close() if self.written >= self.archive_bytes else []

    def _frame(self) -> None:
        packed = self.zstd.compress(bytes(self.open))
        self.file.write(packed)
        self.sizes.append((len(packed), len(self.open)))
        self.written += len(packed)
        self.open = bytearray()

    def close(self) -> list[tuple]:
        if self.file is None:
            return []
        if self.open:
            self._frame()
        self.file.write(seek_table(self.sizes))
        self.file.close()
        done = f"{self.name}-{self.count}.warc.zst"
        self.system.move(f"{self.place}/{self.name}-{self.count}.part", f"{self.place}/{done}")
        self.count, self.file = self.count + 1, None
        return [(i, f"{self.folder}/{done}", k, at, n) for i, k, at, n in self.index]


def revisits(pages: DataFrame, min_bytes: int, salts: int) -> DataFrame:
    """(__key, __digest, __first) of each page whose payload is also that of a page with a larger id."""
    rows = pages.select("__key", "__digest", F.octet_length("__payload").alias("size")).filter(F.col("size") >= min_bytes)
    first = rows.groupBy("__digest").agg(F.max("__key").alias("__first"), F.count("*").alias("n")).filter("n > 1")
    first = first.select("__digest", "__first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("__key"), F.lit(salts)).cast("int"))
    return salted.join(first, ["__digest", "salt"]).filter("__key < __first").select("__key", "__digest", "__first").distinct()


def _record_id(page: F.Column, digest: F.Column, nth: F.Column | None = None) -> F.Column:
    """Unique: a page's id, its payload's digest and, for further rows of both, their number."""
    name = F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), F.lower(F.hex(digest)))
    return name if nth is None else F.when(nth > 1, F.concat(name, F.lit(":"), nth.cast("string"))).otherwise(name)


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, frame_bytes: int = 1 << 18, archive_bytes: int = 1 << 28, salts: int = 16, folder: str | None = None, date: str | None = None) -> DataFrame:
    """Writes archives to ``folder`` (by default a new one below the shared one) and returns their index, a table.

    Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the largest id has the response, the
    others revisit it; smaller payloads are all responses. A null html is an empty payload, a null url an empty one, a
    null id counts as smaller than any other. Rows that repeat an id and payload get one record each, of the same type
    and with identifiers of their own. Ids are whole numbers. ``date`` is the time of all records, by default now.
    An empty table gives an empty index and no archive.
    """
    spark = pages.sparkSession
    bounded(spark)
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(id_key(id_col).alias("__key"), F.col(id_col).cast("string").alias("__page"), F.col(url_col).alias("__url"), F.coalesce(F.col(html_col), F.lit("")).alias("__payload"))
    rows = rows.withColumn("__digest", F.unhex(F.sha1("__payload")))
    joined = rows.join(revisits(rows, min_bytes, salts), ["__key", "__digest"], "left")
    nth = F.row_number().over(Window.partitionBy("__key", "__digest").orderBy("__url"))
    refers = F.when(F.col("__first").isNotNull(), _record_id(F.col("__first"), F.col("__digest")))
    records = joined.select(_record_id(F.col("__page"), F.col("__digest"), nth).alias("id"), F.col("__url").alias("url"), F.col("__payload").cast("binary").alias("payload"), refers.alias("refers_to"))
    names = ["record_id", "path", "frame", "offset", "length"]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches):
        task = TaskContext.get()
        writer = ArchiveWriter(folder, f"part-{task.partitionId()}-{task.taskAttemptId()}", frame_bytes, archive_bytes)
        batch = lambda done: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)
        for b in sliced(batches, 2):
            for i, url, payload, refers_to in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if done := writer.add(i, record(i, url, payload, refers_to, date)):
                    yield batch(done)
        if done := writer.close():
            yield batch(done)

    return written(records.mapInArrow(run, _INDEX), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """One row per record: record_id, payload_bytes, payload_digest, record_type, refers_to.

    Blocks are hashed anew and held against their headers, and so are the payloads of responses.
    """

    def rows_of(text: bytes):
        at = 0
        while at < len(text):
            head, block, at = parsed(text, at)
            size, stated = int(head[b"X-Payload-Length"]), head[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
            payload = block.split(END, 1)[1]
            if digest_of(block) != head[b"WARC-Block-Digest"].removeprefix(b"sha1:").decode() or head[b"WARC-Type"] == b"response" and (len(payload), digest_of(payload)) != (size, stated):
                raise ValueError("a block or payload differs from its header")
            yield {"record_id": head[b"WARC-Record-ID"].strip(b"<>").decode(), "payload_bytes": size, "payload_digest": stated, "record_type": head[b"WARC-Type"].decode(), "refers_to": head[b"WARC-Refers-To"].strip(b"<>").decode() if b"WARC-Refers-To" in head else None}

    def run(batches):
        kind = pa.schema([("record_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())])
        for b in batches:
            for path, some in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                system, place = store(path)
                with system.open_input_file(place) as file:
                    archive = Archive(file)
                    for k in range(some * FRAMES_AT_ONCE, min(len(archive.places), (some + 1) * FRAMES_AT_ONCE)):
                        yield pa.RecordBatch.from_pylist(list(rows_of(archive.frame(k))), schema=kind)

    work = index.select("path", F.floor(F.col("frame") / FRAMES_AT_ONCE).cast("int").alias("some")).distinct()
    return work.mapInArrow(run, _READ)


def fetch(index: DataFrame, record_ids: list[str]) -> DataFrame:
    """(record_id, record bytes) of the few records named: only the seek tables and the frames that hold them are read."""

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                system, place = store(r["path"])
                with system.open_input_file(place) as file:
                    out.append({"record_id": r["record_id"], "record": Archive(file).frame(r["frame"])[r["offset"] : r["offset"] + r["length"]]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("record_id", pa.string()), ("record", pa.binary())]))

    return index.filter(F.col("record_id").isin(record_ids)).mapInArrow(run, "record_id string, record binary")


def digest(index: DataFrame) -> DataFrame:
    """One row per page, from what is read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    page = lambda c: F.expr(f"try_cast(split_part({c}, ':', 3) AS bigint)")
    return read_archives(index).select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
