"""Spark data source ``wet``: crawl records framed by their declared length.

A file is a row of gzip members, usually one to a record. It is planned as
ranges of bytes; a task starts at the first member of its range that begins
with a record and goes on until a member beyond the range does, so the tasks of
a file share its records without having looked at it first. A record's body is
as long as its head says, whatever it holds.

Files are opened through pyarrow, which knows local paths, S3, GCS and mounted
HDFS; :func:`sievemark.sources.wet.read_wet` reads other stores through Spark.
"""

from __future__ import annotations

import fnmatch
import hashlib
import re
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

# Executors need not have this package installed: the source travels whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GLOB = "*.warc.wet.gz"
SCHEMA = "id string, url string, date string, text string, file_path string, offset bigint, length_ok boolean, problem string"
MAGIC = b"\x1f\x8b\x08"
RECORD = b"WARC/1."
HEAD_END = b"\r\n\r\n"
MAX_HEAD = 1 << 20  # bytes in which a head must end
CHUNK = 1 << 20  # compressed bytes read at once
SPLIT = 32 << 20  # compressed bytes of a range
FLUSH = 8 << 20  # bytes of text of a batch
PROBE = 1 << 16  # compressed bytes of a member that is tried


def filesystem(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what its paths begin with as names; ValueError for a store that pyarrow doesn't know."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path.rstrip("/") or "/", "file://"
    try:
        found, inner = fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as reason:
        raise ValueError(f"{path} can't be opened directly: {reason}") from reason
    return found, inner.rstrip("/"), path[: path.index("://") + 3]


class Frames:
    """Cuts a stream of bytes into records. ``wanted`` bodies are held, others are dropped as they come."""

    def __init__(self, wanted: bytes = b"conversion"):
        self.wanted = wanted
        self.data = bytearray()
        self.head: dict[bytes, bytes] | None = None
        self.left: int | None = None  # bytes of a body that is dropped
        self.offset = 0

    def feed(self, data: bytes, offset: int) -> Iterator[tuple]:
        """Records that are complete now; ``offset`` is the member's, kept for records that begin in ``data``."""
        self.data += data
        while True:
            if self.left:
                n = min(self.left, len(self.data))
                del self.data[:n]
                self.left -= n
                if self.left:
                    return
                self.head, self.left = None, None
            if self.head is None:
                blank = len(self.data) - len(self.data.lstrip(b"\r\n"))
                del self.data[:blank]
                at = self.data.find(HEAD_END)
                if at < 0:
                    self.offset = offset
                    if len(self.data) > MAX_HEAD:
                        yield self._row(b"", False, "no head")
                        self.data.clear()
                    return
                lines = bytes(self.data[:at]).split(b"\r\n")
                if not lines[0].startswith(b"WARC/"):
                    yield self._row(b"", False, "no head")
                    self.data.clear()
                    return
                self.offset = offset
                self.head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
                del self.data[: at + len(HEAD_END)]
                length = self.head.get(b"content-length", b"")
                if not length.isdigit():
                    if self.head.get(b"warc-type") == self.wanted:
                        yield self._row(b"", False, "no length")
                    self.head = None
                    self.data.clear()
                    return
                self.length = int(length)
                if self.head.get(b"warc-type") != self.wanted:
                    self.left = self.length or None
                    self.head = None if not self.length else self.head
                    continue
            if len(self.data) < self.length:
                return
            yield self._row(bytes(self.data[: self.length]), True, None)
            del self.data[: self.length]
            self.head = None

    def end(self, problem: str) -> Iterator[tuple]:
        """What is left of a record that the stream doesn't finish."""
        if self.head is not None and self.left is None:
            yield self._row(bytes(self.data), False, problem)
        elif self.head is None and self.data.strip(b"\r\n"):
            yield self._row(b"", False, problem)
        self.data.clear()
        self.head = self.left = None

    def lost(self, offset: int) -> tuple:
        """A row for a member of which nothing is known."""
        self.offset = offset
        return self._row(b"", False, "bad gzip")

    def _row(self, body: bytes, whole: bool, problem: str | None) -> tuple:
        head = self.head or {}
        text = lambda k: head[k].decode("utf-8", "replace") if head.get(k) else None
        url, date, name = text(b"warc-target-uri"), text(b"warc-date"), text(b"warc-record-id")
        if name is None:
            name = hashlib.md5(b"\n".join([*[x.encode() for x in (url, date) if x is not None], body])).hexdigest()
        return re.sub(r"^<|>$", "", name), url, date, body.decode("utf-8", "replace"), self.offset, whole, problem


def next_member(read: Callable[[int, int], bytes], at: int, size: int) -> int:
    """Offset of the first gzip member from ``at`` on that begins with a record, or ``size``."""
    while at < size:
        data = read(at, CHUNK + PROBE)
        place = data.find(MAGIC, 0, CHUNK + len(MAGIC) - 1)
        while place >= 0:
            try:
                if zlib.decompressobj(31).decompress(data[place : place + PROBE], len(RECORD)).startswith(RECORD):
                    return at + place
            except zlib.error:
                pass
            place = data.find(MAGIC, place + 1, CHUNK + len(MAGIC) - 1)
        at += CHUNK
    return size


def records(read: Callable[[int, int], bytes], size: int, begin: int, end: int) -> Iterator[tuple]:
    """Records of the members that begin in a range of bytes, as rows without a file name.

    A record may go on in further members. One that a member which begins with
    a record cuts off is ``truncated``; what can't be unpacked is a ``bad gzip``
    row, after which reading goes on at the next member that begins with one.
    """
    frames = Frames()
    if read(0, len(MAGIC)) != MAGIC:  # not packed: one task reads the file
        if begin == 0:
            for at in range(0, size, CHUNK):
                yield from frames.feed(read(at, CHUNK), 0)
            yield from frames.end("truncated")
        return
    at = 0 if begin == 0 else next_member(read, begin, size)
    if at >= end:
        return
    while at < size:
        member, unpack, position, first = at, zlib.decompressobj(31), at, True
        while not unpack.eof:
            data = read(position, CHUNK)
            position += len(data)
            if not data:
                yield from frames.end("truncated")
                return
            # Unpacked piece by piece, so that a small file can't fill the memory.
            while data and not unpack.eof:
                try:
                    out = unpack.decompress(data, 8 * CHUNK)
                except zlib.error:
                    yield from list(frames.end("bad gzip")) or [frames.lost(member)]
                    out = None
                    break
                if first and out:
                    if out.startswith(RECORD):
                        yield from frames.end("truncated")
                        if member >= end:
                            return
                    first = False
                yield from frames.feed(out, member)
                data = unpack.unconsumed_tail
            if out is None:
                break
        if out is None:
            at = next_member(read, member + 1, size)
            if at >= end:
                return
        else:
            at = position - len(unpack.unused_data)
            if read(at, len(MAGIC)) != MAGIC and at < size:  # padding between members
                at = next_member(read, at, size)
                if at >= end:
                    yield from frames.end("truncated")
                    return
    yield from frames.end("truncated")


@dataclass
class Run(InputPartition):
    """A range of bytes of a file."""

    path: str
    size: int
    begin: int
    end: int


class WetReader(DataSourceReader):
    def __init__(self, path: str, glob: str, split: int):
        self.path, self.glob, self.split = path, glob, split

    def partitions(self) -> list[Run]:
        found, inner, _ = filesystem(self.path)
        info = found.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.is_file else found.get_file_info(fs.FileSelector(inner, recursive=True))
        hidden = lambda p: any(x.startswith(("_", ".")) for x in p.removeprefix(inner).split("/") if x)
        named = sorted((f.path, f.size) for f in files if f.is_file and (info.is_file or fnmatch.fnmatch(f.base_name, self.glob) and not hidden(f.path)))
        return [Run(path, size, a, min(size, a + self.split)) for path, size in named for a in range(0, size, self.split)] or [Run("", 0, 0, 0)]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        if not partition.size:
            return
        found, _, prefix = filesystem(self.path)
        with found.open_input_file(partition.path) as file:

            def read(at: int, n: int) -> bytes:
                return file.read_at(max(0, min(n, partition.size - at)), at) if at < partition.size else b""

            yield from batches(records(read, partition.size, partition.begin, partition.end), prefix + partition.path)


def batches(rows: Iterator[tuple], path: str) -> Iterator[pa.RecordBatch]:
    """Rows of :func:`records` with their file, in batches of about FLUSH bytes."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    types = [kinds[c.split()[1]] for c in SCHEMA.split(", ")]
    held, size = [], 0

    def made() -> pa.RecordBatch:
        columns = list(zip(*held))
        columns.insert(4, [path] * len(held))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for row in rows:
        held.append(row)
        size += len(row[3]) + 200
        if size >= FLUSH:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def packed_record(kind: bytes, name: str | None, url: str | None, date: str | None, body: bytes) -> bytes:
    """One record as one gzip member."""
    clean = lambda x: re.sub(r"[\r\n]+", " ", x).encode()
    head = [b"WARC/1.0", b"WARC-Type: " + kind]
    head += [key + b": " + value for key, value in ((b"WARC-Target-URI", url and clean(url)), (b"WARC-Date", date and clean(date)), (b"WARC-Record-ID", name and b"<" + clean(name) + b">")) if value]
    head += [b"Content-Type: text/plain", b"Content-Length: %d" % len(body)]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"\r\n".join(head) + HEAD_END + body + HEAD_END) + pack.flush()


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    records: int


class WetWriter(DataSourceArrowWriter):
    """A file for each task, written aside; the files of the tasks that count are renamed when all have ended."""

    def __init__(self, path: str, names: list[str], overwrite: bool):
        self.path, self.names, self.overwrite = path, names, overwrite
        self.aside = f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        found, inner, _ = filesystem(self.path)
        found.create_dir(f"{inner}/{self.aside}", recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.wet.gz"
        n = 0
        with found.open_output_stream(f"{inner}/{self.aside}/{name}", compression=None) as file:
            file.write(packed_record(b"warcinfo", None, None, None, b"software: sievemark\r\n"))
            for batch in iterator:
                column = lambda c, b=batch: b.column(c).cast(pa.string()).to_pylist() if c in self.names else [None] * b.num_rows
                for key, url, date, text in zip(*(column(c) for c in ("id", "url", "date", "text"))):
                    file.write(packed_record(b"conversion", key, url, date, (text or "").encode("utf-8", "surrogatepass")))
                    n += 1
        return Written(name, n)

    def commit(self, messages: list[Written | None]) -> None:
        found, inner, _ = filesystem(self.path)
        old = [f.path for f in found.get_file_info(fs.FileSelector(inner)) if f.is_file and fnmatch.fnmatch(f.base_name, GLOB)] if self.overwrite else []
        for m in messages:
            if m is not None and m.name:
                found.move(f"{inner}/{self.aside}/{m.name}", f"{inner}/{m.name}")
        for path in old:
            found.delete_file(path)
        found.delete_dir(f"{inner}/{self.aside}")

    def abort(self, messages: list[Written | None]) -> None:
        found, inner, _ = filesystem(self.path)
        if found.get_file_info(f"{inner}/{self.aside}").type == fs.FileType.Directory:
            found.delete_dir(f"{inner}/{self.aside}")


class WetSource(DataSource):
    """``spark.read.format("wet")`` after ``spark.dataSource.register(WetSource)``. Options: path, glob, split (bytes of a range)."""

    @classmethod
    def name(cls) -> str:
        return "wet"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WetReader:
        return WetReader(self.options["path"], self.options.get("glob", GLOB), int(self.options.get("split", SPLIT)))

    def writer(self, schema, overwrite: bool) -> WetWriter:
        return WetWriter(self.options["path"], schema.names, overwrite)
