"""WARC / WET archives as a Spark data source: ``format("warc")`` reads and writes them.

Reading. A file is dealt in byte ranges (at most ``rangeBytes``), small files together; a range owns the records whose first stored
byte lies in it. A task finds the first record of its range by walking from up to ``LOOKBACK`` bytes before it, so
that a record inside another record's payload is passed over with its carrier, and reads on to the end of the
last record it owns. In a gzip file the unit is the member (one or many records). Bytes that belong to
no whole record come as rows with a ``reason``; the stored lengths of all rows of a file add up to its size. Equality, ``IN`` and prefix filters on ``warc_type`` and ``uri`` are taken into the scan
(where ``spark.sql.python.filterPushdown.enabled`` is on; ``register`` turns it on) and judged on a record's head: the payload of other
records is skipped. A schema without ``block`` or ``head`` (``.schema(...)``, or ``heads_only``) leaves those bytes out of the scan's rows.

Writing. Every record becomes a gzip member of its own: the head as it was read (column ``head``), else one
made of type and URI, then the payload unchanged. Tasks write to a staging folder below the
target and report their parts; the driver's commit moves only reported parts into place, so a failed, repeated or
speculative attempt leaves nothing. With a column ``chunk`` every chunk is a folder ``chunk=<value>`` (sort by it
within partitions, as ``write_records`` does: one file is open at a time).

Index and point reads. ``index_records`` lists a record a row (file, offset, place in the member, type, URI, length)
without payloads; ``read_at`` takes any rows of such an index, picked by any query, and reads just these members.

Files are opened through ``pyarrow.fs``: any URI that it knows, or a path that all executors share.

Limit: a carried archive that reaches over a range's edge by more than ``LOOKBACK`` bytes, stored uncompressed, could be
taken for the file's own records; ``rangeBytes`` 0 reads such files whole.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Generator, Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

RANGE_BYTES = 128 << 20
MIN_TASKS, LEAST_BYTES = 64, 1 << 20  # smaller inputs get smaller shares, so that there are tasks for all cores
OPEN_BYTES = 1 << 16  # what opening a file counts for in a task's share
LOOKBACK = 8 << 20
BATCH_BYTES = 8 << 20  # payload bytes of a batch of rows, about
HEAD_LIMIT = 1 << 20  # a longer head is none
_READ = 1 << 18
_MAGIC, _START, _BLANK = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
_TYPE = re.compile(rb"(?im)^WARC-Type:[ \t]*([^\r\n]*)")
_URI = re.compile(rb"(?im)^WARC-Target-URI:[ \t]*([^\r\n]*)")
_LENGTH = re.compile(rb"(?im)^Content-Length:[ \t]*(\d+)[ \t]*\r?$")

SCHEMA = ("file string, offset long, inner long, stored long, warc_type string, uri string, "
          "content_length long, head binary, block binary, reason string")
_TYPES = {"file": pa.string(), "offset": pa.int64(), "inner": pa.int64(), "stored": pa.int64(), "warc_type": pa.string(),
          "uri": pa.string(), "content_length": pa.int64(), "head": pa.binary(), "block": pa.binary(), "reason": pa.string()}
#: What the data source returns when payloads are not asked for.
HEADS = "file string, offset long, inner long, stored long, warc_type string, uri string, content_length long, reason string"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or path, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def list_files(path: str) -> list[tuple[str, int]]:
    """(file, size) of the archives below ``path``; names with a leading '_' or '.' are not data."""
    fs, p = filesystem(path)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    below = fs.get_file_info(pafs.FileSelector(p, recursive=True))
    base = p.rstrip("/")
    found = [(x.path, x.size) for x in below if x.type == pafs.FileType.File
             and not any(part[0] in "_." for part in x.path[len(base):].split("/") if part)]
    return [(path.rstrip("/") + f[len(base):], n) for f, n in sorted(found)]


class Truncated(Exception):
    pass


class _Plain:
    """Bytes of a file from a place on."""

    def __init__(self, f, at: int):
        self.f, self.buf, self.used = f, b"", 0
        f.seek(at)

    def fill(self, n: int) -> int:
        """At least n unread bytes in the buffer, if the input has them; how many there are."""
        while len(self.buf) - self.used < n:
            more = self.more()
            if not more:
                break
            self.buf, self.used = self.buf[self.used:] + more, 0
        return len(self.buf) - self.used

    def more(self) -> bytes:
        return self.f.read(_READ)

    def peek(self, n: int) -> bytes:
        self.fill(n)
        return self.buf[self.used:self.used + n]

    def take(self, n: int, keep: bool = True) -> bytes | None:
        """The next n bytes, or None after passing over them; Truncated when there are fewer."""
        parts, left = [], n
        while left:
            have = min(self.fill(1), left)
            if not have:
                raise Truncated(b"".join(parts))
            if keep:
                parts.append(self.buf[self.used:self.used + have])
            self.used += have
            left -= have
        return b"".join(parts) if keep else None

    def find_blank(self) -> int:
        """Length of the head with its blank line; 0 if there is none."""
        size = 4096
        while True:
            have = self.fill(size)
            at = self.buf.find(_BLANK, self.used, self.used + size)
            if at >= 0:
                return at + len(_BLANK) - self.used
            if have < size or size >= HEAD_LIMIT:
                return 0
            size *= 4


class _Member(_Plain):
    """The inflated bytes of the gzip member at a place; ``end`` is the place after it once all is read."""

    def __init__(self, f, at: int):
        super().__init__(f, at)
        self.z, self.at, self.end, self.raw = zlib.decompressobj(31), at, None, b""

    def more(self) -> bytes:
        while self.end is None:
            data = self.raw or self.f.read(_READ)
            self.at += len(data) - len(self.raw)
            if not data:
                raise zlib.error("the member is cut off")
            out = self.z.decompress(data, _READ)
            self.raw = self.z.unconsumed_tail
            if self.z.eof:
                self.end = self.at - len(self.z.unused_data)
            if out:
                return out
        return b""


@dataclass
class Wanted:
    """What a scan asks for: columns, and predicates on type and URI."""

    columns: tuple[str, ...]
    equal: tuple[tuple[str, tuple], ...] = ()  # (column, values)
    prefix: tuple[tuple[str, str], ...] = ()

    def fits(self, warc_type: str | None, uri: str | None) -> bool:
        of = {"warc_type": warc_type, "uri": uri}
        return (all(of[c] in v for c, v in self.equal)
                and all(of[c] is not None and of[c].startswith(v) for c, v in self.prefix))


def _records(s: _Plain, wanted: Wanted) -> Iterator[tuple]:
    """(bytes passed over, type, uri, length, head, block, fits) of the records of a stream; Truncated or ValueError where
    it holds none. The stream stands behind the record's blank lines when it is yielded."""
    while s.fill(1):
        n = s.find_blank()
        head = s.buf[s.used:s.used + n]
        kind, length, uri = _TYPE.search(head), _LENGTH.search(head), _URI.search(head)
        if not (n and head.startswith(_START) and kind and length):
            raise ValueError("no header")
        warc_type = kind[1].decode("utf-8", "replace").strip()
        target = uri[1].decode("utf-8", "replace").strip() or None if uri else None
        fits = wanted.fits(warc_type, target)
        s.take(n)
        size = int(length[1])
        try:
            block = s.take(size, keep=fits and "block" in wanted.columns)
        except Truncated as e:
            raise Truncated(head + e.args[0]) from None
        blank = 0
        while blank < len(_BLANK) and s.peek(blank + 1)[blank:] in (b"\r", b"\n"):
            blank += 1
        if blank < len(_BLANK) and s.peek(blank + len(_START))[blank:] not in (b"", _START):
            raise Truncated(head + (block or b""))  # the payload is not as long as its head says
        s.take(blank)
        yield n + size + blank, warc_type, target, size, head, block, fits


def _next_start(f, at: int, size: int, gz: bool) -> int:
    """The next place from ``at`` on where a record (or a member with one) starts; ``size`` if there is none."""
    mark = _MAGIC if gz else _START
    f.seek(at)
    base, buf = at, b""
    while True:
        more = f.read(_READ)
        buf += more
        i = buf.find(mark)
        while i >= 0 and (i + 4096 <= len(buf) or not more):
            if not gz:
                return base + i
            try:
                if zlib.decompressobj(31).decompress(buf[i:i + 4096], len(_START)) == _START:
                    return base + i
            except zlib.error:
                pass
            i = buf.find(mark, i + 1)
        if not more:
            return size
        keep = i if i >= 0 else max(len(buf) - len(mark) + 1, 0)
        base, buf = base + keep, buf[keep:]


def walk(f, size: int, gz: bool, start: int, stop: int, wanted: Wanted,
         lossless: bool = True) -> Generator[tuple, None, int]:
    """Rows (offset, inner, stored, type, uri, length, head, block, reason) that start before ``stop``, from the record
    start (or damage) at ``start`` on; returns the place after them. Rejected rows hold the bytes in ``block`` (what could
    be inflated of them, in a gzip file); without ``lossless`` there are none."""
    at = start
    while at < min(stop, size):
        s = _Member(f, at) if gz else _Plain(f, at)
        inner, reason, rest = 0, None, b""
        rows = _records(s, wanted)
        held = None  # a gzip row, until it is known whether it is the member's last
        while True:
            if not gz and at >= stop:
                return at
            try:
                passed, kind, uri, n, head, block, fits = next(rows)
            except StopIteration:
                break
            except (Truncated, ValueError, zlib.error) as e:
                reason = "no header" if isinstance(e, ValueError) and not isinstance(e, zlib.error) else "truncated"
                rest = e.args[0] if isinstance(e, Truncated) else b""
                break
            row = (at, inner, passed, kind, uri, n, head, block, None) if fits else None
            if gz:
                if held:
                    yield held
                held = row and (*row[:2], 0, *row[3:])
                inner += passed
            else:
                if row:
                    yield row
                at += passed
        if gz and reason is None:
            end = s.end
            if held:  # the member's stored bytes count for its last record
                yield (*held[:2], end - at, *held[3:])
            at = end
        elif reason is not None:
            if held:
                yield held
            end = _next_start(f, at + 1, size, gz)
            if lossless and wanted.fits(None, None):
                if not gz:
                    f.seek(at)
                    rest = f.read(end - at)
                yield (at, inner, end - at, None, None, None, None, rest, reason)
            at = end
    return at


def first_start(f, lo: int, size: int, gz: bool) -> int:
    """Where the first record (member) of the range from ``lo`` on starts."""
    if lo == 0:
        return 0
    at = _next_start(f, lo - LOOKBACK, size, gz) if lo > LOOKBACK else 0
    heads = walk(f, size, gz, at, lo, Wanted(columns=()), lossless=False)
    while True:
        try:
            next(heads)
        except StopIteration as e:
            return max(at, e.value)


class _Rows:
    """Rows of one file gathered into batches of the asked columns."""

    def __init__(self, file: str, columns: tuple[str, ...]):
        self.file, self.columns, self.rows, self.size = file, columns, [], 0

    def add(self, row: tuple) -> bool:
        self.rows.append(row)
        self.size += 256 + sum(len(row[i]) for i in (6, 7) if row[i])
        return self.size >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        of = dict(zip(list(_TYPES)[1:], zip(*self.rows, strict=True), strict=True))
        of["file"] = [self.file] * len(self.rows)
        out = pa.RecordBatch.from_arrays([pa.array(of[c], type=_TYPES[c]) for c in self.columns], list(self.columns))
        self.rows, self.size = [], 0
        return out


@dataclass
class FileRange:
    file: str
    lo: int
    hi: int
    size: int


@dataclass
class Share(InputPartition):
    """What a task reads."""

    ranges: list[FileRange]


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, columns: tuple[str, ...], range_bytes: int):
        unknown = set(columns) - set(_TYPES)
        if unknown:
            raise ValueError(f"an archive has no columns {sorted(unknown)}; it has {SCHEMA}")
        self.path, self.range_bytes, self.wanted = path, range_bytes, Wanted(columns)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        equal, prefix = [], []
        for x in filters:
            column = getattr(x, "attribute", (None,))
            if column in (("warc_type",), ("uri",)):
                if isinstance(x, EqualTo):
                    equal.append((column[0], (x.value,)))
                    continue
                if isinstance(x, In):
                    equal.append((column[0], tuple(x.value)))
                    continue
                if isinstance(x, StringStartsWith):
                    prefix.append((column[0], x.value))
                    continue
            yield x
        self.wanted = Wanted(self.wanted.columns, tuple(equal), tuple(prefix))

    def partitions(self) -> list[Share]:
        """Ranges of large files, and small files together, up to a share's bytes."""
        files = list_files(self.path)
        share = max(sum(n for _, n in files) // MIN_TASKS, LEAST_BYTES)
        share = min(self.range_bytes, share) if self.range_bytes else share
        out, held, room = [], [], share
        for file, size in files:
            step = self.range_bytes and share or max(size, 1)
            for lo in range(0, size, step):
                hi = min(lo + step, size)
                if held and hi - lo > room:
                    out.append(Share(held))
                    held, room = [], share
                held.append(FileRange(file, lo, hi, size))
                room -= hi - lo + OPEN_BYTES
        return [*out, Share(held)] if held else out

    def read(self, part: Share) -> Iterator[pa.RecordBatch]:
        if isinstance(part, Share):  # without any file Spark reads once, without a partition
            for r in part.ranges:
                yield from self.read_range(r)

    def read_range(self, part: FileRange) -> Iterator[pa.RecordBatch]:
        fs, p = filesystem(part.file)
        rows = _Rows(part.file, self.wanted.columns)
        with fs.open_input_file(p) as f:
            gz = f.read(2) == _MAGIC[:2]
            for row in walk(f, part.size, gz, first_start(f, part.lo, part.size, gz), part.hi, self.wanted):
                if rows.add(row):
                    yield rows.batch()
        if rows.rows:
            yield rows.batch()


@dataclass
class Parts(WriterCommitMessage):
    files: list[tuple[str, str, int, int]]  # (staged, final, records, bytes)


class StagedWriter(DataSourceArrowWriter):
    """Writes parts into a staging folder; the driver's commit moves those that tasks reported."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.staging = f"_staging-{uuid.uuid4().hex[:12]}"
        fs, base = filesystem(self.path)  # made by the driver alone: a task that outlives an abort finds no folder
        fs.create_dir(f"{base}/{self.staging}", recursive=True)

    def records(self, batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
        """(folder below the target, stored bytes) of every row."""
        raise NotImplementedError

    def suffix(self) -> str:
        return ".gz"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Parts:
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        fs, base = filesystem(self.path)
        files: list = []
        out, at = None, None
        try:
            for b in batches:
                for folder, data in self.records(b):
                    if out is None or folder != at:
                        if out:
                            out.close()
                        staged = f"{base}/{self.staging}/{name}-{len(files)}"
                        out, at = fs.open_output_stream(staged, compression=None), folder
                        files.append([staged, f"{base}/{folder}{name}-{len(files)}{self.suffix()}", 0, 0])
                    out.write(data)
                    files[-1][2] += 1
                    files[-1][3] += len(data)
        finally:
            if out:
                out.close()
        return Parts([tuple(x) for x in files])

    def commit(self, messages: list[Parts | None]) -> None:
        fs, base = filesystem(self.path)
        fs.create_dir(base, recursive=True)
        old = [x for x in fs.get_file_info(pafs.FileSelector(base)) if x.path.rsplit("/", 1)[-1] != self.staging]
        if self.overwrite:
            self.drop(fs, old)
        for staged, final, _, _ in (f for m in messages if m is not None for f in m.files):
            fs.create_dir(final.rsplit("/", 1)[0], recursive=True)
            fs.move(staged, final)
        self._drop_staging(fs, base)
        with fs.open_output_stream(f"{base}/_SUCCESS", compression=None):
            pass

    def abort(self, messages: list[Parts | None]) -> None:
        self._drop_staging(*filesystem(self.path))

    @staticmethod
    def drop(fs: pafs.FileSystem, infos: list[pafs.FileInfo]) -> None:
        for x in infos:
            if x.type == pafs.FileType.Directory:
                fs.delete_dir(x.path)
            else:
                fs.delete_file(x.path)

    def _drop_staging(self, fs: pafs.FileSystem, base: str) -> None:
        if fs.get_file_info(f"{base}/{self.staging}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{base}/{self.staging}")


class ArchiveWriter(StagedWriter):
    """A gzip member a record; a folder per chunk."""

    def __init__(self, path: str, overwrite: bool, level: int):
        super().__init__(path, overwrite)
        self.level = level

    def suffix(self) -> str:
        return ".warc.gz"

    def records(self, batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        nothing = pa.nulls(batch.num_rows, pa.string())
        chunked = "chunk" in columns
        rows = zip(columns["chunk"].cast(pa.string()) if chunked else nothing, columns.get("head", nothing),
                   columns["warc_type"], columns["uri"], columns["block"], strict=True)
        for chunk, head, kind, uri, block in rows:
            chunk = chunk.as_py()
            folder = f"chunk={'__HIVE_DEFAULT_PARTITION__' if chunk is None else quote(chunk, safe='')}/" if chunked else ""
            yield folder, member(head.as_py(), kind.as_py(), uri.as_py(), block.as_py(), self.level)


def member(head: bytes | None, warc_type: str | None, uri: str | None, block: bytes | None, level: int = 6) -> bytes:
    """One record as a gzip member. A given head is kept as it is; one is made of type and URI else."""
    block = block or b""
    if not head:
        lines = ["WARC/1.0", f"WARC-Type: {warc_type}"] + ([f"WARC-Target-URI: {uri}"] if uri is not None else [])
        head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + _BLANK
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(head + block + _BLANK) + z.flush()


class ArchiveSource(DataSource):
    """Options: ``path`` (a file, or a folder read recursively), ``rangeBytes`` (0: whole files), ``level``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(self.options["path"], tuple(schema.names), int(self.options.get("rangeBytes", RANGE_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> ArchiveWriter:
        missing = {"warc_type", "uri", "block"} - set(schema.names)
        if missing:
            raise ValueError(f"an archive record needs the columns {sorted(missing)}")
        return ArchiveWriter(self.options["path"], overwrite, int(self.options.get("level", 6)))


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known to the session, with filters pushed into the scan."""
    spark.dataSource.register(ArchiveSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archive(spark: SparkSession, path: str, heads_only: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every record of the archives at ``path``, and rejected bytes with a ``reason``."""
    register(spark)
    reader = spark.read.format("warc").option("rangeBytes", range_bytes)
    return (reader.schema(HEADS) if heads_only else reader).load(path)


def write_records(df: DataFrame, path: str, level: int = 6) -> None:
    """Archives of the columns warc_type, uri, block (head, chunk), in the order of the partitions' rows."""
    register(df.sparkSession)
    columns = [c for c in ("warc_type", "uri", "head", "block", "chunk") if c in df.columns]
    out = df.select(*columns)
    if "chunk" in columns:
        out = out.sortWithinPartitions("chunk")
    out.write.format("warc").option("level", level).mode("overwrite").save(path)


# ---------------------------------------------------------------- index and point reads
def index_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, offset, inner, warc_type, uri, content_length) of every whole record; payloads stay in the files."""
    heads = read_archive(spark, path, heads_only=True, range_bytes=range_bytes)
    return heads.where("reason IS NULL").drop("reason", "stored")


def read_at(chosen: DataFrame, partitions: int | None = None) -> DataFrame:
    """``chosen`` rows of an index with ``head`` and ``block``: only their members are read.

    The rows are ordered by file and place, so that a task opens a file once and reads forward.
    """
    n = partitions or chosen.sparkSession.sparkContext.defaultParallelism
    rows = chosen.select("file", "offset", "inner", "warc_type", "uri", "content_length")
    names = [f.name for f in rows.schema]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, of, gz = None, None, False
        try:
            for b in batches:
                heads, blocks, size, first = [], [], 0, 0
                for i, (file, offset, inner) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                                              b.column(2).to_pylist(), strict=True)):
                    if file != of:
                        if f:
                            f.close()
                        fs, p = filesystem(file)
                        f, of = fs.open_input_file(p), file
                        gz = f.read(2) == _MAGIC[:2]
                    s = _Member(f, offset) if gz else _Plain(f, offset)
                    s.take(inner, keep=False)
                    _, _, _, _, head, block, _ = next(_records(s, Wanted(("block",))))
                    heads.append(head)
                    blocks.append(block)
                    size += len(head) + len(block)
                    if size >= BATCH_BYTES:
                        yield _with_payload(b.slice(first, i + 1 - first), heads, blocks)
                        heads, blocks, size, first = [], [], 0, i + 1
                yield _with_payload(b.slice(first), heads, blocks)
        finally:
            if f:
                f.close()

    def _with_payload(b: pa.RecordBatch, heads: list[bytes], blocks: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(heads, type=pa.binary()), pa.array(blocks, type=pa.binary())],
                                          [*names, "head", "block"])
    ordered = rows.repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset", "inner")
    return ordered.mapInArrow(read, "file string, offset long, inner long, warc_type string, uri string, "
                                    "content_length long, head binary, block binary")


def payload_text(block: str = "block") -> Column:
    """The HTTP payload of a response block as text (what follows the HTTP head), invalid UTF-8 replaced."""
    raw = F.col(block).cast("binary")
    head = F.substring_index(F.col(block).cast("string"), "\r\n\r\n", 1)
    return F.make_valid_utf8(F.substring(raw, F.octet_length(head) + 5, 2_147_483_647).cast("string"))
