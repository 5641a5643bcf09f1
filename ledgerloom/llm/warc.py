"""Web pages as WARC archives, written by tasks and read through a Python data source.

Archives are gzip files with one member per record. Each member names its compressed length in an
extra field of its header, so a reader steps over a record whose headers it does not want without
inflating its payload; archives of other writers are inflated from start to end instead.

A folder that was written to has a manifest of the files that its tasks finished. What lost attempts
or an earlier run left beside them is not read. A folder of other writers has none; all archives below
it are read, plain ones too.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition
from pyspark.sql.types import StructType

from ledgerloom.llm.shipping import ship
from ledgerloom.session import stage

SUFFIX, PLAIN_SUFFIX = ".warc.gz", ".warc"
MANIFEST = "manifest-"
FILE_BYTES = 256 * 1024 * 1024
_CHUNK = 64 * 1024
_BATCH_BYTES = 8 * 1024 * 1024
_DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Subfield of the gzip header: compressed length of the member, plain length of its record.
_SKIP = b"sl"
_WRITTEN = "file string, records long, bytes long"

SCHEMA = (
    "record_type string, record_id string, refers_to string, target_uri string, payload_digest string, "
    "payload_bytes long, payload binary"
)
_HEADER_OF = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "refers_to": "warc-refers-to",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
}


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _one_line(text: str) -> str:
    """``text`` without characters that would end a header."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; with ``refers_to`` a revisit, which has the headers of the answer only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}"]
    head.append(f"WARC-Date: {_DATE}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = 3) -> bytes:
    deflate = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(record) + deflate.flush()
    extra = 12
    total = 10 + 2 + extra + len(body) + 8
    head = struct.pack("<4BI2B", 0x1F, 0x8B, 8, 4, 0, 0, 255)
    field = struct.pack("<H2sHII", extra, _SKIP, 8, total & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return head + field + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Write the pages of a task. A file gets its name when it is complete, and names hold the attempt:
    a task that is run again writes other files, and those of the attempt that counts are returned."""
    store, root = fs.FileSystem.from_uri(folder)
    context, attempt = TaskContext.get(), uuid.uuid4().hex
    done: list[tuple[str, int, int]] = []
    out, records, size = None, 0, 0

    def name(final: bool) -> str:
        base = f"part-{context.partitionId():05d}-{len(done):04d}-{attempt}{SUFFIX}"
        return f"{root}/{base}" if final else f"{root}/.{base}"

    def close() -> None:
        nonlocal out
        out.close()
        store.move(name(False), name(True))
        done.append((name(True), records, size))
        out = None

    for batch in batches:
        for page_id, url, html, refers_to, revisits in zip(*(batch.column(i) for i in range(5))):
            payload = html.as_buffer().to_pybytes()
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            refers = refers_to.as_py() if revisits.as_py() else None
            member = gzip_member(record_bytes(page_id.as_py(), url.as_py(), payload, digest, refers))
            if out is not None and size + len(member) > file_bytes:
                close()
            if out is None:
                out, records, size = store.open_output_stream(name(False), compression=None), 0, 0
            out.write(member)
            records, size = records + 1, size + len(member)
    if out is not None:
        close()
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(list(zip(*done)) or [[], [], []], (pa.string(), pa.int64(), pa.int64()))],
        ["file", "records", "bytes"],
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> dict[str, int]:
    """Write a record per row of ``pages`` (page_id, url, html) into ``folder``; how much was written.

    Among pages of equal payloads of at least ``min_bytes`` bytes, that with the largest page_id is
    a response and the others revisit it; smaller payloads are responses all. A null html is an
    empty payload, a null url leaves its header out, rows without a page_id never are the one
    referred to unless all of their payload are, and rows that repeat the largest page_id are
    responses as it is. Further columns are ignored; an empty table writes no file.

    ``folder`` is one that all executors reach: ``file:``, ``hdfs:``, ``s3:`` or ``gs:``. The manifest is
    written last. Writing to a folder again replaces what is read from it; one that holds files and
    no manifest is refused.
    """
    ship(pages.sparkSession)
    store, root = fs.FileSystem.from_uri(folder)
    held = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    if held and not any(f.base_name.startswith(MANIFEST) for f in held):
        raise FileExistsError(f"{folder} holds {held[0].base_name} and no manifest")
    store.create_dir(root, recursive=True)
    known = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    digest = F.unhex(F.sha1("payload")).alias("digest")
    large = known.where(F.octet_length("payload") >= min_bytes)
    # The page referred to, for payloads that occur more than once; spread by its partial sums.
    first = (
        large.select(digest, "page_id")
        .groupBy("digest")
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and kept is not null")
        .select(F.col("digest").alias("kept_digest"), "kept")
    )
    key = F.when(F.octet_length("payload") >= min_bytes, digest)
    joined = known.withColumn("digest", key).join(first, F.col("digest") == F.col("kept_digest"), "left")
    revisits = F.coalesce(F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept")), F.lit(False))
    rows = joined.select("page_id", "url", "payload", "kept", revisits.alias("revisits"))
    files = rows.mapInArrow(lambda batches: _write_part(batches, folder, file_bytes), _WRITTEN)
    # Names of manifests are in order of time.
    parts = stage(files, MANIFEST, f"{folder}/{MANIFEST}{time.time_ns():020d}-{uuid.uuid4().hex}")
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("records", "bytes")]
    return parts.agg(F.count("file").alias("files"), *sums).first().asDict()


# --- reading -----------------------------------------------------------------------------------


@dataclass
class ArchiveFile(InputPartition):
    path: str


class _Members:
    """The members of one archive, one after the other, inflated no further than asked for."""

    def __init__(self, source) -> None:
        self._source = source
        self._buffer = b""

    def _fill(self, n: int) -> None:
        while len(self._buffer) < n and (more := self._source.read(max(_CHUNK, n - len(self._buffer)))):
            self._buffer += more

    def _skip(self, n: int) -> None:
        """Step over ``n`` bytes without keeping them."""
        held = min(n, len(self._buffer))
        self._buffer = self._buffer[held:]
        if n > held:
            self._source.seek(self._source.tell() + n - held)

    def __iter__(self) -> Iterator[_Record]:
        while True:
            self._fill(12)
            if not self._buffer:
                return
            length = None
            if self._buffer[3] & 4:
                (extra,) = struct.unpack_from("<H", self._buffer, 10)
                self._fill(12 + extra)
                length = self._length_in(self._buffer[12 : 12 + extra])
            record = _Record(self, length)
            yield record
            record.finish()

    @staticmethod
    def _length_in(field: bytes) -> int | None:
        at = 0
        while at + 4 <= len(field):
            (size,) = struct.unpack_from("<H", field, at + 2)
            if field[at : at + 2] == _SKIP and size == 8:
                return struct.unpack_from("<I", field, at + 4)[0]
            at += 4 + size
        return None


class _Record:
    def __init__(self, members: _Members, length: int | None) -> None:
        self._members, self._length = members, length
        self._inflate = zlib.decompressobj(zlib.MAX_WBITS | 16)
        self._plain, self._used = bytearray(), 0
        self.headers = self._headers()

    def _more(self) -> bool:
        if self._inflate.eof:
            return False
        self._members._fill(1)
        if not self._members._buffer:
            raise EOFError("archive ends inside a record")
        # A record that may be stepped over is inflated in small bites.
        taken = self._members._buffer[:_CHUNK] if self._length is None else self._members._buffer[: 4 * 1024]
        self._plain += self._inflate.decompress(taken)
        unused = len(self._inflate.unused_data)
        self._members._buffer = self._members._buffer[len(taken) - unused :]
        self._used += len(taken) - unused
        return True

    def _headers(self) -> dict[str, str]:
        while (end := self._plain.find(b"\r\n\r\n")) < 0:
            if not self._more():
                raise ValueError("record without headers")
        lines = self._plain[:end].decode("utf-8", "replace").split("\r\n")
        self._start = end + 4
        pairs = (line.partition(":") for line in lines[1:])
        return {name.strip().lower(): value.strip() for name, _, value in pairs}

    def block(self) -> bytes:
        """All of the record's content."""
        need = self._start + int(self.headers.get("content-length", 0))
        while len(self._plain) < need and self._more():
            pass
        return bytes(self._plain[self._start : need])

    def http_head(self) -> tuple[dict[str, str], int]:
        """Headers of the answer in the block, and where its payload starts in the block."""
        if not self.headers.get("content-type", "").startswith("application/http"):
            return {}, 0
        while (end := self._plain.find(b"\r\n\r\n", self._start)) < 0:
            if not self._more():
                return {}, 0
        lines = self._plain[self._start : end].decode("latin-1").split("\r\n")
        pairs = (line.partition(":") for line in lines[1:])
        return {name.strip().lower(): value.strip() for name, _, value in pairs}, end + 4 - self._start

    def finish(self) -> None:
        if not self._inflate.eof and self._length is not None:
            self._members._skip(self._length - self._used)
            return
        while self._more():
            self._plain.clear()


class _PlainRecord:
    """A record of a stream that is read from start to end; ``finish`` steps to the next one."""

    def __init__(self, source, head: bytes) -> None:
        self._source, self._block = source, b""
        lines = head.decode("utf-8", "replace").split("\r\n")
        pairs = (line.partition(":") for line in lines[1:])
        self.headers = {name.strip().lower(): value.strip() for name, _, value in pairs}
        self._length = int(self.headers.get("content-length", 0))

    def _fill(self, n: int) -> None:
        while len(self._block) < n:
            more = self._source.read(min(_CHUNK, n - len(self._block)))
            if not more:
                raise EOFError("archive ends inside a record")
            self._block += more

    def block(self) -> bytes:
        pieces, n = [self._block], len(self._block)
        while n < self._length:
            pieces.append(self._source.read(min(4 * 1024 * 1024, self._length - n)))
            if not pieces[-1]:
                raise EOFError("archive ends inside a record")
            n += len(pieces[-1])
        self._block = b"".join(pieces)
        return self._block

    def http_head(self) -> tuple[dict[str, str], int]:
        if not self.headers.get("content-type", "").startswith("application/http"):
            return {}, 0
        while (end := self._block.find(b"\r\n\r\n")) < 0:
            if len(self._block) >= self._length:
                return {}, 0
            self._fill(min(self._length, len(self._block) + 4096))
        lines = self._block[:end].decode("latin-1").split("\r\n")
        pairs = (line.partition(":") for line in lines[1:])
        return {name.strip().lower(): value.strip() for name, _, value in pairs}, end + 4

    def finish(self) -> None:
        left = self._length - len(self._block)
        while left > 0:
            skipped = len(self._source.read(min(4 * 1024 * 1024, left)))
            if not skipped:
                raise EOFError("archive ends inside a record")
            left -= skipped


class _Stream:
    """Lines and bytes of a source, read in chunks."""

    def __init__(self, source) -> None:
        self._source, self._held = source, b""

    def readline(self) -> bytes:
        while (end := self._held.find(b"\n")) < 0 and (more := self._source.read(_CHUNK)):
            self._held += more
        end = len(self._held) if end < 0 else end + 1
        line, self._held = self._held[:end], self._held[end:]
        return line

    def read(self, n: int) -> bytes:
        if not self._held:
            return self._source.read(n)
        found, self._held = self._held[:n], self._held[n:]
        return found


def _plain_records(stream) -> Iterator[_PlainRecord]:
    """The records of a stream without lengths of members: a plain archive, or one that is inflated."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        head = [line]
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            head.append(line)
        record = _PlainRecord(stream, b"".join(head).replace(b"\r\n", b"\n").replace(b"\n", b"\r\n"))
        yield record
        record.finish()


def _records_of(source, path: str):
    """The records of an open archive, of whatever form it is."""
    if path.endswith(PLAIN_SUFFIX):
        return _plain_records(_Stream(source))
    start = source.read(_CHUNK)
    source.seek(0)
    if len(start) > 12 and start[3] & 4:
        (extra,) = struct.unpack_from("<H", start, 10)
        if _Members._length_in(start[12 : 12 + extra]) is not None:
            return _Members(source)
    return _plain_records(_Stream(gzip.GzipFile(fileobj=source)))


def archive_files(folder: str) -> list[str]:
    """The archives that a folder stands for: those of its last manifest, or else all below it.

    Without a manifest, files that are no archives are named by an error; hidden ones are passed over.
    """
    store, root = fs.FileSystem.from_uri(folder)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    manifests = sorted(f.path for f in found if f.base_name.startswith(MANIFEST))
    # One without this mark was not finished.
    whole = [m for m in manifests if store.get_file_info(f"{m}/_SUCCESS").type == fs.FileType.File]
    if whole:
        return sorted(pq.read_table(whole[-1], filesystem=store, columns=["file"])["file"].to_pylist())
    if manifests:
        raise ValueError(f"{folder} was written to, but not to the end")
    below = store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
    files = [f.path for f in below if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))]
    odd = [path for path in files if not path.endswith((SUFFIX, PLAIN_SUFFIX))]
    if odd:
        raise ValueError(f"no archives: {sorted(odd)[:5]}")
    return sorted(files)


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options) -> None:
        self._columns = schema.names
        self._path = options["path"]
        self._wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        """Equality and membership of header fields are decided from the headers alone."""
        for each in filters:
            name = each.attribute[0] if len(each.attribute) == 1 else None
            if isinstance(each, (EqualTo, In)) and name in _HEADER_OF:
                values = {each.value} if isinstance(each, EqualTo) else set(each.value)
                self._wanted[name] = self._wanted.get(name, values) & values
            else:
                yield each

    def partitions(self):
        return [ArchiveFile(name) for name in archive_files(self._path)] or [ArchiveFile("")]

    def read(self, partition):
        if not partition.path:
            return
        store, _ = fs.FileSystem.from_uri(self._path)
        rows, held = [], 0
        with store.open_input_file(partition.path) as source:
            for record in _records_of(source, partition.path):
                row = self._row(record)
                if row is None:
                    continue
                rows.append(row)
                held += 200 + len(row.get("payload") or b"")
                if held > _BATCH_BYTES:
                    yield self._batch(rows)
                    rows, held = [], 0
        yield self._batch(rows)

    def _row(self, record: _Record) -> dict | None:
        row = {name: record.headers.get(field) for name, field in _HEADER_OF.items()}
        digest = row["payload_digest"]
        row["payload_digest"] = digest.removeprefix("sha1:") if digest else digest
        if any(row[name] not in values for name, values in self._wanted.items()):
            return None
        if "payload_bytes" in self._columns or "payload" in self._columns:
            http, start = record.http_head()
            length = http.get("content-length") or int(record.headers.get("content-length", 0)) - start
            row["payload_bytes"] = int(length)
            if "payload" in self._columns and row["record_type"] != "revisit":
                row["payload"] = record.block()[start:]
        return row

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        types = {"payload_bytes": pa.int64(), "payload": pa.binary()}
        columns = [pa.array([r.get(c) for r in rows], types.get(c, pa.string())) for c in self._columns]
        return pa.RecordBatch.from_arrays(columns, self._columns)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; a schema without ``payload`` reads headers only."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)


def read_archives(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    """The records under ``folder``; name the ``columns`` to leave payloads packed.

    Turns on the session's filter pushdown for Python sources, so that conditions on record type and
    header fields reach the reader.
    """
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    reader = spark.read.format("warc")
    if columns is not None:
        kinds = dict(part.split(" ") for part in SCHEMA.split(", "))
        reader = reader.schema(", ".join(f"{c} {kinds[c]}" for c in columns))
    return reader.load(folder)


def base32_of_hex(digest: Column) -> Column:
    """A hex SHA-1 in upper-case base32: five hex digits are four base32 digits."""
    groups = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
