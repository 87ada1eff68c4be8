"""WARC archives as a Python data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans partitions over files, pushes conditions on the record type, the target and other named headers down to
the reader, parses the header of a record first and steps over the payload of a record that is not wanted. Payloads
are stored gzip-coded inside the record block, so that headers stay in the clear and a payload is skipped by its
length alone. Archives of others are read as well: plain or gzip-coded payloads, ``.warc`` and ``.warc.gz`` files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from watchtide.llm.words import bounded_batches
from watchtide.storage import stored, work_folder

SCHEMA = (
    "record_id string, record_type string, target_uri string, payload_digest string, payload_bytes bigint, "
    "refers_to string, payload binary"
)
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
_ARROW = {c: {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[k] for c, k in map(str.split, SCHEMA.split(", "))}
#: What a row takes beside its payload, roughly.
_ROW_BYTES = 512

#: Fixed values of the format.
_VERSION = b"WARC/1.1\r\n"
_DATE = "1970-01-01T00:00:00Z"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
#: An extension header: the length of the payload when decoded, which a revisit does not carry.
_LENGTH = "X-Payload-Length"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(value: str) -> str:
    """A header value on one line: control characters are percent-coded."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}" if m[0] != "%" else "%", value)


def _record(row: dict) -> bytes:
    """One record; ``response`` with its payload, ``revisit`` without."""
    revisit = row["record_type"] == "revisit"
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8"]
    body = b""
    if not revisit:
        body = gzip.compress(row["payload"] or b"", 1, mtime=0)
        http += [b"Content-Encoding: gzip", b"Content-Length: " + str(len(body)).encode()]
    block = b"\r\n".join(http) + b"\r\n\r\n" + body
    headers = [("WARC-Date", _DATE)]
    for column, name in _HEADERS.items():
        value = row[column]
        if value is not None:
            value = f"<{value}>" if column in ("record_id", "refers_to") else f"sha1:{value}" if column == "payload_digest" else value
            headers.append((name, _safe(value)))
    if revisit:
        headers.append(("WARC-Profile", _REVISIT_PROFILE))
    headers += [(_LENGTH, str(row["payload_bytes"])), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    return _VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def _system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Writes each task's records to files of its own, which get their names when the whole write has succeeded."""

    def __init__(self, path: str, file_bytes: int) -> None:
        self.path, self.file_bytes, self.job = path, file_bytes, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, root = _system(self.path)
        system.create_dir(f"{root}/_{self.job}", recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        files.append(f"part-{uuid.uuid4().hex}.warc")
                        out, size = system.open_output_stream(f"{root}/_{self.job}/{files[-1]}"), 0
                    data = _record(row)
                    out.write(data)
                    size += len(data)
                    if size >= self.file_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        system, root = _system(self.path)
        system.create_dir(root, recursive=True)
        for message in messages:
            for name in message.files if message else []:
                system.move(f"{root}/_{self.job}/{name}", f"{root}/{name}")
        self._drop(system, root)

    def abort(self, messages: list[_Written | None]) -> None:
        self._drop(*_system(self.path))

    def _drop(self, system: fs.FileSystem, root: str) -> None:
        if system.get_file_info(f"{root}/_{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/_{self.job}")


@dataclass
class _Files(InputPartition):
    names: list[str]


def _head(stream) -> dict[str, str] | None:
    """Headers of the next record, names in lower case; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:60]!r}")
    headers: dict[str, str] = {}
    name = None
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and name:
            headers[name] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            headers[name] = value.strip()
    return headers


def _payload(block: bytes, headers: dict[str, str]) -> bytes:
    """The decoded payload of a record block; of one without HTTP headers the whole block."""
    if "application/http" not in headers.get("content-type", ""):
        return block
    head, _, body = block.partition(b"\r\n\r\n")
    if re.search(rb"(?im)^content-encoding:\s*gzip\s*$", head.replace(b"\r", b"")) and body:
        return zlib.decompress(body, 31)
    return body


class WarcReader(DataSourceReader):
    """Reads the records that pass the pushed conditions, and decodes payloads only if the schema has them."""

    def __init__(self, path: str, columns: list[str], split_bytes: int, batch_bytes: int = 4 << 20) -> None:
        self.path, self.columns, self.split_bytes, self.batch_bytes = path, columns, split_bytes, batch_bytes
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column in _HEADERS and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            elif not (column in _HEADERS and isinstance(f, IsNotNull) and column == "record_type"):
                yield f

    def partitions(self) -> list[_Files]:
        """Files in groups of about ``split_bytes``; a file is never divided, the writer bounds its size."""
        system, root = _system(self.path)
        found = sorted((i.path, i.size or 0) for i in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.type == fs.FileType.File and re.search(r"\.warc(\.gz)?$", i.path))
        groups, size = [[]], 0
        for name, length in found:
            if groups[-1] and size + length > self.split_bytes:
                groups.append([])
                size = 0
            groups[-1].append(name)
            size += length
        return [_Files(g) for g in groups]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch] | Iterator[tuple]:
        """Rows of headers as they come; with payloads in Arrow batches, since Spark bounds its own by rows alone."""
        if "payload" in self.columns:
            yield from self._batches(partition)
        else:
            yield from (tuple(row[c] for c in self.columns) for row in self._rows(partition))

    def _batches(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        """Batches that end at ``batch_bytes`` of payloads, so that a worker holds no more than that and a record."""
        rows, size = [], 0
        for row in self._rows(partition):
            rows.append(row)
            size += _ROW_BYTES + len(row["payload"] or b"")
            if size >= self.batch_bytes:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], _ARROW[c]) for c in self.columns], names=self.columns)

    def _rows(self, partition: _Files) -> Iterator[dict]:
        system, _ = _system(self.path)
        for name in partition.names:
            if name.endswith(".gz"):
                with system.open_input_stream(name, compression=None) as raw, gzip.open(raw) as stream:
                    yield from self._records(io.BufferedReader(stream))
            else:
                with system.open_input_file(name) as raw:
                    yield from self._records(io.BufferedReader(raw, 1 << 16))

    def _records(self, stream: io.BufferedReader) -> Iterator[dict]:
        while (headers := _head(stream)) is not None:
            length = int(headers.get("content-length", 0))
            row = {c: headers.get(n.lower()) for c, n in _HEADERS.items()}
            row |= {c: row[c].strip("<>") for c in ("record_id", "refers_to") if row[c]}
            if row["payload_digest"]:
                row["payload_digest"] = row["payload_digest"].rpartition(":")[2]
            if any(row[c] not in values for c, values in self.wanted.items()):
                stream.seek(length, io.SEEK_CUR)
                continue
            known = headers.get(_LENGTH.lower())
            row["payload_bytes"] = int(known) if known else None
            row["payload"] = None
            if row["record_type"] != "revisit" and ("payload" in self.columns or known is None and "payload_bytes" in self.columns):
                row["payload"] = _payload(stream.read(length), headers)
                row["payload_bytes"] = len(row["payload"])
                if row["payload_digest"] and row["payload_digest"] != _digest(row["payload"]):
                    raise ValueError(f"payload of {row['record_id']} does not have its digest")
            else:
                stream.seek(length, io.SEEK_CUR)
            yield row


class WarcSource(DataSource):
    """Options: ``path``, ``file_bytes`` (a file ends beyond it), ``split_bytes`` (files of a read task) and
    ``batch_bytes`` (payloads that a reader holds)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema.fieldNames(), int(self.options.get("split_bytes", 64 << 20)), int(self.options.get("batch_bytes", 4 << 20)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("file_bytes", 64 << 20)))


def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets it push filters down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The records below ``path``; columns that are not asked for are not decoded."""
    register(spark)
    kinds = dict(c.split() for c in SCHEMA.split(", "))
    return spark.read.format("warc").schema(", ".join(f"{c} {kinds[c]}" for c in columns or _COLUMNS)).load(path)


def records(pages: DataFrame, id: str = "page_id", url: str = "url", body: str = "html", least: int = 0) -> DataFrame:
    """One record per page in the columns of ``SCHEMA``.

    Of equal payloads of at least ``least`` bytes the page of the greatest id is the ``response``, the others are
    ``revisit`` records that refer to it; rows that repeat that id are responses each. Null bodies are empty payloads.
    A page without an id is a revisit where a page with an id has its payload, else a response. Null urls have no
    target. Other columns are not read.
    """
    rows = pages.select(pages[id].alias("id"), pages[url].alias("target_uri"), F.coalesce(pages[body], F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"sha1": F.unhex(F.sha1("payload")), "payload_bytes": F.octet_length("payload").cast("bigint")})
    first = stored(rows.filter(F.col("payload_bytes") >= least).groupBy("sha1").agg(F.max("id").alias("first"), F.count("*").alias("pages")).filter("pages > 1").drop("pages"), "payloads")
    joined = rows.join(first, "sha1", "left").withColumn("again", F.col("first").isNotNull() & (F.col("payload_bytes") >= least) & ~F.col("id").eqNullSafe(F.col("first")))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return joined.select(
        name("id").alias("record_id"),
        F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        _base32(F.col("sha1")).alias("payload_digest"),
        "payload_bytes",
        F.when(F.col("again"), name("first")).alias("refers_to"),
        F.when(~F.col("again"), F.col("payload")).alias("payload"),
    )


def _base32(sha1):
    """Base32 of 20 bytes: 32 digits of five bits."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(F.hex(sha1), 5 * i + 1, 5), 16, 2), 20, "0") for i in range(8)])
    digit = lambda i: F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.conv(F.substring(bits, 5 * i + 1, 5), 2, 10).cast("int") + 1, F.lit(1))
    return F.concat(*[digit(i) for i in range(32)])


def archive(pages: DataFrame, path: str | None = None, **names) -> str:
    """Writes the pages as WARC files and returns their folder."""
    spark = pages.sparkSession
    register(spark)
    bounded_batches(spark)
    path = path or work_folder(spark, "warc")
    records(pages, **names).write.format("warc").mode("append").save(path)
    return path
