"""WARC archives of pages, compressed record by record with a shared dictionary.

An archive (``.warc.zst``) starts with a skippable frame that holds a Zstandard
dictionary, built from the first records that the archive will hold.  Every record
is a frame of its own, compressed with the dictionary, so that single records can
be read.  Pages whose payload another page has too are written as revisits of it.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.session import materialized

# The frame that carries a dictionary, and the profile of a revisit.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads from this size on are stored once.
REVISIT_BYTES = 100
#: Bytes of records that are held to build an archive's dictionary, and the dictionary's size.
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
#: Bytes of records after which a task begins another archive.
ARCHIVE_BYTES = 1 << 30
LEVEL = 3
DATE = datetime(2024, 1, 1, tzinfo=timezone.utc)

_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}')}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: datetime = DATE) -> bytes:
    """A response record, or a revisit of page ``first``."""
    revisit = first is not None and first != page_id
    kind = "revisit" if revisit else "response"
    headers = [
        ("WARC-Record-ID", _record_id(page_id, digest if not revisit else f"{digest}/revisit")),
        ("WARC-Date", date.strftime("%Y-%m-%dT%H:%M:%SZ")),
        ("WARC-Target-URI", quote(url, safe="%:/?#[]@!$&'()*+,;=~") if url else "urn:unknown"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(first, digest)), ("X-Refers-To-Page-Id", str(first))]
    return _record(kind, headers, _HTTP % len(payload) + (b"" if revisit else payload))


class ArchiveWriter:
    """One archive: records are held until a dictionary can be built, then written as they come."""

    def __init__(self, path: str):
        self.path, self.records, self.size = path, 0, 0
        self._system, self._place = _file_system(path)
        self._held: list[bytes] = []
        self._out = self._system.open_output_stream(f"{self._place}.open", compression=None)
        self._compressor: zstandard.ZstdCompressor | None = None
        self.add(_record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE.strftime("%Y-%m-%dT%H:%M:%SZ")),
                                      ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self.records = 0

    def add(self, record: bytes) -> None:
        self.records += 1
        self.size += len(record)
        if self._compressor is not None:
            self._out.write(self._compressor.compress(record))
            return
        self._held.append(record)
        if self.size >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        content = _dictionary(self._held)
        self._out.write(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)
        self._compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_checksum=True)
        for record in self._held:
            self._out.write(self._compressor.compress(record))
        self._held = []

    def close(self) -> None:
        """Finish the archive and give it its name; before, readers don't see it."""
        if self._compressor is None:
            self._begin()
        self._out.close()
        self._system.move(f"{self._place}.open", self._place)


def _dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on the records, or their bytes where there are too few to train on."""
    samples = [r[: 1 << 16] for r in records]
    if len(samples) >= 16 and sum(map(len, samples)) >= 8 * DICTIONARY_BYTES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
        except zstandard.ZstdError:  # samples without enough in common
            pass
    return b"".join(records)[:DICTIONARY_BYTES]


def read_archive(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """The headers and blocks of an archive's records, one after another."""
    system, place = _file_system(path)
    with system.open_input_stream(place, compression=None) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{path} does not start with a dictionary")
        context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(source.read(size)))
        waiting = b""
        while True:
            waiting = waiting or source.read(1 << 16)
            if not waiting:
                return
            frame, out = context.decompressobj(), []
            while not frame.eof:
                if not waiting and not (waiting := source.read(1 << 16)):
                    raise EOFError(f"{path} ends inside a record")
                out.append(frame.decompress(waiting))
                waiting = frame.unused_data if frame.eof else b""
            yield _parsed(b"".join(out))


def _parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    return headers, body[: int(headers["Content-Length"])]


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of ``pages`` (``page_id, url, html``) in ``folder``; gives the table of them: ``path, records``.

    A null html is an empty payload.  Of equal payloads of at least 100 bytes the
    page with the smallest id is stored, rows that repeat it too; null ids are never
    revisited, and pages revisit whichever id is smallest.  An archive counts only
    once the table names it, so what a lost or repeated task leaves is never read.
    ``folder`` must be shared: a path that pyarrow's file systems know (file, hdfs, s3, gs).
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    stored = (
        rows.filter(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    rows = rows.join(materialized(stored, "payloads"), "digest", "left").select("page_id", "url", "payload", "digest", "first")
    _create(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, data, digest, first = (column[at].as_py() for column in batch.columns)
                if archive is None:
                    archive = ArchiveWriter(f"{folder}/pages-{uuid.uuid4().hex}.warc.zst")
                archive.add(page_record(page_id, url, data, digest, first))
                if archive.size >= archive_bytes:
                    yield _written(archive)
                    archive = None
        if archive is not None:
            yield _written(archive)

    return materialized(rows.mapInArrow(write, "path string, records long"), "archives")


def _written(archive: ArchiveWriter) -> pa.RecordBatch:
    archive.close()
    return pa.record_batch([pa.array([archive.path]), pa.array([archive.records], pa.int64())], ["path", "records"])


def _create(folder: str) -> None:
    system, place = _file_system(folder)
    system.create_dir(place, recursive=True)


_READ = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("target_uri", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The page records of the archives named in ``path``, an archive per task at most.

    Digests of stored payloads are computed anew and must agree with the headers.
    ``payload`` is null for revisits, and for all without ``payloads``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for headers, block in read_archive(path):
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    row = _page(headers, block)
                    held += len(block)
                    rows.append(row if payloads else row | {"payload": None})
                    if len(rows) >= 1000 or held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _READ)

    paths = archives.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(
        read,
        "record_id string, record_type string, page_id long, target_uri string, payload_bytes long, payload_digest string, refers_to long, payload binary",
    )


def _page(headers: dict[str, str], block: bytes) -> dict:
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"record {headers['WARC-Record-ID']} does not have the payload that its digest names")
    number = lambda name: int(headers[name]) if name in headers else None
    return {
        "record_id": headers["WARC-Record-ID"], "record_type": kind, "page_id": number("X-Page-Id"), "target_uri": headers["WARC-Target-URI"],
        "payload_bytes": len(payload) if payload is not None else number("X-Payload-Length"), "payload_digest": digest,
        "refers_to": number("X-Refers-To-Page-Id"), "payload": payload,
    }
