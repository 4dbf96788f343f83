"""WARC archives compressed with Zstandard: one frame per record, a dictionary in front.

An archive is a leading skippable frame that holds the dictionary, then one Zstandard frame
for each record. Without a dictionary the leading frame is absent.

Writing (``write_archives``): payloads are compared by SHA-256 and length, in one narrow
aggregation. Of equal payloads the smallest page_id is written as a response, the others as
revisits, whose block keeps the HTTP header (and so the length) and refers to the response's
record. Each task trains the dictionary on the first records of an archive
(``SAMPLE_BYTES``, a bound that touches the ratio of compression only) and starts another
archive beyond ``ARCHIVE_BYTES``, so a task holds a sample and one record at a time. Archives
are named at random and told to the reader by a committed table: a task that is run again
writes archives of its own, and those of lost attempts are never read.

Reading (``read_archives``): one task an archive streams it, loads the dictionary, decodes
frame by frame, and checks the version line, the required header fields, that a frame holds
exactly one record of the stated length, the HTTP header's length, and the digests. A frame
that fails is a row with ``problem``; where frames cannot be told apart any more, the rest of
the archive is one such row.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pa_fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annofold.llm._shared import batches, broadcast_if_small, durable, row_mark, shared_folder, tidy, utf8_column

# Fixed values of the formats: magic numbers, profile, required fields.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
#: Payload bytes of the first records on which an archive's dictionary is trained, and its size.
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 1 << 15
#: Compressed bytes after which a task starts another archive.
ARCHIVE_BYTES = 1 << 30
#: Bytes that are read at once.
CHUNK = 1 << 18
#: Compression level.
LEVEL = 3
#: Date of records whose capture has none.
UNDATED = "1970-01-01T00:00:00Z"


class BadArchive(ValueError):
    """What an archive or a record lacks."""


def base32_sha1(content: bytes) -> str:
    return base64.b32encode(hashlib.sha1(content).digest()).decode()


def _open(path: str, mode: str) -> BinaryIO:
    path = re.sub(r"^file:/+", "/", path)
    if re.match(r"[a-z0-9]+:/", path):
        store, inner = pa_fs.FileSystem.from_uri(quote(path, safe=":/%?=&@"))
    else:
        store, inner = pa_fs.LocalFileSystem(), os.path.abspath(path)
    if mode == "r":
        return store.open_input_stream(inner, compression=None)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(inner, compression=None)


# --- records ---------------------------------------------------------------------------------


def _field(text: str) -> str:
    """A header value: what could end the line is percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_id(page: int | None, digest: str, *more: object) -> str:
    """A record's name; without ``more`` that of the response with this payload."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, (page, digest, *more))))}>"


def build_record(page: int | None, url: str | None, payload: bytes, own_id: str, refers_to: str | None, date: str = UNDATED) -> bytes:
    """A response, or a revisit where ``refers_to`` names the response of the same payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to else head + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", own_id),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else _field(url)),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("WARC-Profile", PROFILE if refers_to else None),
        ("WARC-Refers-To", refers_to),
        ("X-Page-ID", None if page is None else str(page)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in fields if value is not None)]
    return b"\r\n".join([*lines, b"", block, b"", b""])


def _header_fields(lines: list[bytes]) -> dict[str, str]:
    """Fields by lower-case name; a line that begins with a blank goes on the one before."""
    out: dict[str, str] = {}
    last = ""
    for line in lines:
        if line[:1] in (b" ", b"\t") and last:
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise BadArchive(f"not a header field: {line[:60]!r}")
        last = name.decode().lower()
        out[last] = value.strip().decode("utf-8", "replace")
    return out


def _length(fields: dict[str, str], name: str) -> int:
    if not re.fullmatch(r"[0-9]+", fields[name]):
        raise BadArchive(f"{name} is {fields[name][:40]!r}")
    return int(fields[name])


def parse_record(content: bytes) -> dict:
    """Fields and payload of the one record that ``content`` must be; ``BadArchive`` says what is wrong.

    ``payload`` is the HTTP body of responses, and None of other records; ``payload_bytes``
    is the length of the body, of a revisit the one that its HTTP header states.
    """
    head, end, rest = content.partition(b"\r\n\r\n")
    if not end:
        raise BadArchive("no end of the header")
    first, *lines = head.split(b"\r\n")
    if first not in VERSIONS:
        raise BadArchive(f"version line {first[:40]!r}")
    fields = _header_fields(lines)
    if lacking := [name for name in REQUIRED if not fields.get(name)]:
        raise BadArchive(f"no {', '.join(lacking)}")
    size = _length(fields, "content-length")
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadArchive(f"stated length {size}, and {len(rest)} bytes after the header")
    block = rest[:size]
    _check_digest(fields, "warc-block-digest", block)
    out = {"type": fields["warc-type"], "fields": fields, "payload": None, "payload_bytes": None}
    if fields["warc-type"] in ("response", "revisit") and fields.get("content-type", "").startswith("application/http"):
        http_head, end, body = block.partition(b"\r\n\r\n")
        if not end or not http_head.startswith(b"HTTP/"):
            raise BadArchive("no HTTP header")
        http = _header_fields(http_head.split(b"\r\n")[1:])
        stated = _length(http, "content-length") if "content-length" in http else None
        if fields["warc-type"] == "response":
            if stated not in (None, len(body)):
                raise BadArchive(f"HTTP length {stated}, and {len(body)} bytes of body")
            _check_digest(fields, "warc-payload-digest", body)
            out |= {"payload": body, "payload_bytes": len(body)}
        else:
            out["payload_bytes"] = stated
    if fields["warc-type"] == "revisit" and not fields.get("warc-refers-to"):
        raise BadArchive("a revisit without warc-refers-to")
    return out


def _check_digest(fields: dict[str, str], name: str, content: bytes) -> None:
    stated = fields.get(name, "")
    if stated.lower().startswith("sha1:") and stated[5:].upper() != base32_sha1(content):
        raise BadArchive(f"{name} does not fit")


# --- archives --------------------------------------------------------------------------------


def train_dictionary(samples: list[bytes]) -> bytes | None:
    """A dictionary for records like ``samples``; None where they are too few or too small."""
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 10)
    if len(samples) < 16 or size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return None


def dictionary_frame(dictionary: bytes) -> bytes:
    """The leading skippable frame: the dictionary, itself compressed."""
    content = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(content)) + content


class ArchiveWriter:
    """Writes records to one archive; the dictionary is trained on the first ones."""

    def __init__(self, out: BinaryIO, sample_bytes: int = SAMPLE_BYTES) -> None:
        self._out, self._sample = out, sample_bytes
        self._waiting: list[bytes] | None = []
        self._held = 0
        self._compressor: zstandard.ZstdCompressor | None = None
        self.records = self.bytes = 0

    def add(self, record: bytes) -> None:
        self.records += 1
        if self._waiting is None:
            self._put(self._compressor.compress(record))
            return
        self._waiting.append(record)
        self._held += len(record)
        if self._held >= self._sample:
            self._begin()

    def _put(self, content: bytes) -> None:
        self._out.write(content)
        self.bytes += len(content)

    def _begin(self) -> None:
        trained = train_dictionary([r[:CHUNK] for r in self._waiting])
        options = {"level": LEVEL, "write_checksum": True, "write_content_size": True}
        if trained:
            options["dict_data"] = zstandard.ZstdCompressionDict(trained)
            self._put(dictionary_frame(trained))
        self._compressor = zstandard.ZstdCompressor(**options)
        for record in self._waiting:
            self._put(self._compressor.compress(record))
        self._waiting = None

    def close(self) -> None:
        if self._waiting is not None:
            self._begin()
        self._out.close()


def _leading_dictionary(source: BinaryIO) -> tuple[zstandard.ZstdCompressionDict | None, bytes]:
    """The dictionary of the leading skippable frame, if there is one, and bytes read beyond it."""
    start = source.read(8)
    if len(start) < 8 or struct.unpack("<I", start[:4])[0] != SKIPPABLE:
        return None, start
    size = struct.unpack("<I", start[4:])[0]
    content = source.read(size)
    if len(content) < size:
        raise BadArchive("the dictionary's frame is cut off")
    if content[:4] == FRAME:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return zstandard.ZstdCompressionDict(content), b""


def frames(source: BinaryIO) -> Iterator[tuple[int, bytes]]:
    """(number, content) of each Zstandard frame of an archive, one held at a time.

    Skippable frames between records are passed over. Raises ``BadArchive`` where the stream
    ends inside a frame or holds no frame, and ``zstandard.ZstdError`` where one is damaged.
    """
    dictionary, rest = _leading_dictionary(source)
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    number = 0
    while True:
        while len(rest) < 8 and (more := source.read(CHUNK)):
            rest += more
        if not rest:
            return
        if rest[:4] != FRAME:
            magic, size = struct.unpack("<II", rest[:8]) if len(rest) >= 8 else (0, 0)
            if magic >> 4 != SKIPPABLE >> 4:
                raise BadArchive("neither a frame nor a skippable frame")
            rest = rest[8:]
            while len(rest) < size and (more := source.read(min(CHUNK, size - len(rest)))):
                size, rest = size - len(rest), more
            if len(rest) < size:
                raise BadArchive("a skippable frame is cut off")
            rest = rest[size:]
            continue
        frame, parts = decoder.decompressobj(), []
        while True:
            parts.append(frame.decompress(rest))
            if frame.eof:
                rest = frame.unused_data
                break
            rest = source.read(CHUNK)
            if not rest:
                raise BadArchive("the last frame is cut off")
        yield number, b"".join(parts)
        number += 1


# --- Spark -----------------------------------------------------------------------------------

_MANIFEST = "path string, records long, bytes long"
RECORD_DDL = (
    "path string, frame long, record_type string, record_id string, target_uri string, date string, page_id long, "
    "payload_digest string, payload_bytes long, refers_to_id string, payload binary, problem string"
)
_RECORD = pa.schema(
    [
        ("path", pa.string()),
        ("frame", pa.int64()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("target_uri", pa.string()),
        ("date", pa.string()),
        ("page_id", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("refers_to_id", pa.string()),
        ("payload", pa.binary()),
        ("problem", pa.string()),
    ]
)


def with_first_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, html, first_page, revisit): whether an equal payload of another row is written instead.

    Payloads of fewer than ``least`` bytes are never revisits. Only page ids and digests are
    shuffled; payloads stay where they are unless repeated payloads are too many to broadcast.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.when(F.octet_length(html) >= least, F.unhex(F.sha2(html, 256))).alias("key"),
    )
    counts = durable(keyed.filter("key IS NOT NULL").groupBy("page_id", "key").agg(F.count(F.lit(1)).alias("times")))
    # One row a payload with copies: the smallest page_id, rows without one last.
    copies = counts.groupBy("key").agg(F.sum("times").alias("times"), F.min("page_id").alias("first_page")).filter("times > 1")
    copies = broadcast_if_small(copies.select(F.col("key").alias("copy_key"), "first_page"))
    has_copies, is_first = F.col("key") == F.col("copy_key"), F.col("page_id").eqNullSafe(F.col("first_page"))
    if counts.filter("times > 1").isEmpty():
        found = keyed.join(copies, has_copies, "left")
    else:
        # Equal pages with equal ids: only a mark of their own tells which of them is the response.
        marked = durable(keyed.withColumn("mark", row_mark()))
        own = marked.join(copies, has_copies & is_first).groupBy(F.col("key").alias("own_key")).agg(F.min("mark").alias("own_mark"))
        found = marked.join(copies, has_copies, "left").join(broadcast_if_small(own), F.col("key") == F.col("own_key"), "left")
        is_first = F.col("mark") == F.col("own_mark")
    return found.select("page_id", "url", "html", "first_page", (F.col("copy_key").isNotNull() & ~is_first).alias("revisit"))


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0, archive_bytes: int = ARCHIVE_BYTES, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in ``folder``; returns (path, records, bytes) of each.

    ``folder`` is a place that driver and executors share and Arrow can write, by default one
    under ``spark.checkpoint.dir``. A null html is an empty payload; a null url has no
    target; control characters and blanks of a url are percent-encoded. Of records with equal
    payloads of at least ``least`` bytes that with the smallest page_id is the response; a
    null page_id comes last, and of rows equal in both one is the response. An empty table
    gives no archives. Columns beside the three are not read.
    """
    spark = pages.sparkSession
    target = (folder or shared_folder(spark)).rstrip("/")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, path, done = None, "", []
        for batch in it:
            ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            firsts, revisits = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for page, url, payload, first, revisit in zip(ids, urls, utf8_column(batch, 2), firsts, revisits, strict=True):
                if writer is None:
                    path = f"{target}/pages-{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(_open(path, "w"), sample_bytes)
                digest = base32_sha1(payload)
                if revisit:
                    record = build_record(page, url, payload, record_id(page, digest, path, writer.records), record_id(first, digest))
                else:
                    record = build_record(page, url, payload, _own_id(page, digest, payload, least, path, writer.records), None)
                writer.add(record)
                if writer.bytes >= archive_bytes:
                    writer.close()
                    done.append((path, writer.records, writer.bytes))
                    writer = None
        if writer is not None:
            writer.close()
            done.append((path, writer.records, writer.bytes))
        yield from batches(done, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return durable(with_first_pages(pages, least).mapInArrow(tidy(run), _MANIFEST))


def _own_id(page: int | None, digest: str, payload: bytes, least: int, path: str, at: int) -> str:
    """A response's name: by page and payload where revisits may refer to it, else by its place."""
    return record_id(page, digest) if len(payload) >= least else record_id(page, digest, path, at)


def archive_files(spark, path: str) -> DataFrame:
    """(path) of the archives below a folder or glob, listed by Spark without reading them."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true").load(path)
    return found.select("path")


def _rows(path: str) -> Iterator[tuple]:
    number = -1
    try:
        with _open(path, "r") as source:
            for number, content in frames(source):
                try:
                    r = parse_record(content)
                except BadArchive as bad:
                    yield (path, number, *[None] * 9, str(bad))
                    continue
                f = r["fields"]
                page = f.get("x-page-id")
                digest = f.get("warc-payload-digest", "")
                yield (
                    path, number, r["type"], f["warc-record-id"], f.get("warc-target-uri"), f["warc-date"],
                    int(page) if page and re.fullmatch(r"-?[0-9]+", page) else None,
                    digest[5:] if digest.lower().startswith("sha1:") else None,
                    r["payload_bytes"], f.get("warc-refers-to"), r["payload"], None,
                )
    except (BadArchive, zstandard.ZstdError) as bad:
        yield (path, number + 1, *[None] * 9, str(bad))


def read_archives(files: DataFrame) -> DataFrame:
    """Records of the archives that ``files`` (path, ...) names, as ``RECORD_DDL``, one task an archive.

    Each frame is one row, in a place of the archive that ``frame`` counts from 0; ``problem``
    is null where the record is whole and says otherwise what is wrong, with the other columns
    null. Unknown record types have no payload. An empty archive, and an empty table, give no
    rows; repeated paths are read as often as they stand there.
    """
    spark = files.sparkSession
    paths = durable(files.select(F.col("path").cast("string").alias("path")).filter("path IS NOT NULL"))
    n = paths.count()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path in batch.column(0).to_pylist():
                # Few rows a batch: each may hold a large payload.
                yield from batches(_rows(path), _RECORD, 64)

    return paths.repartition(max(1, n)).mapInArrow(tidy(run), RECORD_DDL)


def with_referred(records: DataFrame) -> DataFrame:
    """``records`` with refers_to, the page_id of the response that a revisit names; null elsewhere.

    Fails where a record has a problem, where a revisit's response is missing, and where the
    two disagree about the payload's digest or length.
    """
    found = durable(records.drop("payload"))
    responses = found.filter("record_type = 'response'").select(
        F.col("record_id").alias("r_id"),
        F.col("page_id").alias("r_page"),
        F.col("payload_digest").alias("r_digest"),
        F.col("payload_bytes").alias("r_bytes"),
    )
    named = found.select("refers_to_id").filter("refers_to_id IS NOT NULL").distinct()
    wanted = broadcast_if_small(responses.join(named, F.col("r_id") == F.col("refers_to_id"), "left_semi"))
    both = found.join(wanted, F.col("refers_to_id") == F.col("r_id"), "left")
    wrong = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.col("refers_to_id").isNotNull() & F.col("r_id").isNull(), F.lit("no such response"))
        .when((F.col("payload_digest") != F.col("r_digest")) | (F.col("payload_bytes") != F.col("r_bytes")), F.lit("not the same payload"))
    )
    checked = F.when(wrong.isNull(), F.col("record_type")).otherwise(
        F.raise_error(F.concat_ws(" ", "path", F.col("frame").cast("string"), wrong)).cast("string")
    )
    return both.select(
        "page_id", "payload_bytes", "payload_digest", checked.alias("record_type"), F.col("r_page").alias("refers_to"), "target_uri", "record_id"
    )
