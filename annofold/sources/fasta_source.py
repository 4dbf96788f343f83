"""FASTA as a data source with byte ranges of its own. Ids: SRC-01..03.

``spark.read.format("fasta").option("path", ...)`` reads files in ranges of ``blockBytes``. A range
owns the records whose ``>`` lies in it and reads on to the end of its last one, so ranges depend
on the files only, not on the cluster, and two reads number the same records alike. With
``option("only", "counts")`` a read returns one row a range and builds no sequences. A compressed
file is one range.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from annofold.sinks import arrow_store

BLOCK_BYTES = 64 << 20
CHUNK = 1 << 20
#: Records and bytes of sequence that a batch holds at most, but for its last record.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20
COMPRESSED = (".gz", ".bz2", ".zst")
RECORDS = "file string, block long, at long, opened boolean, header string, sequence string"
COUNTS = "file string, block long, n long"


@dataclass
class Range(InputPartition):
    """Bytes [start, end) of a file; end -1 stands for a whole compressed one."""

    file: str
    start: int
    end: int

    def __init__(self, file: str, start: int, end: int) -> None:
        super().__init__((file, start, end))
        self.file, self.start, self.end = file, start, end


def owned(source: pa.NativeFile, start: int, end: int, chunk: int = CHUNK) -> Iterator[bytes]:
    """The records of a range, from ``>`` to before the next one; at byte 0 whatever stands there."""
    base = max(start - 1, 0)  # where ``held`` begins in the file
    if base:
        source.seek(base)
    held, searched, first = b"", 0, start == 0
    while True:
        at = held.find(b"\n>", searched)
        if at < 0:
            searched = max(len(held) - 1, 0)
            more = source.read(chunk)
            if not more:
                break
            held += more
            continue
        if first:
            yield held[: at + 1]
        base, held, searched, first = base + at + 1, held[at + 1 :], 0, True
        if 0 <= end <= base:
            return
    if first and held:
        yield held


def parsed(record: bytes) -> tuple[bool, str, str] | None:
    """(begins with ``>``, header, sequence); None for blanks before the first header."""
    lines = record.replace(b"\r\n", b"\n").replace(b"\r", b"\n").lstrip().split(b"\n")
    opened = lines[0].startswith(b">")
    bare = [line.strip() for line in ([lines[0][1:], *lines[1:]] if opened else lines)]
    if not opened and not any(bare):
        return None
    return opened, bare[0].decode("utf-8", "replace"), b"".join(bare[1:]).decode("utf-8", "replace")


class FastaReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.block = int(options.get("blockBytes", BLOCK_BYTES))
        self.counts = options.get("only") == "counts"

    def _files(self) -> Iterator[tuple[str, int]]:
        for path in self.paths:
            store, inner = arrow_store(path)
            outer = path[: len(path) - len(inner)] if path.endswith(inner) else ""
            info = store.get_file_info(inner)
            if info.type == pa_fs.FileType.NotFound:
                raise FileNotFoundError(path)
            found = [info] if info.is_file else store.get_file_info(pa_fs.FileSelector(inner, recursive=True))
            for f in found:
                if f.is_file and (info.is_file or not f.base_name.startswith(("_", "."))):
                    yield outer + f.path, f.size

    def partitions(self) -> list[Range]:
        out = []
        for file, size in sorted(self._files()):
            if file.endswith(COMPRESSED):
                out.append(Range(file, 0, -1))
            else:
                out += [Range(file, at, min(at + self.block, size)) for at in range(0, size, self.block)]
        return out

    def _records(self, part: Range) -> Iterator[tuple[bool, str, str]]:
        store, inner = arrow_store(part.file)
        with store.open_input_stream(inner) if part.end < 0 else store.open_input_file(inner) as source:
            for record in owned(source, part.start, part.end):
                if self.counts:
                    # Only what stands before the first header may be no record.
                    if record[:1] == b">" or parsed(record) is not None:
                        yield True, "", ""
                elif (found := parsed(record)) is not None:
                    yield found

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no ranges
            return
        if self.counts:
            n = sum(1 for _ in self._records(partition))
            yield pa.RecordBatch.from_pydict({"file": [partition.file], "block": [partition.start], "n": [n]}, pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64())]))
            return
        rows: list[tuple] = []
        held = 0
        for at, (opened, header, sequence) in enumerate(self._records(partition)):
            rows.append((partition.file, partition.start, at, opened, header, sequence))
            held += len(sequence)
            if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "block", "at", "opened", "header", "sequence"])


class FastaSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> str:
        return COUNTS if self.options.get("only") == "counts" else RECORDS

    def reader(self, schema) -> FastaReader:
        return FastaReader(dict(self.options))
