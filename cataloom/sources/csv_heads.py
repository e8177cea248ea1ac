"""The first records of landed CSV files, as a Python data source.

    spark.dataSource.register(CsvHeads)
    spark.read.format("csv_heads").option("max_rows", 5).load("/landed")

Files are listed once and dealt out in groups; a task opens a file, reads it in chunks and stops behind
the header and ``max_rows`` records, so a file costs its head however large it is.  Rows are
``(file_path, sample_csv, records, bytes_read, complete)``.

A record ends at a line end outside quotes.  A quote opens at the start of a field only; a quoted part may
hold commas, line ends and doubled quotes, and what follows its end belongs to the field.  Records are
stripped and empty ones skipped.  A record that is not closed at ``max_bytes`` or at the end of the file is
left out and ``complete`` is false; a file without a record has no sample.  Bytes that are no UTF-8 are
replaced; a byte-order mark is dropped.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file_path string, sample_csv string, records int, bytes_read long, complete boolean"
CHUNK = 16_384
MAX_BYTES = 4_194_304
FILES_PER_TASK = 64
SPECIAL = re.compile(r'[",\r\n]')


class RecordReader:
    """Fields of the records of a text that comes in pieces."""

    def __init__(self) -> None:
        self.fields: list[str] = []
        self.parts: list[str] = []  # of the open field
        self.quoted = self.started = self.ended_quote = False
        self.held = ""  # a last character whose meaning the next one tells

    def feed(self, text: str, last: bool = False) -> Iterator[list[str]]:
        """The records that ``text`` completes; ``last`` ends the record that is open, unless in quotes."""
        text, self.held = self.held + text, ""
        at = 0
        while at < len(text):
            if self.quoted:
                end = text.find('"', at)
                if end < 0:
                    self.parts.append(text[at:])
                    return
                if end + 1 == len(text) and not last:
                    self.parts.append(text[at:end])
                    self.held = '"'
                    return
                self.parts.append(text[at:end])
                if text[end + 1 : end + 2] == '"':
                    self.parts.append('"')
                    at = end + 2
                else:
                    self.quoted, at = False, end + 1
                continue
            if not self.started and text[at] == '"':
                self.quoted = self.started = True
                at += 1
                continue
            found = SPECIAL.search(text, at)
            end = found.start() if found else len(text)
            self.parts.append(text[at:end])
            self.started = self.started or end > at
            at = end
            if not found:
                break
            mark, at = text[end], end + 1
            if mark == '"':  # inside a field a quote is an ordinary character
                self.parts.append(mark)
                self.started = True
            elif mark == ",":
                self._field()
            else:
                yield from self._record()
        if last and not self.quoted:
            yield from self._record()

    def open(self) -> bool:
        return bool(self.quoted or self.held or self.fields or "".join(self.parts).strip())

    def _field(self) -> None:
        self.fields.append("".join(self.parts))
        self.parts, self.started = [], False

    def _record(self) -> Iterator[list[str]]:
        self._field()
        record, self.fields = self.fields, []
        if len(record) == 1 and not record[0].strip():
            return
        yield record


def rendered(record: list[str]) -> str:
    """A record with minimal quoting; its outer white space is dropped."""
    quoted = ['"' + f.replace('"', '""') + '"' if SPECIAL.search(f) else f for f in record]
    quoted[0] = quoted[0].lstrip()
    quoted[-1] = quoted[-1].rstrip()
    return ",".join(quoted)


def head(stream, max_rows: int, max_bytes: int = MAX_BYTES, chunk: int = CHUNK) -> tuple[str | None, int, int, bool]:
    """(sample, records, bytes read, whether no record was cut) of an open binary stream."""
    decoder = codecs.getincrementaldecoder("utf-8-sig")("replace")
    reader, found, size = RecordReader(), [], 0
    while len(found) <= max_rows:
        data = stream.read(min(chunk, max_bytes - size)) if size < max_bytes else b""
        size += len(data)
        ended = not data and size < max_bytes
        for record in reader.feed(decoder.decode(data, final=ended), last=ended):
            found.append(rendered(record))
            if len(found) > max_rows:
                break
        if not data:
            break
    whole = len(found) > max_rows or not reader.open()
    return "\n".join(found) or None, len(found), size, whole


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path; paths without a scheme are local."""
    if urlsplit(path).scheme:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def prefix_of(path: str) -> str:
    """What a path inside the file system lacks of the path as it is given."""
    parts = urlsplit(path)
    if not parts.scheme or parts.scheme == "file":
        return "file://"
    return f"{parts.scheme}://{parts.netloc}" if parts.scheme in ("hdfs", "viewfs") else f"{parts.scheme}://"


@dataclass
class Files(InputPartition):
    paths: list[str]


class HeadReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.max_rows = int(options.get("max_rows", 5))
        self.max_bytes = int(options.get("max_bytes", MAX_BYTES))
        self.files = int(options.get("files_per_task", FILES_PER_TASK))

    def partitions(self) -> list[Files]:
        system, path = located(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        every = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        hidden = lambda p: any(part[:1] in "._" for part in p[len(path) :].split("/") if part)
        names = sorted(f.path for f in every if f.is_file and (info.is_file or not hidden(f.path)))
        return [Files(names[i : i + self.files]) for i in range(0, len(names), self.files)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = located(self.path)
        prefix = prefix_of(self.path)
        rows = []
        for path in partition.paths:
            with system.open_input_file(path) as stream:
                sample, records, size, whole = head(stream, self.max_rows, self.max_bytes)
            rows.append((prefix + path, sample, records, size, whole))
        if rows:
            types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["file_path", "sample_csv", "records", "bytes_read", "complete"])


class CsvHeads(DataSource):
    """Options: ``path``, ``max_rows``, ``max_bytes`` of a file, ``files_per_task``."""

    @classmethod
    def name(cls) -> str:
        return "csv_heads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HeadReader:
        return HeadReader(self.options)
