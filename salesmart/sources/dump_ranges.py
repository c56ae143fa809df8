"""Python Data Source over byte ranges of text files, for the dump reader.

The driver fixes every range before a read starts and each partition carries its own, so two reads
of the same files are never cut differently and no session setting plays a part. A line belongs to
the range in which its first byte lies. ``marks`` finds the block marks in the ranges, ``lines``
returns their lines with the header id that the range carries. A file whose size is not the one
that was planned is an error.

Files are opened with ``pyarrow.fs``: local paths, and the stores that it knows by their scheme.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

READ_BYTES = 4_000_000

# Fixed values of the dump format.
BLOCK_HEADER = re.compile(r"COPY (\w+)\.(\w+) \(([^)\t]*)\) FROM stdin;", re.ASCII)
_MARK = re.compile(rb"^(?:COPY [^\n]*|\\\.)$", re.M)
_LIKE_HEADER = re.compile(r"COPY .* FROM stdin;\s*")

#: What a mark is: the end of a block, a block header, or a line that only begins like one.
END, HEADER, ODD = 0, 1, 2

MARKS = "file int, at long, next long, kind int, text string"
LINES = "file string, value string, header int"


def opened(path: str) -> tuple[pa.NativeFile, int]:
    """The file for random access, and its size."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        scheme, _, rest = path.partition("://")
        host, _, place = rest.partition("/")
        store, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
        path = f"{base.rstrip('/')}/{place}"
    else:
        store = fs.LocalFileSystem()
    file = store.open_input_file(path)
    return file, file.size()


def whole_lines(file: pa.NativeFile, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the lines that begin in ``[start, end)``, in pieces of whole lines."""
    at, rest = start, b""
    if start:
        # a line begins here only if the byte before ends one
        file.seek(start - 1)
        at = start - 1
        while True:
            part = file.read(READ_BYTES)
            cut = part.find(b"\n")
            at += len(part) if cut < 0 else cut + 1
            if cut >= 0 or not part:
                break
        if cut < 0:
            return
    file.seek(at)
    while at < end:
        part = file.read(READ_BYTES)
        if not part:
            if rest:
                yield at, rest
            return
        text = rest + part
        if at + len(text) > end:
            # the last line of the range is the one that holds its last byte
            cut = text.find(b"\n", end - 1 - at)
            if cut >= 0:
                yield at, text[: cut + 1]
                return
        cut = text.rfind(b"\n")
        if cut >= 0 and at + cut + 1 <= end:
            yield at, text[: cut + 1]
            at, rest = at + cut + 1, text[cut + 1 :]
        else:
            rest = text


class Ranges(InputPartition):
    """(number of the file, path, size, start, end, header id) of each range of a task."""

    def __init__(self, ranges: list[list]):
        super().__init__(ranges)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.marks = options["what"] == "marks"
        self.work = options["work"]

    def partitions(self) -> list[Ranges]:
        work = json.loads(self.work)
        self.work = ""  # the reader travels to every task; each needs its own ranges only
        files = work["files"]
        return [Ranges([[n, *files[n], a, b, h] for n, a, b, h in own]) for own in work["partitions"]]

    def read(self, partition: Ranges | None) -> Iterator[pa.RecordBatch]:
        # without any range Spark reads once, with no partition
        for number, path, name, size, start, end, header in partition.value if partition else ():
            file, now = opened(path)
            with file:
                if now != size:
                    raise RuntimeError(f"{path} has changed since the read was planned")
                for at, text in whole_lines(file, start, end):
                    yield self.found(number, at, text) if self.marks else self.lines(name, header, text)

    @staticmethod
    def found(number: int, at: int, text: bytes) -> pa.RecordBatch:
        rows = []
        for m in _MARK.finditer(text):
            mark = m[0].decode()
            kind = END if mark == r"\." else HEADER if BLOCK_HEADER.fullmatch(mark) else ODD
            if kind != ODD or _LIKE_HEADER.fullmatch(mark):
                rows.append((number, at + m.start(), at + m.end() + 1, kind, mark))
        columns = zip(*rows, strict=True) if rows else ((),) * 5
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in MARKS.split(", ")])

    @staticmethod
    def lines(name: str, header: int, text: bytes) -> pa.RecordBatch:
        values = pa.array(text.removesuffix(b"\n").split(b"\n"), pa.binary()).cast(pa.string())
        n = len(values)
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(name, pa.string()), n), values, pa.repeat(pa.scalar(header, pa.int32()), n)], ["file", "value", "header"])


class DumpRanges(DataSource):
    """Option ``what``: ``marks`` or ``lines``; option ``work``: files (path, name, size) and the ranges of each partition."""

    @classmethod
    def name(cls) -> str:
        return "dump_ranges"

    def schema(self) -> str:
        return MARKS if self.options["what"] == "marks" else LINES

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))
