r"""Reader for dumps made of ``COPY schema.table (columns) FROM stdin;`` blocks.

Dump text is read in byte ranges (``dump_ranges``), so one huge file still uses the whole cluster:

1. marks: all bytes are searched for block headers and ends, in ranges of a split each. The driver
   learns the place of every mark, two small rows per block, and so the byte range of every block;
2. lines: a table is read from the ranges of its own blocks only, cut at the split size. No line is
   exchanged or labelled, and what other tables hold is not opened.

A line outside any block that starts like a block header but cannot be read is an error, as are
bytes that are not UTF-8.

Fields are split, unescaped and typed by native expressions. A data line of a one-column table
that spells a complete COPY header cannot be told from a header.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.scalars import pg_array
from salesmart.sources.contracts import ARRAY_PREFIX, DUMP_TABLE_PREFIX, GEOMETRY_COLUMNS
from salesmart.sources.dump_ranges import BLOCK_HEADER, HEADER, ODD, DumpRanges

# Fixed values of the dump format.
BLOCK_END = r"\."
NULL_FIELD = r"\N"
_BYTE_ESCAPE = r"\\(?:[0-7]|x[0-9A-Fa-f])"
ESCAPES = {r"\b": "\b", r"\f": "\f", r"\n": "\n", r"\r": "\r", r"\t": "\t", r"\v": "\v"}

_OUTSIDE = 0  # id of "in no block"; headers count from 1


def unescape(field: Column) -> Column:
    r"""COPY text escapes. Splitting at ``\\`` first leaves only unambiguous escapes in the parts.

    Escapes by byte number (``\x41``, ``\101``), which dumps do not write, are an error.
    """
    def plain(part: Column) -> Column:
        text = part
        for mark, char in ESCAPES.items():
            text = F.replace(text, F.lit(mark), F.lit(char))
        odd = F.raise_error(F.concat(F.lit("escape by byte number in a dump: "), part)).cast("string")
        return F.when(part.rlike(_BYTE_ESCAPE), odd).otherwise(text)

    parts = F.transform(F.split(field, r"\\\\"), plain)
    text = F.when(F.contains(field, F.lit("\\")), F.array_join(parts, "\\")).otherwise(field)
    return F.when(field != NULL_FIELD, text)


def column_type(name: str) -> str:
    """Type of a dump column by its name; geometry stays hex text."""
    if name in GEOMETRY_COLUMNS:
        return "geometry"
    return "array" if name.startswith(ARRAY_PREFIX) else "text"


def plain_name(table: str) -> str:
    """Table name without the prefix of the national dump format."""
    return table.removeprefix(DUMP_TABLE_PREFIX)


class CopyDump:
    """Tables of one or more dump files."""

    def __init__(self, spark: SparkSession, paths: str | list[str], pattern: str = "*.sql"):
        self.spark = spark
        spark.dataSource.register(DumpRanges)
        listed = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .load(paths)
            .select("path", F.col("_metadata.file_path").alias("name"), "length")
        )
        # a listing: names and sizes, as the driver has them for any read
        self.files = sorted([r.path, r.name, r.length] for r in listed.collect() if r.length)
        whole = sum(size for *_, size in self.files)
        limits = spark._jsparkSession.sessionState().conf()
        fair = max(limits.filesOpenCostInBytes(), -(-whole // spark.sparkContext.defaultParallelism))
        self.split = max(1, min(limits.filesMaxPartitionBytes(), fair))
        self._headers: list[str] = []
        self._blocks: list[tuple[int, int, int, int]] = self._found()

    def _read(self, what: str, ranges: list[tuple[int, int, int, int]]) -> DataFrame:
        """Ranges (file, start, end, header id), cut at the split size and packed into partitions of about that size."""
        partitions: list[list] = []
        room = 0
        for number, start, end, header in ranges:
            for at in range(start, end, self.split):
                until = min(end, at + self.split)
                if until - at > room:
                    partitions.append([])
                    room = self.split
                partitions[-1].append((number, at, until, header))
                room -= until - at
        work = json.dumps({"files": self.files, "partitions": partitions})
        return self.spark.read.format("dump_ranges").option("what", what).option("work", work).load()

    def _found(self) -> list[tuple[int, int, int, int]]:
        """The byte range of every block, with its header id."""
        whole = [(number, 0, size, _OUTSIDE) for number, (*_, size) in enumerate(self.files)]
        marks = self._read("marks", whole).sort("file", "at").collect()  # two rows a block
        self._headers = sorted({m.text for m in marks if m.kind == HEADER})
        ids = {header: number for number, header in enumerate(self._headers, start=1)}
        blocks: list[tuple[int, int, int, int]] = []
        file, start, header = -1, 0, _OUTSIDE

        def close(end: int) -> None:
            if header != _OUTSIDE and start < end:
                blocks.append((file, start, end, header))

        for m in marks:
            if m.file != file:
                if file >= 0:
                    close(self.files[file][2])  # a dump that was cut off
                file, header = m.file, _OUTSIDE
            if m.kind == ODD:
                if header == _OUTSIDE:
                    raise ValueError(f"block header that cannot be read: {m.text!r}")
                continue
            close(m.at)
            start, header = m.next, ids.get(m.text, _OUTSIDE)
        if file >= 0:
            close(self.files[file][2])
        return blocks

    def ranges(self, name: str) -> list[tuple[str, int, int]]:
        """(file, start, end) of the blocks of a table: all that reading it opens."""
        wanted = {number for number, _, _ in self.definitions()[name]}
        return [(self.files[number][1], start, end) for number, start, end, header in self._blocks if header in wanted]

    def definitions(self) -> dict[str, list[tuple[int, str, list[str]]]]:
        """Table -> (header id, schema, columns) of each way it is declared."""
        found: dict[str, list[tuple[int, str, list[str]]]] = {}
        for number, header in enumerate(self._headers, start=1):
            schema, table, columns = BLOCK_HEADER.fullmatch(header).groups()
            names = [c.strip().strip('"') for c in columns.split(",")]
            found.setdefault(plain_name(table), []).append((number, schema, names))
        return found

    def tables(self) -> list[str]:
        return sorted(self.definitions())

    def national_schema(self) -> str | None:
        """Schema of the dated national format, None for a regional dump."""
        for variants in self.definitions().values():
            for _, schema, _ in variants:
                if re.fullmatch(DUMP_TABLE_PREFIX + r"\d{4}_\d+", schema):
                    return schema
        return None

    def table(self, name: str, lineage: bool = False) -> DataFrame:
        """Rows of one table: text columns, arrays for list columns, hex text for geometry."""
        variants = self.definitions()[name]
        wanted = {number for number, _, _ in variants}
        lines = self._read("lines", [b for b in self._blocks if b[3] in wanted])
        fields = F.split(F.col("value"), "\t", -1)
        names = list(dict.fromkeys(c for _, _, columns in variants for c in columns))

        def field(column: str) -> Column:
            out = F.lit(None).cast("string")
            for number, _, columns in variants:
                if column in columns:
                    at = F.get(F.col("fields"), F.lit(columns.index(column)))
                    out = at if len(variants) == 1 else F.when(
                        F.col("header") == number, at
                    ).otherwise(out)
            text = unescape(out)
            return pg_array(text) if column_type(column) == "array" else text

        selected = lines.withColumn("fields", fields).select(
            *[field(c).alias(c) for c in names],
            *([F.col("file").alias("source_file")] if lineage else []),
        )
        return selected


def scan_copy_dump(spark: SparkSession, paths: str | list[str], table: str) -> DataFrame:
    return CopyDump(spark, paths).table(table)


def write_copy_dump(df: DataFrame, schema: str, table: str, path: str) -> None:
    """Write a table as dump text; every part file is a complete block."""
    special = "[" + "".join(f"\\x{ord(c):02x}" for c in ("\\", *ESCAPES.values())) + "]"

    def escaped(name: str) -> Column:
        text = F.col(name).cast("string")
        marked = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        for mark, char in ESCAPES.items():
            marked = F.replace(marked, F.lit(char), F.lit(mark))
        return F.coalesce(F.when(text.rlike(special), marked).otherwise(text), F.lit(NULL_FIELD))

    header = f"COPY {schema}.{table} ({', '.join(df.columns)}) FROM stdin;"

    def framed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [header]})
        yield from batches
        yield pd.DataFrame({"value": [BLOCK_END]})

    lines = df.select(F.concat_ws("\t", *[escaped(c) for c in df.columns]).alias("value"))
    lines.mapInPandas(framed, "value string").write.mode("overwrite").text(path)
