"""Arrow helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Text handled at once by a task; one document may be larger.
SLICE_BYTES = 2_000_000

_AZ = bytes(range(65, 91))
#: bytes.translate table that lower-cases A-Z and leaves all other bytes.
LOWER = bytes.maketrans(_AZ, _AZ.lower())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(names: list[str], stem: str) -> str:
    """``stem``, made longer until no column has that name."""
    taken = {n.lower() for n in names}
    while stem.lower() in taken:
        stem += "_"
    return stem


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns with ``doc_id`` as long; other columns play no part."""
    return docs.select(*[F.col(c).cast("long").alias(c) if c == "doc_id" else F.col(c) for c in columns])


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string())
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        group = (ends[1:] - ends[0]) // size
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def encoded(values: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in values.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]
