"""Token ids of documents as Simple-8b files in ascending order of document id.

A file is a Parquet container whose rows are chunks of consecutive documents: the ids as Simple-8b
words, the first word of each block of ids, and the ids and lengths of the documents. Spark's
writer commits the files, so lost executors leave no half files, and any store that Spark reaches
can hold them. Partitions are ranges of ``doc_id``; ``part`` and ``chunk`` number the chunks in
order, and their ``n_ids`` alone give every document's place in the whole stream.

Null and empty texts have the end id only. Rows that repeat an id follow each other, ordered by
text; rows without an id come first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm import simple8b
from salesmart.llm.texts import column, keyed, slices
from salesmart.llm.tokens import ENCODED_BYTES, bpe_encoder

END = 2

FILE = (
    "part int, chunk int, n_ids long, doc_ids array<bigint>, lengths array<bigint>, block_starts binary, words binary"
)


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END) -> None:
    """Encodes all documents and writes them below ``path``, which must not exist."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe_encoder(tokenizer)
        part = TaskContext.get().partitionId()
        tail = np.array([end], "<u4").tobytes()
        for chunk, batch in enumerate(slices(batches, size=ENCODED_BYTES)):
            raw = [x + tail for x in encoder.encode(column(batch, "text").to_pylist())]
            ids = np.frombuffer(b"".join(raw), "<u4").astype(np.uint64)
            words, starts = simple8b.encode(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([chunk], pa.int32()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([column(batch, "doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([[len(x) // 4 for x in raw]], pa.list_(pa.int64())),
                    pa.array([starts.astype("<u4").tobytes()], pa.binary()),
                    pa.array([words.astype("<u8").tobytes()], pa.binary()),
                ],
                ["part", "chunk", "n_ids", "doc_ids", "lengths", "block_starts", "words"],
            )

    ordered = keyed(docs, "doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, FILE).write.option("compression", "zstd").parquet(path)


def chunk_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, chunk, base): ids before each chunk; reads three small columns of the files."""
    sizes = spark.read.schema(FILE).parquet(path).select("part", "chunk", "n_ids")
    # one row per partition of the files, then one per chunk within its own partition
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn(
        "base", F.sum("n").over(Window.orderBy("part")) - F.col("n")
    )
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("chunk")) - F.col("n_ids")
    return sizes.withColumn("inside", inside).join(parts.select("part", "base"), "part").select(
        "part", "chunk", (F.col("base") + F.col("inside")).alias("base")
    )


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list, list, np.ndarray]]:
    for batch in batches:
        for row in range(batch.num_rows):
            x = {n: column(batch, n)[row].as_py() for n in batch.schema.names}
            words = np.frombuffer(x["words"], "<u8")
            ids = simple8b.decode(words, np.frombuffer(x["block_starts"], "<u4"), x["n_ids"])
            yield x["part"], x["chunk"], x["doc_ids"], x["lengths"], ids.astype("<u4")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, docs, lengths, ids in _decoded(batches):
            values = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(ids.astype(np.int64))
            )
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), values], ["doc_id", "ids"])

    return spark.read.schema(FILE).parquet(path).mapInArrow(run, "doc_id long, ids array<bigint>")


def summary(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, chunk, docs, lengths, ids in _decoded(batches):
            n = len(docs)
            cut = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(np.full(n, chunk, np.int32)),
                    pa.array(cut[:-1]),
                    pa.array(lengths, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "part", "chunk", "inside", "n_tokens", "ids_crc32"],
            )

    rows = spark.read.schema(FILE).parquet(path).mapInArrow(
        run, "doc_id long, part int, chunk int, inside long, n_tokens long, ids_crc32 long"
    )
    return rows.join(chunk_starts(spark, path), ["part", "chunk"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
