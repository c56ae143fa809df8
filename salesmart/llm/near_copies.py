"""Near copies by words: MinHash buckets over shingles, each candidate verified by exact Jaccard.

Words are those of ``simhash``; shingles are ``SHINGLE`` consecutive words as a set (a shorter text
is one shingle, a text without words has none and is like nothing). Two documents are near copies
if the Jaccard similarity of their shingles is ``SIMILARITY`` or more. A document has ``BANDS``
bucket values of ``ROWS`` minima each, so that two near copies share no bucket with a chance of at
most ``MISS``. In each bucket all members are compared with the smallest id; those that are near
copies go, the smallest is done with, and the rest meets again, ``STARS`` times at most. So a large
group of copies takes as many comparisons as members.

What is left then are members unlike each other. They meet inside cells: a task compares their
sketches, the ``BANDS * ROWS`` minima in 16 bits each, and returns only pairs that agree in
``AGREE`` of them or more, which two near copies fail with a chance of at most ``MISS``. These few
are verified. A bucket of more than ``CELL`` such members is split first: its documents get
``FINE_BANDS`` buckets of ``FINE_ROWS`` further minima, again with at most ``MISS``; one that is
still larger is dealt in tiles of ``CELL`` members, in which every two of them meet. So a near copy
of a document that stays is missed with a chance of at most three times ``MISS``, and texts that
share half their shingles or less cost no verification however many share a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.components import stored
from salesmart.llm.texts import LOWER, column, encoded, keyed, slices

SHINGLE = 5
SIMILARITY = 0.8
ROWS = 5
MISS = 1e-4
BANDS = math.ceil(math.log(MISS) / math.log(1 - SIMILARITY**ROWS))
STARS = 4
CELL = 512
FINE_ROWS = 12
FINE_BANDS = math.ceil(math.log(MISS) / math.log(1 - SIMILARITY**FINE_ROWS))


def _least_agreement(lanes: int) -> int:
    """Most lanes that two near copies agree in with a chance of 1 - ``MISS`` or more."""
    below = 0.0
    for n in range(lanes + 1):
        below += math.comb(lanes, n) * SIMILARITY**n * (1 - SIMILARITY) ** (lanes - n)
        if below > MISS:
            return n
    raise AssertionError("unreachable")


AGREE = _least_agreement(BANDS * ROWS)


def _hashing(lanes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    return random.integers(0, 2**64, lanes, np.uint64), random.integers(0, 2**64, lanes, np.uint64) | np.uint64(1)


_COARSE = _hashing(BANDS * ROWS, 5)
_FINE = _hashing(FINE_BANDS * FINE_ROWS, 7)
_FOLD = np.uint64(0xC2B2AE3D27D4EB4F)
_AT_ONCE = 131_072  # lanes of shingles mixed at once


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one text."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-width].tolist()]
    return np.unique(np.array([digest(joined[a:b]) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)], np.uint64))


def minima(hashes: np.ndarray, hashing: tuple[np.ndarray, np.ndarray] = _COARSE) -> np.ndarray:
    """The least mixed hash in each lane."""
    flip, times = hashing
    least = np.full(len(flip), 2**64 - 1, np.uint64)
    step = max(1, _AT_ONCE // len(flip))
    for at in range(0, len(hashes), step):
        mixed = (hashes[at : at + step] ^ flip[:, None]) * times[:, None]
        mixed ^= mixed >> np.uint64(31)
        mixed *= _FOLD
        np.minimum(least, mixed.min(axis=1), out=least)
    return least


def bucket_values(hashes: np.ndarray, rows: int = ROWS, hashing: tuple[np.ndarray, np.ndarray] = _COARSE) -> np.ndarray:
    """One value per band; none without shingles."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = minima(hashes, hashing).reshape(-1, rows)
    value = np.arange(1, len(least) + 1, dtype=np.uint64)
    for row in least.T:
        value = (value ^ row) * _FOLD
        value ^= value >> np.uint64(29)
    return value.view(np.int64)


def near(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two shingle sets, empty ones excluded, have the similarity."""
    small, large = sorted((len(a), len(b)))
    if not small or small < similarity * large - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (small + large - both) - 1e-9


def _buckets(docs: DataFrame, fine: bool = False) -> DataFrame:
    """(value, doc_id) of every bucket that a document lies in."""
    rows, hashing = (FINE_ROWS, _FINE) if fine else (ROWS, _COARSE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [bucket_values(shingles(t), rows, hashing) for t in encoded(column(batch, "text"))]
            ids = np.repeat(column(batch, "doc_id").to_numpy(zero_copy_only=False), [len(v) for v in values])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(values)), pa.array(ids, pa.int64())], ["value", "doc_id"])

    return docs.mapInArrow(run, "value long, doc_id long")


def _sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, sketch) of documents with shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [(minima(shingles(t)) >> np.uint64(48)).astype("<u2").tobytes() for t in encoded(column(batch, "text"))]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(found, pa.binary())], ["doc_id", "sketch"])

    return docs.mapInArrow(run, "doc_id long, sketch binary")


def _alike(members: DataFrame, sketches: DataFrame, cell: int) -> DataFrame:
    """(doc_id, centre): pairs of members of a bucket, larger id first, whose sketches agree. Buckets have (value, doc_id, n)."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["doc_id"].to_numpy()
        lanes = np.frombuffer(b"".join(pdf["sketch"]), "<u2").reshape(len(ids), -1)
        found = [(i, i + 1 + np.flatnonzero((lanes[i + 1 :] == lanes[i]).sum(axis=1) >= AGREE)) for i in range(len(ids) - 1)]
        one = np.repeat(ids[: len(ids) - 1], [len(x) for _, x in found])
        other = ids[np.concatenate([x for _, x in found])] if found else one
        return pd.DataFrame({"doc_id": np.maximum(one, other), "centre": np.minimum(one, other)})

    # a bucket within the limit is one tile; a larger one has a tile for every two of its shares
    shares = F.when(F.col("n") > cell, F.ceil(2 * F.col("n") / cell)).otherwise(1).cast("int")
    tiled = members.select(
        "doc_id", "value", F.pmod(F.xxhash64("doc_id"), shares).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), shares - 1)).alias("other")
    )
    tiles = tiled.select("doc_id", "value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    return tiles.join(sketches, "doc_id").groupBy("value", "a", "b").applyInPandas(compare, "doc_id long, centre long").distinct()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id): documents that are near copies of one they are paired with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached = lru_cache(64)(shingles)
        for batch in slices(batches):
            own, other = encoded(column(batch, "text")), encoded(column(batch, "__centre_text"))
            same = [near(shingles(a), cached(b)) for a, b in zip(own, other, strict=True)]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id").filter(pa.array(same))], ["doc_id"])

    centres = texts.select(F.col("doc_id").alias("centre"), F.col("text").alias("__centre_text"))
    return pairs.join(texts, "doc_id").join(centres, "centre").select("doc_id", "text", "__centre_text").mapInArrow(run, "doc_id long").distinct()


def superseded(docs: DataFrame, stars: int = STARS, cell: int = CELL) -> DataFrame:
    """(doc_id): the documents to give up so that no two near copies remain, once each.

    Each is a near copy of a document with a smaller id, which remains or is given up for one
    with a smaller id still. Ids of ``docs`` are distinct; rows without an id play no part.
    """
    docs = keyed(docs, "doc_id", "text").where("doc_id IS NOT NULL")
    buckets = stored(_buckets(docs), "copy-buckets")
    crowded = stored(buckets.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value"), "copy-crowded")
    met = stored(buckets.join(crowded, "value"), "copy-met")
    involved = stored(met.select("doc_id").distinct(), "copy-involved")
    texts = stored(docs.join(involved, "doc_id"), "copy-texts")
    gone = docs.sparkSession.createDataFrame([], "doc_id long")
    for _ in range(stars):
        centres = stored(
            met.groupBy("value").agg(F.min("doc_id").alias("centre"), F.count("*").alias("n")).where("n > 1").select("value", "centre"), "copy-centres"
        )
        if centres.isEmpty():
            return gone
        rest = stored(met.join(centres, "value").where("doc_id <> centre"), "copy-rest")
        found = stored(_verified(rest.select("doc_id", "centre").distinct(), texts), "copy-found")
        if found.isEmpty():
            break
        gone = gone.unionByName(found)
        met = stored(rest.select("value", "doc_id").join(found, "doc_id", "left_anti"), "copy-met")
    return gone.unionByName(_verified(stored(_unlike(met, texts, cell), "copy-pairs"), texts)).distinct()


def _unlike(met: DataFrame, texts: DataFrame, cell: int) -> DataFrame:
    """(doc_id, centre): what may be a near copy of what among the members that the stars left."""
    sizes = stored(met.groupBy("value").agg(F.count("*").alias("n")).where("n > 1"), "copy-sizes")
    members = stored(met.join(sizes, "value"), "copy-members")
    sketches = stored(_sketches(texts.join(members.select("doc_id").distinct(), "doc_id", "left_semi")), "copy-sketches")
    pairs = _alike(members.where(F.col("n") <= cell), sketches, cell)
    large = members.where(F.col("n") > cell).select("doc_id").distinct()
    if large.isEmpty():
        return pairs
    fine = stored(_buckets(texts.join(large, "doc_id", "left_semi"), fine=True), "copy-fine")
    again = stored(fine.groupBy("value").agg(F.count("*").alias("n")).where("n > 1"), "copy-sizes")
    return pairs.unionByName(_alike(fine.join(again, "value"), sketches, cell)).distinct()
