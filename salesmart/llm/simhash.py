"""SimHash near-duplicates through a Gray-order hierarchical index.

Words are runs of bytes other than ASCII white space, A-Z lower-cased; features are the shingles
of three consecutive words, repeats included (a shorter text is one shingle; a text without words
has fingerprint zero and links like any other). A fingerprint bit is 1 if it is set in over half
of the shingles' XXH64 values (seed 42). Fingerprints link at ``distance`` differing bits or fewer.

Equal fingerprints are one class before anything is compared. The 64 bits are cut into
``distance + 1`` blocks: two linked fingerprints agree in one block at least, so classes meet by
(block, value) and no link is lost. In each cell the fingerprints are sorted by Gray
rank and put under a hierarchy whose nodes hold the bit patterns that all members below them
share, each bit in the uppermost node that shares it. A search adds up differing bits on its way
down and drops a whole node once they exceed the distance. Small groups share a cell, and a group
of more than ``CELL`` classes is cut into shares whose pairs are cells of their own. Only a
spanning forest of each cell leaves its task; components are then formed over all cells.

Null texts are empty texts. Rows that repeat a ``doc_id`` keep their own fingerprints and belong
to one component together; rows without an id are answered without a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.components import components, forest, stored
from salesmart.llm.texts import LOWER, column, encoded, keyed, slices

DISTANCE = 2
WORDS = 3
SEED = 42
CELL = 4096
FANOUT = 16
QUERIES = 512

_POP = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def popcount(x: np.ndarray) -> np.ndarray:
    return _POP[x.view(np.uint16).reshape(*x.shape, 4)].sum(axis=-1, dtype=np.int64)


def fingerprint(text: bytes, width: int = WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-width].tolist()]
    digest = xxhash.xxh64_intdigest
    last = (ends[width - 1 :] - 1).tolist()
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, last, strict=True)], ">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, print): the fingerprint as a signed long, one row per document row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [fingerprint(t, width, seed) for t in encoded(column(batch, "text"))]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(np.array(values, np.uint64).view(np.int64))], ["doc_id", "print"]
            )

    return keyed(docs, "doc_id", "text").mapInArrow(run, "doc_id long, print long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each value in the reflected Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class GrayIndex:
    """Hierarchy over fingerprints in Gray order; ``order`` gives the input places of the leaves."""

    def __init__(self, prints: np.ndarray, fanout: int = FANOUT):
        self.order = np.argsort(gray_rank(prints), kind="stable")
        self.fanout = fanout
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        pattern = prints[self.order]
        shared = np.full(len(pattern), every)
        levels = [(pattern, shared)]
        while len(pattern) > 1:
            cuts = np.arange(0, len(pattern), fanout)
            ones = np.bitwise_and.reduceat(pattern & shared, cuts)
            zeros = np.bitwise_and.reduceat(~pattern & shared, cuts)
            shared = ones | zeros
            pattern = ones
            levels.append((pattern, shared))
        # each bit is tested in the uppermost node that shares it
        self.levels = []
        above = None
        for pattern, shared in reversed(levels):
            own = shared if above is None else shared & ~np.repeat(above, fanout)[: len(shared)]
            self.levels.append((pattern, own))
            above = shared

    def search(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, place) of all pairs at ``distance`` or fewer differing bits."""
        query = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        spent = np.zeros(len(queries), np.int64)
        for depth, (pattern, own) in enumerate(self.levels):
            if depth:
                child = node[:, None] * self.fanout + np.arange(self.fanout)
                real = child < len(pattern)
                width = real.sum(axis=1)
                query, spent, node = np.repeat(query, width), np.repeat(spent, width), child[real]
            spent = spent + popcount((queries[query] ^ pattern[node]) & own[node])
            near = spent <= distance
            query, node, spent = query[near], node[near], spent[near]
        return query, self.order[node]


def _blocks(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of the blocks that the 64 bits are cut into."""
    n = distance + 1
    size = [64 // n + (i < 64 % n) for i in range(n)]
    return [(sum(size[:i]), size[i]) for i in range(n)]


def _cell_links(pdf: pd.DataFrame, distance: int) -> pd.DataFrame:
    """Spanning forest of one cell: rows of side 0 against those of side 1 (without any: against themselves)."""
    low, bits = _blocks(distance)[int(pdf["block"].iloc[0])]
    pdf = pdf.sort_values("doc", kind="stable")
    prints, docs = pdf["print"].to_numpy().view(np.uint64), pdf["doc"].to_numpy()
    # the block goes to the front, so that members which agree in it are neighbours in Gray order
    up = (64 - low - bits) % 64
    if up:
        prints = (prints << np.uint64(up)) | (prints >> np.uint64(64 - up))
    side = pdf["side"].to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(right):
        right = left
    labels = np.arange(len(docs))
    if len(left):
        index = GrayIndex(prints[left])
        for at in range(0, len(right), QUERIES):
            part = right[at : at + QUERIES]
            query, place = index.search(prints[part], distance)
            forest(part[query], left[place], labels)
    moved = labels != np.arange(len(docs))
    return pd.DataFrame({"a": docs[moved], "b": docs[labels[moved]]})


def links(classes: DataFrame, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """(a, b): links that connect all classes (print, doc) at ``distance`` or fewer bits.

    A cell holds the classes of many values of one block; one that holds more than ``cell``
    classes by itself gets pairs of shares of its own.
    """
    parts = F.array(*[
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned("print", low).bitwiseAND(F.lit((1 << bits) - 1)).alias("value"),
        )
        for i, (low, bits) in enumerate(_blocks(distance))
    ])
    rows = classes.select("print", "doc", F.explode(parts).alias("p")).select("print", "doc", "p.block", "p.value")
    cells = max(1, -(-2 * classes.count() // cell))
    hot = rows.groupBy("block", "value").agg(F.count("*").alias("n")).where(F.col("n") > cell)
    cut = rows.join(hot, ["block", "value"], "left").select(
        "print", "doc", "block",
        F.when(F.col("n").isNull(), F.pmod(F.xxhash64("value"), F.lit(cells))).otherwise(-1 - F.col("value")).alias("cell"),
        F.coalesce(F.ceil(F.col("n") / (cell // 2)), F.lit(1)).cast("int").alias("shares"),
    ).withColumn("own", F.pmod(F.xxhash64("print"), F.col("shares")).cast("int"))
    pairs = F.expr("transform(sequence(0, shares - 1), k -> struct(least(own, k) AS i, greatest(own, k) AS j))")
    dealt = cut.select("print", "doc", "block", "cell", "own", F.explode(pairs).alias("c")).select(
        "print", "doc", "block", "cell", "c.i", "c.j", F.when(F.col("own") == F.col("c.i"), 0).otherwise(1).alias("side")
    )
    return dealt.groupBy("block", "cell", "i", "j").applyInPandas(lambda pdf: _cell_links(pdf, distance), "a long, b long")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, width: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document row."""
    prints = stored(fingerprints(docs, width, seed), "fingerprints")
    classes = stored(
        prints.where("doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("doc")), "fingerprint-classes"
    )
    # an id in several rows with different fingerprints ties their classes together
    twice = (
        prints.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("print").alias("p"), F.max("print").alias("q"))
        .where("p <> q")
    )
    tied = (
        prints.join(twice.select("doc_id"), "doc_id").join(classes, "print").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    )
    joined = components(links(classes, distance).unionByName(tied))
    owner = classes.join(joined, F.col("doc") == F.col("node"), "left").select(
        "print", F.coalesce("component", "doc").alias("component_id")
    )
    return prints.join(owner, "print", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
