"""Ranked lexical search over an index partitioned by terms, through a pipeline of term owners.

Terms are maximal runs of characters other than ASCII marks, blanks and controls, A-Z lower-cased;
a null text has none. Every row of ``documents`` is a document of its own, and rows of ``benchmark``
that share an item id (or have none) are one item with all their terms, once each.

* One scan cuts the documents into blocks of ``BLOCK_DOCS`` rows at most and writes, for the terms
  the items hold, one postings row per block and term, and per block its ids. Numbers of documents,
  terms and holders are summed from all rows. Items are taken in blocks of ``ITEM_BLOCK`` items and
  ``ITEM_TERMS`` terms (one item may hold more), which bounds what is broadcast.
* Terms are dealt to ``OWNERS`` owners by falling weight, so that each owner has about four times
  the postings of the one before. A bundle is an item's sparse accumulators over one block: slots
  and integer sums. It goes through the owners in turn: a cogroup by block brings the bundles and
  one owner's postings together, adds that owner's integer contributions, and hands the bundles on.
* After each owner the ``TOP``-th best sum of an item is a lower bound of its final one. An
  accumulator that cannot reach it with all that later owners could still add is left behind; that
  is exact, ties included, since contributions are never negative.
* Last, the best of each bundle get their document ids and the first ``TOP`` of each item are taken
  (rows without an id come last among equals).

No group is larger than a block of documents times a block of items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.components import stored
from salesmart.llm.texts import column, encoded, keyed, slices

TOP = 50
OWNERS = 4
BLOCK_DOCS = 4096
ITEM_BLOCK = 1000
ITEM_TERMS = 100_000

#: The factor of the weight, and the numbers of the saturation formula.
SCALE, SHARE, FULL = 1000, 50, 100

_MARKS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(65, 91))
#: bytes.translate table: marks to blanks, A-Z lower-cased.
_PLAIN = bytes.maketrans(_MARKS + _UPPER, b" " * len(_MARKS) + _UPPER.lower())

_POSTINGS = "block long, term int, slots array<int>, counts array<int>, lengths array<int>, ids array<long>, n_docs long, n_terms long"
_BUNDLES = "block long, item int, slots array<int>, sums array<long>"


def terms(text: bytes) -> list[bytes]:
    """Terms of a text, in order, with repeats."""
    return text.translate(_PLAIN).split()


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The items with their distinct terms, in blocks of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(i, t) for i, x in zip(column(batch, "item_id").to_pylist(), encoded(column(batch, "text")), strict=True) for t in dict.fromkeys(terms(x))]
            ids, words = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(words, pa.binary())], ["item_id", "term"])

    plain = items.select(F.col("item_id").cast("long"), "text").mapInArrow(run, "item_id long, term binary").distinct()
    found: list[tuple[int | None, list[bytes]]] = []
    held, at = 0, ()
    for r in stored(plain, "search-items").orderBy("item_id", "term").toLocalIterator():
        if (r.item_id,) != at:
            if len(found) >= ITEM_BLOCK or held >= ITEM_TERMS:
                yield found
                found, held = [], 0
            at = (r.item_id,)
            found.append((r.item_id, []))
        found[-1][1].append(bytes(r.term))
        held += 1
    if found:
        yield found


def _index(docs: DataFrame, numbers: dict[bytes, int], block_docs: int) -> DataFrame:
    """Postings of the numbered terms, block by block; the row of a block without a term holds its ids and totals."""
    names = [x.split()[0] for x in _POSTINGS.split(", ")]
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    kinds = (pa.int64(), pa.int32(), ints, ints, ints, longs, pa.int64(), pa.int64())
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = shared.value, TaskContext.get().partitionId() << 32
        for batch in slices(batches):
            for at in range(0, batch.num_rows, block_docs):
                part = batch.slice(at, block_docs)
                own: dict[int, tuple[list[int], list[int], list[int]]] = {}
                holding = total = 0
                for slot, text in enumerate(encoded(column(part, "text"))):
                    words = terms(text)
                    holding += bool(words)
                    total += len(words)
                    for word, n in Counter(filter(known.__contains__, words)).items():
                        lists = own.setdefault(known[word], ([], [], []))
                        for values, value in zip(lists, (slot, n, len(words)), strict=True):
                            values.append(value)
                rows = [(block, t, *lists, None, None, None) for t, lists in own.items()]
                rows.append((block, None, None, None, None, column(part, "doc_id").to_pylist(), holding, total))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                block += 1

    return stored(keyed(docs, "doc_id", "text").mapInArrow(run, _POSTINGS), "search-index")


def saturated(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 20 m) with m = 100 - 50 + (50 n N) div L, in 64-bit integers."""
    m = FULL - SHARE + (SHARE * lengths.astype(np.int64) * n_docs) // n_terms
    counts = counts.astype(np.int64)
    return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


def _owners(sizes: list[tuple[int, int, int]], owners: int) -> dict[int, int]:
    """Owner of each term from (term, weight, holders): by falling weight, each with about four times the postings before."""
    ordered = sorted(sizes, key=lambda x: (-x[1], x[0]))
    whole, so_far, out = sum(n for _, _, n in sizes), 0, {}
    for term, _, n in ordered:
        so_far += n
        share = so_far / whole
        out[term] = next(k for k in range(owners) if k == owners - 1 or share <= 4.0 ** (k + 1 - owners))
    return out


def _stage(bundles: DataFrame | None, postings: DataFrame, state: dict) -> DataFrame:
    """The bundles after one owner. ``state`` has, by item, its terms with this owner, the least sum it needs
    before the owner's share is added, and the same after it."""
    n_docs, n_terms = state["totals"]
    weights, held, floors = state["weights"], state["held"], state["floors"]

    def run(own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        gains = {}
        for term, slots, counts, lengths in zip(found["term"], found["slots"], found["counts"], found["lengths"], strict=True):
            gains[term] = (np.asarray(slots), weights[term] * saturated(np.asarray(counts), np.asarray(lengths), n_docs, n_terms))
        before = {i: (np.asarray(s), np.asarray(v)) for i, s, v in zip(own["item"], own["slots"], own["sums"], strict=True)}
        block = int(own["block"].iloc[0] if len(own) else found["block"].iloc[0])
        rows = []
        for item in held.keys() | before.keys():
            parts = [before[item]] if item in before else []
            parts += [gains[t] for t in held.get(item, ()) if t in gains]
            if not parts:
                continue
            slots = np.concatenate([s for s, _ in parts])
            values = np.concatenate([v for _, v in parts])
            sums = np.zeros(int(slots.max()) + 1, np.int64)
            np.add.at(sums, slots, values)
            kept = np.flatnonzero((sums > 0) & (sums >= floors.get(item, 0)))
            if len(kept):
                rows.append((block, item, kept.astype(np.int32), sums[kept]))
        return pd.DataFrame(rows, columns=["block", "item", "slots", "sums"])

    if bundles is None:
        bundles = postings.sparkSession.createDataFrame([], _BUNDLES)
    return bundles.groupBy("block").cogroup(postings.groupBy("block")).applyInPandas(run, _BUNDLES)


def _bounds(bundles: DataFrame, top: int) -> dict[int, int]:
    """By item, its ``top``-th best sum so far, where it has that many documents. One row an item reaches the driver."""
    best = bundles.select("item", F.explode(F.slice(F.sort_array("sums", False), 1, top)).alias("sum"))
    order = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("sum")))
    return {r.item: r["sum"] for r in best.withColumn("n", order).where(F.col("n") <= top).where(F.col("n") == top).collect()}


def _ranked(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], top: int, owners: int, block_docs: int) -> DataFrame:
    spark = docs.sparkSession
    numbers = {t: k for k, t in enumerate(sorted({t for _, own in items for t in own}))}
    index = _index(docs, numbers, block_docs)
    totals = index.where("term IS NULL").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = int(totals[0] or 0), int(totals[1] or 0)
    stats = index.where("term IS NOT NULL").groupBy("term").agg(
        F.sum(F.size("slots")).alias("df"), F.max(F.array_max("counts")).alias("most"), F.min(F.array_min("lengths")).alias("least")
    )
    weights, most, sizes = {}, {}, []
    for r in stats.collect():  # at most one row for each term of the items
        weight = math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
        if weight > 0:
            weights[r.term] = weight
            most[r.term] = weight * int(saturated(np.array([r.most]), np.array([r.least]), n_docs, n_terms)[0])
            sizes.append((r.term, weight, r.df))
    owner = _owners(sizes, owners)
    pairs = spark.createDataFrame(pd.DataFrame({"term": list(owner), "owner": list(owner.values())}), "term int, owner int") if owner else None
    bundles, bounds = None, {}
    for k in sorted(set(owner.values())):
        held = {i: [n for t in own if owner.get(n := numbers[t]) == k] for i, (_, own) in enumerate(items)}
        later = {i: sum(most[n] for t in own if owner.get(n := numbers[t], -1) > k) for i, (_, own) in enumerate(items)}
        state = {
            "totals": (n_docs, n_terms), "weights": {t: weights[t] for t, o in owner.items() if o == k},
            "held": {i: x for i, x in held.items() if x}, "floors": {i: bound - later[i] for i, bound in bounds.items()},
        }
        postings = index.join(pairs.where(F.col("owner") == k).select("term"), "term").select("block", "term", "slots", "counts", "lengths")
        bundles = stored(_stage(bundles, postings, state), f"search-owner-{k}")
        bounds = _bounds(bundles, top)
    schema = "item_id long, rank int, doc_id long, score long"
    if bundles is None:
        return spark.createDataFrame([], schema)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    floors = spark.createDataFrame([(i, int(b)) for i, b in bounds.items()], "item int, floor long")
    best = bundles.join(F.broadcast(floors), "item", "left").join(F.broadcast(names), "item")  # a row an item: bounded by ITEM_BLOCK
    one = F.filter(F.arrays_zip("slots", "sums"), lambda x: x["sums"] >= F.coalesce("floor", F.lit(0)))
    found = best.select("block", "item_id", F.explode(one).alias("x")).select("block", "item_id", F.col("x.slots").alias("slot"), F.col("x.sums").alias("score"))
    ids = index.where("term IS NULL").select("block", F.posexplode("ids").alias("slot", "doc_id"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.join(ids, ["block", "slot"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item with a score above 0."""
    found = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in _item_blocks(items):
        found = found.unionByName(_ranked(docs, block, top, owners, block_docs))
    return found
