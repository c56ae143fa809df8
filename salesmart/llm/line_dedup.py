"""Reversible line deduplication: exact reference counts behind sharded cuckoo filters.

A text is split at line feeds; null and empty texts are one empty line. A line's key is the line
without ASCII white space at both ends, A-Z lower-cased; keys of fewer than ``MIN_LENGTH`` code
points are never shared. A key held by two documents or more loses all its lines except in the
document with the smallest id. ``doc_id`` names a document: rows that repeat an id count once for
the counts, and each of them is answered. Rows without an id keep all their lines.

``LineStore`` keeps three tables in the shared folder: ``postings`` (key, doc_id), ``counts``
(key, documents, smallest document), both exact, and ``filters``, one cuckoo filter per shard of
keys that at least two documents hold. Documents can be added and taken out in batches, and a
deletion brings back lines whose other holder went. Filters answer most lines without touching
the exact tables: only lines that a filter may hold are shuffled to them. Filters are broadcast, at
most ``BROADCAST_BYTES`` of them at a time: where they are larger, the keys of the documents are
written once, dealt by groups of shards without an exchange, and each group is asked with the
broadcast of its own filters, one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.components import stored
from salesmart.llm.cuckoo import CuckooFilter
from salesmart.llm.texts import LOWER, column, encoded, keyed, slices
from salesmart.session import new_folder

MIN_LENGTH = 10
SHARD_KEYS = 65_536
BROADCAST_BYTES = 64_000_000

_KEYS = "doc_id long, hi long, lo long"
_FILTER = "shard int, table binary, overflow binary"


def line_key(line: bytes, least: int = MIN_LENGTH) -> bytes | None:
    """Key of a line, None where it is too short."""
    key = line.strip()  # of bytes: ASCII white space only
    if len(key) < least:
        return None
    if len(key) < 4 * least and len(key.decode("utf-8", "surrogatepass")) < least:
        return None
    return key.translate(LOWER)


def _hashes(text: bytes, least: int) -> list[bytes | None]:
    return [None if (k := line_key(x, least)) is None else xxhash.xxh3_128_digest(k) for x in text.split(b"\n")]


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _shard(n: int) -> Column:
    return F.pmod(F.shiftright("hi", 7), F.lit(n)).cast("int")


def _keys(docs: DataFrame, least: int, keep) -> DataFrame:
    """(doc_id, key) once per document row, of the keys for which ``keep`` answers True."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, digests = [], []
            for doc, text in zip(column(batch, "doc_id").to_pylist(), encoded(column(batch, "text")), strict=True):
                own = set(_hashes(text, least)) - {None}
                ids += [doc] * len(own)
                digests += own
            hi, lo = _halves(digests)
            which = keep(hi, lo)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(ids, np.int64)[which]), pa.array(hi[which]), pa.array(lo[which])], ["doc_id", "hi", "lo"]
            )

    return keyed(docs, "doc_id", "text").where("doc_id IS NOT NULL").mapInArrow(run, _KEYS)


class LineStore:
    """State of the documents added so far."""

    def __init__(self, spark: SparkSession, least: int = MIN_LENGTH, broadcast: int = BROADCAST_BYTES):
        self.spark, self.least, self.broadcast = spark, least, broadcast
        self.postings = spark.createDataFrame([], _KEYS)
        self.counts = spark.createDataFrame([], "hi long, lo long, n_docs long, first_doc long")
        self.filters = spark.createDataFrame([], _FILTER)
        self.shards, self.empty = 1, True

    @staticmethod
    def _counted(postings: DataFrame) -> DataFrame:
        return postings.groupBy("hi", "lo").agg(F.count("doc_id").alias("n_docs"), F.min("doc_id").alias("first_doc"))

    def _rebuild(self, shared: DataFrame, shards: int) -> None:
        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            own = CuckooFilter.sized(len(pdf))
            own.insert(pdf["hi"].to_numpy(), pdf["lo"].to_numpy())
            table, overflow = own.dump()
            return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "table": [table], "overflow": [overflow]})

        self.shards = shards
        keys = shared.select("hi", "lo").withColumn("shard", _shard(shards))
        self.filters = stored(keys.groupBy("shard").applyInPandas(build, _FILTER), "line-filters")

    def _change(self, gone: DataFrame, come: DataFrame) -> None:
        """Takes keys out of the filters and puts others in, shard by shard."""

        def apply(keys: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
            shard = int(keys["shard"].iloc[0] if len(keys) else state["shard"].iloc[0])
            if len(state):
                own = CuckooFilter.load(state["table"].iloc[0], state["overflow"].iloc[0])
            else:
                own = CuckooFilter.sized(SHARD_KEYS)
            for sign, change in ((-1, own.delete), (1, own.insert)):
                part = keys[keys["sign"] == sign]
                change(part["hi"].to_numpy(), part["lo"].to_numpy())
            table, overflow = own.dump()
            return pd.DataFrame({"shard": [shard], "table": [table], "overflow": [overflow]})

        changes = (
            gone.select("hi", "lo", F.lit(-1).alias("sign")).unionByName(come.select("hi", "lo", F.lit(1).alias("sign")))
            .withColumn("shard", _shard(self.shards))
        )
        out = changes.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(apply, _FILTER)
        self.filters = stored(out, "line-filters")

    def _put(self, postings: DataFrame, touched: DataFrame | None) -> None:
        """New postings; counts are formed anew for the touched keys alone (all where None)."""
        before, self.postings = self.counts, postings
        if touched is None:
            self.counts = stored(self._counted(postings), "line-counts")
        else:
            fresh = stored(self._counted(postings.join(touched, ["hi", "lo"], "left_semi")), "line-counts-part")
            self.counts = stored(before.join(touched, ["hi", "lo"], "left_anti").unionByName(fresh), "line-counts")
        shared = self.counts.where("n_docs > 1")
        needed = max(1, -(-shared.count() // SHARD_KEYS))
        if touched is None or needed > self.shards:
            self._rebuild(shared, needed)
        else:
            old = before.where("n_docs > 1").join(touched, ["hi", "lo"], "left_semi")
            new = fresh.where("n_docs > 1")
            self._change(old.join(new, ["hi", "lo"], "left_anti"), new.join(old, ["hi", "lo"], "left_anti"))

    def insert(self, docs: DataFrame) -> None:
        """Adds documents; ids already present gain the lines that are new to them."""
        new = _keys(docs, self.least, lambda hi, lo: np.ones(len(hi), bool))
        if self.empty:
            self._put(stored(new.distinct(), "line-postings"), None)
            self.empty = False
            return
        new = stored(new.distinct().join(self.postings, ["doc_id", "hi", "lo"], "left_anti"), "line-postings-part")
        self._put(stored(self.postings.unionByName(new), "line-postings"), new.select("hi", "lo").distinct())

    def delete(self, ids: DataFrame) -> None:
        """Takes out the documents whose ``doc_id`` the frame lists; unknown ids are ignored."""
        ids = ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        gone = stored(self.postings.join(ids, "doc_id", "left_semi").select("hi", "lo").distinct(), "line-touched")
        self._put(stored(self.postings.join(ids, "doc_id", "left_anti"), "line-postings"), gone)

    def _probe(self, filters: DataFrame):
        """Answers which keys these filters may hold; the filters travel as one broadcast."""
        rows = {r.shard: (bytes(r.table), bytes(r.overflow)) for r in filters.collect()}
        shared, shards, loaded = self.spark.sparkContext.broadcast(rows), self.shards, {}

        def probe(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
            if not loaded:
                loaded.update({k: CuckooFilter.load(*v) for k, v in shared.value.items()})
            shard, found = (hi >> 7) % shards, np.zeros(len(hi), bool)
            for k in np.unique(shard).tolist():
                if k in loaded:
                    own = shard == k
                    found[own] = loaded[k].contains(hi[own], lo[own])
            return found

        return probe, shared

    def _maybe_shared(self, docs: DataFrame) -> DataFrame:
        size = self.filters.agg(F.sum(F.length("table") + F.length("overflow"))).first()[0] or 0
        groups = min(self.shards, max(1, -(-size // max(1, self.broadcast))))
        if groups == 1:
            return _keys(docs, self.least, self._probe(self.filters)[0])
        group = lambda shard: F.pmod(shard, F.lit(groups)).cast("int")
        place = new_folder(self.spark, "line-keys")
        keys = _keys(docs, self.least, lambda hi, lo: np.ones(len(hi), bool))
        keys.withColumn("part", group(_shard(self.shards))).write.partitionBy("part").parquet(place)
        # each group's answer is written before the next group's filters are sent
        found = new_folder(self.spark, "line-keys-found")
        for k in range(groups):
            probe, sent = self._probe(self.filters.where(group(F.col("shard")) == k))

            def run(batches: Iterator[pa.RecordBatch], probe=probe) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    hi, lo = (column(batch, c).to_numpy(zero_copy_only=False) for c in ("hi", "lo"))
                    yield batch.filter(pa.array(probe(hi, lo)))

            own = self.spark.read.schema(f"{_KEYS}, part int").parquet(place).where(F.col("part") == k)
            own.select("doc_id", "hi", "lo").mapInArrow(run, _KEYS).write.parquet(f"{found}/part={k}")
            sent.destroy()
        return self.spark.read.schema(f"{_KEYS}, part int").parquet(found).drop("part")

    def lost_lines(self, docs: DataFrame) -> DataFrame:
        """(doc_id, lost): packed 128-bit keys that each document gives up, for documents that do."""
        shared = self.counts.where("n_docs > 1").select("hi", "lo", "first_doc")
        lost = self._maybe_shared(docs).join(shared, ["hi", "lo"]).where("doc_id <> first_doc")
        return lost.groupBy(F.col("doc_id").alias("__lost_doc")).agg(F.collect_set(F.struct("hi", "lo")).alias("__lost"))

    def dedup(self, docs: DataFrame) -> DataFrame:
        """All columns of ``docs`` with the kept text, and ``n_lines``, ``n_dropped`` of the old one.

        A text that loses nothing stays as it is (null included); one that loses all is empty.
        The two new columns replace any of the same name.
        """
        least = self.least
        docs = docs.drop("n_lines", "n_dropped").withColumn("doc_id", F.col("doc_id").cast("long"))
        names = docs.columns
        joined = docs.join(self.lost_lines(docs), F.col("doc_id") == F.col("__lost_doc"), "left").drop("__lost_doc")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                texts = column(batch, "text").to_pylist()
                lost = column(batch, "__lost")
                lines, dropped = [], []
                for i, (text, has) in enumerate(zip(texts, lost.is_valid().to_pylist(), strict=True)):
                    if not has:
                        lines.append((text or "").count("\n") + 1)
                        dropped.append(0)
                        continue
                    raw = text.encode()
                    gone = {x["hi"].to_bytes(8, "big", signed=True) + x["lo"].to_bytes(8, "big", signed=True) for x in lost[i].as_py()}
                    kept = [x for x, h in zip(raw.split(b"\n"), _hashes(raw, least), strict=True) if h not in gone]
                    lines.append(raw.count(b"\n") + 1)
                    dropped.append(lines[-1] - len(kept))
                    texts[i] = b"\n".join(kept).decode()
                arrays = [pa.array(texts, pa.string()) if n == "text" else column(batch, n) for n in names]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], [*names, "n_lines", "n_dropped"])

        out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        return joined.mapInArrow(run, f"{out}, n_lines long, n_dropped long")


def dedup_once(docs: DataFrame) -> DataFrame:
    """Adds all documents to an empty store and answers the same documents."""
    store = LineStore(docs.sparkSession)
    store.insert(docs)
    return store.dedup(docs)


def digest(deduped: DataFrame) -> DataFrame:
    """Per document: line counts and the hash of the kept text."""
    return deduped.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )

