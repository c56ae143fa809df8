"""Benchmark decontamination: token windows of documents against a hash set of benchmark n-grams.

Words are runs of ASCII digits, letters (A-Z lower-cased) and non-ASCII characters. A benchmark
item gives all its windows of ``width`` consecutive words; an item of fewer words, but not none,
is one window. The windows' 64-bit hashes are broadcast while their measured size is below
``BROADCAST_BYTES``; beyond it the windows of documents meet them in a shuffle join. Either way
a hash hit counts only once the words themselves are compared.

Null and empty texts have no words and are never hit. Repeated benchmark items hit under each of
their ids; those without an id hit like any other, count as one item together and give no name to
the hash of the ids. A repeated document row gives a repeated result row. An empty benchmark hits
nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.components import stored
from salesmart.llm.texts import LOWER, column, encoded, keyed, slices

WIDTH = 10
BROADCAST_BYTES = 64_000_000
MEDIUM = np.uint64(0x9E3779B97F4A7C15)  # odd multipliers of the polynomial hashes
LARGE = np.uint64(0xC2B2AE3D27D4EB4F)

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

HITS = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in lower-cased bytes; no word reaches across ``starts`` of texts."""
    inside = _WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = starts[(starts > 0) & (starts < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(begin):
        return np.zeros(0, np.uint64)
    length = end - begin
    # the letters of words only, one after another
    place = np.repeat(begin - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
    rank = place - np.repeat(begin, length)
    value = (data[place].astype(np.uint64) + np.uint64(1)) * _powers(int(length.max()), MEDIUM)[rank]
    return np.add.reduceat(value, np.cumsum(length) - length) * LARGE + length.astype(np.uint64)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on (places too near the end are left out)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * LARGE + words[j : j + n]
    return out ^ (out >> np.uint64(29))


class Words:
    """The words of several texts, with what a scan for windows needs."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"".join(texts).translate(LOWER)
        self.data = np.frombuffer(self.raw, np.uint8)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        self.begin, self.end = word_bounds(self.data, self.starts)
        # words before each text; text k holds words first[k] to first[k + 1]
        self.first = np.searchsorted(self.begin, np.concatenate((self.starts, ends[-1:])))
        self.hashes = word_hashes(self.data, self.begin, self.end)

    def window(self, at: int, width: int) -> bytes:
        return b" ".join(self.raw[a:b] for a, b in zip(self.begin[at : at + width], self.end[at : at + width], strict=True))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the windows that lie in one text."""
        hashes = window_hashes(self.hashes, width)
        place = np.arange(len(hashes))
        text = np.searchsorted(self.first, place, "right")
        whole = self.first[text] >= place + width
        return place[whole], hashes[whole]


class WindowSet:
    """Benchmark windows by width and hash, with the items that hold each."""

    def __init__(self, rows: list[tuple[int, int, bytes, list]]):
        self.by_hash: dict[tuple[int, int], list[tuple[bytes, list]]] = {}
        for width, hash_, window, items in rows:
            self.by_hash.setdefault((width, hash_), []).append((window, items))
        self.sorted = {
            w: np.sort(np.array([h for x, h in self.by_hash if x == w], np.int64).view(np.uint64))
            for w in {w for w, _ in self.by_hash}
        }

    def hits(self, words: Words) -> Iterator[tuple[int, int, list]]:
        """(place, width, items) of each window that occurs, the words compared."""
        for width, known in self.sorted.items():
            place, hashes = words.windows(width)
            at = np.searchsorted(known, hashes)
            at[at == len(known)] = 0
            for i in place[known[at] == hashes].tolist():
                text = words.window(i, width)
                hash_ = int(window_hashes(words.hashes[i : i + width], width).view(np.int64)[0])
                for window, items in self.by_hash[width, hash_]:
                    if window == text:
                        yield i, width, items


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(width, hash, window, items): distinct windows of the benchmark with the ids that hold them.

    ``items`` ends with a null where an item without an id holds the window.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: list[tuple] = []
            for item, text in zip(column(batch, "item_id").to_pylist(), encoded(column(batch, "text")), strict=True):
                words = Words([text])
                size = min(width, len(words.begin))
                if size:
                    hashes = window_hashes(words.hashes, size).view(np.int64).tolist()
                    found += {(size, h, words.window(i, size), item) for i, h in enumerate(hashes)}
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.string()))],
                ["width", "hash", "window", "item"],
            )

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    rows = items.mapInArrow(cut, "width int, hash long, window binary, item string")
    named = F.array_sort(F.collect_set("item"))
    unnamed = F.when(F.bool_or(F.col("item").isNull()), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
    return rows.groupBy("width", "hash", "window").agg(F.concat(named, unnamed).alias("items"))


def _by_broadcast(docs: DataFrame, windows: DataFrame, scan, schema: str) -> DataFrame:
    rows = [(r.width, r.hash, bytes(r.window), list(r["items"])) for r in windows.collect()]
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    sets: list[WindowSet] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not sets:
            sets.append(WindowSet(shared.value))
        for batch in slices(batches):
            words = Words(encoded(column(batch, "text")))
            yield scan(batch, words, sets[0].hits(words))

    return docs.mapInArrow(run, schema)


def _by_join(docs: DataFrame, windows: DataFrame, scan, schema: str) -> DataFrame:
    """Candidates of each document from a join on the hash; then each is checked against its own."""
    widths = [r.width for r in windows.select("width").distinct().collect()]  # at most ``width`` values
    row = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for key, text in zip(column(batch, "__row").to_pylist(), encoded(column(batch, "text")), strict=True):
                words = Words([text])
                for width in widths:
                    hashes = np.unique(words.windows(width)[1]).view(np.int64)
                    n = len(hashes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, key, np.int64)), pa.array(np.full(n, width, np.int32)), pa.array(hashes)],
                        ["__row", "width", "hash"],
                    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for i, own in enumerate(column(batch, "__own").to_pylist()):
                one = batch.slice(i, 1)
                words = Words(encoded(column(one, "text")))
                rows = [(x["width"], x["hash"], x["window"], x["items"]) for x in own or ()]
                yield scan(one, words, WindowSet(rows).hits(words))

    marked = docs.withColumn("__row", row)
    candidates = (
        marked.select("__row", "text").mapInArrow(cut, "__row long, width int, hash long")
        .join(windows, ["width", "hash"])
        .groupBy("__row").agg(F.collect_set(F.struct("width", "hash", "window", "items")).alias("__own"))
    )
    return marked.join(candidates, "__row", "left").mapInArrow(run, schema)


def _scan(docs: DataFrame, benchmark: DataFrame, scan, schema: str, width: int, limit: int) -> DataFrame:
    windows = stored(benchmark_windows(benchmark, width), "benchmark-windows")
    size = windows.agg(F.sum(F.length("window") + 8 * F.size("items") + 16)).first()[0] or 0
    return (_by_broadcast if size <= limit else _by_join)(docs, windows, scan, schema)


def find(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Per document row: words, words hit, items found (count, hash of their sorted ids)."""

    def scan(batch: pa.RecordBatch, words: Words, hits: Iterator[tuple[int, int, list]]) -> pa.RecordBatch:
        n = len(words.starts)
        cover = np.zeros(len(words.begin) + 1, np.int64)
        items: list[set] = [set() for _ in range(n)]
        for place, size, ids in hits:
            cover[place] += 1
            cover[place + size] -= 1
            items[int(np.searchsorted(words.first, place, "right")) - 1].update(ids)
        hit = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
        n_hit = hit[words.first[1:]] - hit[words.first[:-1]]
        sha = [hashlib.sha256(",".join(sorted(x - {None})).encode()).hexdigest() for x in items]
        return pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), pa.array(np.diff(words.first)), pa.array(n_hit), pa.array([len(x) for x in items], pa.int64()), pa.array(sha), pa.array(n_hit > 0)],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )

    return _scan(keyed(docs, "doc_id", "text"), benchmark, scan, HITS, width, limit)


def remove_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The documents without their hit words, and without what stands between two of them.

    Columns stay as they are, but for ``text`` and, if there is one, ``n_chars``. Texts without
    a hit keep every character; a null text stays null.
    """

    def scan(batch: pa.RecordBatch, words: Words, hits: Iterator[tuple[int, int, list]]) -> pa.RecordBatch:
        cover = np.zeros(len(words.begin) + 1, np.int64)
        for place, size, _ in hits:
            cover[place] += 1
            cover[place + size] -= 1
        hit = np.cumsum(cover[:-1]) > 0
        texts = column(batch, "text").to_pylist()
        for k in np.unique(np.searchsorted(words.first, np.flatnonzero(hit), "right") - 1).tolist():
            own = np.flatnonzero(hit[words.first[k] : words.first[k + 1]]) + words.first[k]
            raw, at, kept = texts[k].encode(), 0, []
            for run in np.split(own, np.flatnonzero(np.diff(own) > 1) + 1):
                kept.append(raw[at : int(words.begin[run[0]] - words.starts[k])])
                at = int(words.end[run[-1]] - words.starts[k])
            texts[k] = b"".join([*kept, raw[at:]]).decode()
        return pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()) if name == "text" else column(batch, name) for name in names], names
        )

    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    names, schema = docs.columns, docs.schema
    out = _scan(docs, benchmark, scan, schema, width, limit)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in names else out
