"""Phrase collocations by count streams in prefix and suffix order.

Texts (null: empty) are lower-cased A-Z, cut at ``.,;:!?`` and line breaks into pieces, and those at
blanks and tabs into words. Everything is counted per language (null: ``und``); ids, other columns
and repeated rows play no part but as text. A phrase is 2 to ``LONGEST`` words of one piece.

Counting goes by length. Words are counted first. A phrase is frequent only if the phrases without
its last and without its first word are, so the next scan sends on only those whose two parts are
in a bit filter of the frequent phrases one word shorter. The filter has a fixed size
(``FILTER_BITS``); what it lets through in vain is counted and falls to the threshold, so the
counts are exact, and a fuller filter only costs traffic. Counts are combined in the batch, in the
task, and then by phrase. Beyond pairs only stretches of frequent pairs are read again.

The frequent phrases then lie in two streams of sorted ranges: by words (prefix order) and by words
backwards (suffix order). In the first, the leading parts of a phrase stand just before it, so one
walk with a stack of at most ``LONGEST`` open phrases gives the count of every leading part, and
tells every phrase whether an extension to the right is as frequent; the second does the same for
trailing parts and extensions to the left. A range that begins within a phrase's extensions gets
that phrase as context. The streams are merged by phrase, with sort-merge joins, for the scores.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.components import stored
from salesmart.llm.texts import column, encoded, slices

LONGEST = 5
LEAST = 100
TOP = 2000
FILTER_BITS = 2**26
#: Bytes of text counted at once.
GATHERED = 8_000_000
#: Rows drawn for each range of a stream to find its bounds.
DRAWN = 50

_CUTS = b".,;:!?\x0a\x0b\x0c\x0d"
_UPPER = bytes(range(65, 91))
_STOP = b"\xff"  # never in UTF-8
_PLAIN = bytes.maketrans(_CUTS + _UPPER, _STOP * len(_CUTS) + _UPPER.lower())
_FOLD = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)

_COUNTS = "lang string, phrase string, n long"


def _mixed(value: np.ndarray) -> np.ndarray:
    value = value * _FOLD
    return value ^ (value >> _HALF)


def _grown(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of the phrase without its last word, and that of the last word."""
    return _mixed(left ^ (word + (left << np.uint64(7))))


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash."""
    return hashes & np.uint64(bits - 1), (hashes >> np.uint64(31)) & np.uint64(bits - 1)


def phrase_hashes(words: list[list[bytes]], langs: list[str], hash_of) -> np.ndarray:
    """Hashes of phrases of equal length."""
    columns = np.array([[hash_of(w) for w in x] for x in words], np.uint64).reshape(len(words), -1)
    value = np.array([hash_of(x.encode()) for x in langs], np.uint64)
    return reduce(_grown, columns.T, value)


class _Hashes(dict):
    """Hashes of the words met so far, up to a bounded number."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < 500_000 and len(word) < 64:
            self[word] = value
        return value


def _filter(frequent: DataFrame, bits: int) -> np.ndarray:
    """Bit filter of all frequent phrases of one length, ``bits`` / 8 bytes whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of = _Hashes().__getitem__
        for batch in batches:
            if not batch.num_rows:
                continue
            words = [p.split(b" ") for p in encoded(column(batch, "phrase"))]
            places = np.concatenate(_places(phrase_hashes(words, column(batch, "lang").to_pylist(), hash_of), bits))
            at, which = np.unique(places >> np.uint64(6), return_inverse=True)
            values = np.zeros(len(at), np.uint64)
            np.bitwise_or.at(values, which, np.uint64(1) << (places & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(values.view(np.int64))], ["at", "bits"])

    words = frequent.mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    found = np.zeros(bits // 64, np.uint64)
    rows = words.toArrow()  # at most bits / 64 rows
    found[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return found


def _held(table: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    a, b = _places(hashes, bits)
    one = np.uint64(1)
    return ((table[a >> np.uint64(6)] >> (a & np.uint64(63))) & (table[b >> np.uint64(6)] >> (b & np.uint64(63))) & one).astype(bool)


def _tokens(text: bytes) -> tuple[np.ndarray, pa.Array]:
    """Word numbers in order, 0 for the end of a piece, and the words by number."""
    joined = b"\xff " + text.translate(_PLAIN).replace(_STOP, b" \xff ") + b" \xff"  # a blank at an end would make an empty word
    ends = pa.py_buffer(np.array([0, len(joined)], np.int64))
    whole = pa.Array.from_buffers(pa.large_string(), 1, [None, ends, pa.py_buffer(joined)])
    words = pc.ascii_split_whitespace(whole).values.dictionary_encode()
    return words.indices.to_numpy(), words.dictionary.view(pa.large_binary())  # the first word met is the mark


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """The texts joined by language, about ``GATHERED`` bytes at a time."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in slices(batches):
        for lang, text in zip(column(batch, "lang").to_pylist(), encoded(column(batch, "text")), strict=True):
            held.setdefault(lang, []).append(text)
            size += len(text)
        if size >= GATHERED:
            yield from ((lang, _STOP.join(own)) for lang, own in held.items())
            held, size = {}, 0
    yield from ((lang, _STOP.join(own)) for lang, own in held.items())


def _inside(ids: np.ndarray, width: int) -> np.ndarray:
    """Whether the ``width`` words from a place on are of one piece."""
    words = ids > 0
    found = words[: max(0, len(ids) - width + 1)].copy()
    for k in range(1, width):
        found &= words[k : len(found) + k]
    return found


def _maybe_frequent(lang: str, ids: np.ndarray, words: pa.Array, width: int, table: np.ndarray, bits: int, hashes: _Hashes) -> np.ndarray:
    """Whether the filter holds the phrase of ``width`` words from a place on."""
    start = np.uint64(hashes[lang.encode()])
    value = np.array([hashes[w] for w in words.to_pylist()], np.uint64)
    parts = _grown(start, value)  # phrases of one word, by number
    if width == 1:
        return _held(table, parts, bits)[ids]
    parts, value = parts[ids], value[ids]
    for k in range(1, width):
        parts = _grown(parts[:-1], value[k:])
    return _held(table, parts, bits)


def _counted(texts: DataFrame, width: int, shorter: np.ndarray | None, bits: int) -> DataFrame:
    """(lang, phrase, n) of the phrases of ``width`` words whose two shorter parts may be frequent."""
    shared = None if shorter is None else texts.sparkSession.sparkContext.broadcast(shorter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for lang, text in _by_language(batches):
            ids, words = _tokens(text)
            ids = ids.astype(np.int64)
            if len(ids) < width:
                continue
            at = _inside(ids, width)
            if width > 1:
                good = _maybe_frequent(lang, ids, words, width - 1, shared.value, bits, hashes)
                at &= good[:-1] & good[1:]
            at = np.flatnonzero(at)
            code, most = ids[at], len(words)
            for k in range(1, width):
                if most > 2**62 // len(words):  # number the phrases so far, so that they fit 64 bits
                    code = np.unique(code, return_inverse=True)[1].astype(np.int64)
                    most = len(code)
                code, most = code * len(words) + ids[at + k], most * len(words)
            _, first, n = np.unique(code, return_index=True, return_counts=True)
            if len(n):
                parts = [words.take(pa.array(ids[at[first] + k])) for k in range(width)]
                phrases = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if width > 1 else parts[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(n)), phrases.cast(pa.large_string()).cast(pa.string()), pa.array(n.astype(np.int64))], ["lang", "phrase", "n"]
                )

    return texts.mapInArrow(run, _COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _stretches(texts: DataFrame, pairs: np.ndarray, bits: int) -> DataFrame:
    """(lang, text) with only the stretches of three words or more whose pairs may all be frequent: longer
    frequent phrases lie in them, each occurrence in one."""
    shared = texts.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for lang, text in _by_language(batches):
            ids, words = _tokens(text)
            ids = ids.astype(np.int64)
            if len(ids) < 3:
                continue
            good = _inside(ids, 2) & _maybe_frequent(lang, ids, words, 2, shared.value, bits, hashes)
            kept = np.zeros(len(ids) + 1, bool)  # places in a stretch; one more place, not kept, follows
            for k in range(3):
                kept[k : len(good) - 1 + k] |= good[:-1] & good[1:]
            ids = np.where(kept[:-1], ids, 0)
            # a stretch also ends where the pair of its last word and the next one is not frequent
            cut = np.zeros(len(ids), bool)
            cut[1:] = (ids[1:] > 0) & (ids[:-1] > 0) & ~good
            ids = np.insert(ids, np.flatnonzero(cut), 0)
            ids = ids[(ids > 0) | np.append(ids[1:] > 0, False)]  # one mark between stretches is enough
            marked = pa.concat_arrays([pa.array([b"."], pa.large_binary()), words[1:]])
            if len(ids):
                taken = pa.LargeListArray.from_arrays(pa.array([0, len(ids)], pa.int64()), marked.take(pa.array(ids)))
                joined = pc.binary_join(taken, pa.scalar(b" ", pa.large_binary()))
                yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), joined.cast(pa.large_string()).cast(pa.string())], ["lang", "text"])

    return texts.mapInArrow(run, "lang string, text string")


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of all phrases and words met ``least`` times or more, and (lang, n) of all words."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    counts = stored(_counted(texts, 1, None, bits), "phrase-counts")
    totals = stored(counts.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    found = []
    for width in range(1, longest + 1):
        if width > 1:
            shorter = _filter(found[-1], bits)
            if width == 3:
                texts = stored(_stretches(texts, shorter, bits), "phrase-stretches")
            counts = _counted(texts, width, shorter, bits)
        found.append(stored(counts.where(F.col("n") >= least), "phrase-frequent"))
        if found[-1].isEmpty():
            break
    every = reduce(DataFrame.unionByName, found)
    return every.select("lang", F.split("phrase", " ", -1).alias("words"), F.col("n").alias("f")), totals


def _stream(counts: DataFrame, ranges: int) -> DataFrame:
    """One row per phrase of two words or more, from the walk in the order of ``words``: (lang, words, f,
    counts of its leading parts from one word on), and a row without counts for every phrase that an
    extension equals in frequency."""
    total = counts.count()
    drawn = counts.sample(min(1.0, ranges * DRAWN / max(total, 1)), seed=1).select("lang", "words")
    heads = sorted((r.lang.encode(), [w.encode() for w in r.words]) for r in drawn.collect())  # about ranges * DRAWN rows
    bounds = heads[DRAWN::DRAWN]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ranges = [], []
            for k, (lang, words) in enumerate(zip(column(batch, "lang").to_pylist(), column(batch, "words").to_pylist(), strict=True)):
                key = (lang.encode(), [w.encode() for w in words])
                at = bisect_right(bounds, key)
                rows.append(k)
                ranges.append((at, True))
                # the ranges that begin within this phrase's extensions need it as context
                while at < len(bounds) and bounds[at][0] == key[0] and bounds[at][1][: len(words)] == key[1]:
                    at += 1
                    rows.append(k)
                    ranges.append((at, False))
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array([a for a, _ in ranges], pa.int32()), pa.array([o for _, o in ranges], pa.bool_())],
                [*taken.schema.names, "range", "own"],
            )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, int]] = []
        at: tuple | None = None
        for batch in batches:
            out: list[tuple] = []
            columns = (column(batch, c).to_pylist() for c in ("range", "lang", "words", "f", "own"))
            for where, lang, words, f, own in zip(*columns, strict=True):
                if (where, lang) != at:
                    at, stack = (where, lang), []
                same = 0
                while same < len(stack) and same < len(words) and stack[same][0] == words[same]:
                    same += 1
                del stack[same:]
                if own and len(words) > 1:
                    out.append((lang, words, f, [n for _, n in stack]))
                    if len(words) > 2 and stack[-1][1] == f:
                        out.append((lang, words[:-1], None, None))
                stack.append((words[-1], f))
            kinds = (pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["lang", "words", "f", "parts"])

    dealt = counts.select("lang", "words", "f").mapInArrow(deal, "lang string, words array<string>, f long, range int, own boolean")
    ordered = dealt.repartition("range").sortWithinPartitions("range", "lang", "words", "own")
    return stored(ordered.mapInArrow(walk, "lang string, words array<string>, f long, parts array<long>"), "phrase-stream")


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in decimals of 38 digits."""
    wide = [x.cast("decimal(38,0)") for x in (a, n, left, right)]
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide[0] * wide[1], wide[2] * wide[3])


def mine(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, bits: int = FILTER_BITS, ranges: int | None = None
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase is met ``least`` times or more. Its score is the least of its cuts (the first of equals).
    It is left out where a longer phrase around it is met as often, which is the case just if one that
    is longer by one word is.
    """
    counts, totals = frequent_phrases(docs, longest, least, bits)
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    forward = _stream(counts, ranges)
    backward = _stream(counts.withColumn("words", F.reverse("words")), ranges).withColumn("words", F.reverse("words"))
    key = ["lang", "words"]
    covered = forward.where("parts IS NULL").select(key).unionByName(backward.where("parts IS NULL").select(key)).distinct()
    left = forward.where("parts IS NOT NULL").withColumnRenamed("parts", "left")
    right = backward.where("parts IS NOT NULL").select(*key, F.reverse("parts").alias("right"))
    both = left.join(right.hint("merge"), key).join(covered.hint("merge"), key, "left_anti").join(totals, "lang")
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("left")),
        lambda k: F.struct(
            _score(F.col("f"), F.col("n"), F.get("left", k - 1), F.get("right", k - 1)).alias("score"),
            k.alias("k"), F.get("left", k - 1).alias("l"), F.get("right", k - 1).alias("r"),
        ),
    )
    scored = both.withColumn("cut", F.array_min(cuts)).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
