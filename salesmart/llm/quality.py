"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score(x) = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where the pairwise part is
computed in linear time as half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Features are the counts of white-space separated words, A-Z lower-cased and hashed into ``BUCKETS``
places and damped by the text's length; statistics of the text's structure (shares of letters,
capitals, digits, marks, table bars, repeated marks and repeated words, lengths of words and lines);
and, as metadata, whether the table's ``n_chars`` agrees with the text. Labels, language, source and
document id are no features.

The model is fitted on at most ``SAMPLE`` labelled rows, those with the smallest hash of their id:
their features, of fixed length, are the only thing that reaches the driver. Everything is seeded,
so the same rows give the same model. Without any labelled row of both classes the score is the
share of label 1 (one half if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.texts import LOWER, column, encoded, slices

BUCKETS = 2048
RANK = 8
SAMPLE = 6000
EPOCHS = 20
THRESHOLD = 0.3
SEED = 11

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_KINDS = np.zeros(256, np.uint8)  # 0 other, 1 lower case, 2 capital, 3 digit, 4 white space, 5 mark, 6 non-ASCII
_KINDS[97:123], _KINDS[65:91], _KINDS[48:58] = 1, 2, 3
_KINDS[list(b" \t\n\v\f\r")] = 4
_KINDS[list(_MARKS)] = 5
_KINDS[128:] = 6
_SINGLE = b"|!#$%&*.,"
STATISTICS = 6 + len(_SINGLE) + 11
WIDTH = BUCKETS + STATISTICS
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(63, _ODD))))


def features(texts: list[bytes], n_chars: list[int | None]) -> np.ndarray:
    """One row of ``WIDTH`` features for each text."""
    n = len(texts)
    raw = b"".join(t + b" " for t in texts)  # the blank ends each text's last word
    plain = np.frombuffer(raw, np.uint8)
    lower = np.frombuffer(raw.translate(LOWER), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(size + 1) - size - 1
    kind = _KINDS[plain]
    inside = kind != 4
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(start, begin, "right") - 1
    out = np.zeros((n, WIDTH), np.float32)
    words = np.bincount(owner, minlength=n).astype(float)
    repeats = kinds_of_words = np.zeros(n)
    if len(begin):
        # hash of a word: its first 64 bytes and its length
        length = end - begin
        short = np.minimum(length, 64)
        rank = np.arange(short.sum()) - np.repeat(np.cumsum(short) - short, short)
        value = (lower[np.repeat(begin, short) + rank].astype(np.uint64) + np.uint64(1)) * _POWERS[rank]
        hashed = np.add.reduceat(value, np.cumsum(short) - short) + length.astype(np.uint64)
        hashed = (hashed ^ (hashed >> np.uint64(29))) * _ODD
        bucket = (hashed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
        counts = np.bincount(owner * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
        out[:, :BUCKETS] = np.sqrt(counts / np.maximum(words, 1)[:, None])
        again = (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])
        repeats = np.bincount(owner[1:][again], minlength=n) / np.maximum(words, 1)
        kinds_of_words = (counts > 0).sum(axis=1) / np.maximum(np.minimum(words, BUCKETS), 1)
    total = np.maximum(size, 1).astype(float)
    column_ = BUCKETS

    def put(value: np.ndarray) -> None:
        nonlocal column_
        out[:, column_] = value
        column_ += 1

    def per_text(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return sums[start + size] - sums[start]

    by_kind = [per_text(kind == k) for k in range(1, 7)]
    for k, found in enumerate(by_kind):
        put(found / total if k != 3 else np.minimum(found / total, 1) * 2)
    for mark in _SINGLE:
        put(np.minimum(per_text(plain == mark) / total * 10, 3))
    lines = per_text(plain == 10) + 1
    letters = np.maximum(by_kind[0] + by_kind[1] + by_kind[5], 1)
    doubled = np.zeros(len(plain), bool)
    doubled[1:] = (plain[1:] == plain[:-1]) & (kind[1:] == 5)
    put(by_kind[1] / letters)
    put(np.minimum(per_text(doubled) / total * 10, 3))
    put(np.log1p(size) / 12)
    put(np.log1p(words) / 10)
    put(np.log1p(lines) / 8)
    put(np.minimum(size / np.maximum(words, 1) / 20, 3))
    put(np.minimum(size / lines / 2000, 3))
    put(np.minimum(repeats * 3, 2))
    put(kinds_of_words)
    put(np.array([len(t) == 0 for t in texts], float))
    code_points = size - per_text((plain & 0xC0) == 0x80)
    put(np.array([c is not None and c != k for c, k in zip(n_chars, code_points.tolist(), strict=True)], float))
    return out


@dataclass
class FactorisationMachine:
    """Weights; ``scale`` brings features to like size."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    scale: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        z = x * self.scale
        pairs = ((z @ self.factors) ** 2 - (z * z) @ (self.factors**2)).sum(axis=1) / 2
        return self.bias + z @ self.linear + pairs

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x).astype(np.float64), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rank: int = RANK, seed: int = SEED) -> FactorisationMachine:
    """Fits by Adam on the logistic loss with L2 decay."""
    n, width = x.shape
    y = y.astype(np.float32)
    share = float(y.mean()) if n else 0.5
    if n == 0 or share in (0.0, 1.0):
        share = min(max(share, 1e-3), 1 - 1e-3)
        return FactorisationMachine(np.log(share / (1 - share)), np.zeros(width, np.float32), np.zeros((width, rank), np.float32), np.ones(width, np.float32))
    rng = np.random.default_rng(seed)
    spread = x.std(axis=0)
    scale = np.where(spread > 0, 1 / np.maximum(spread, 0.02), 0).astype(np.float32)
    scale[:BUCKETS] *= 0.3  # words by their sheer number would outweigh the statistics
    z_all = x * scale
    params = [np.zeros(1, np.float32), np.zeros(width, np.float32), rng.normal(0, 0.01, (width, rank)).astype(np.float32)]
    params[0][0] = np.log(share / (1 - share))
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    decay, step, t = (0.0, 2e-3, 1e-2), 0.01, 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            own = order[at : at + 256]
            z, target = z_all[own], y[own]
            sums = z @ params[2]
            squares = z * z
            margin = params[0][0] + z @ params[1] + (sums**2 - squares @ params[2] ** 2).sum(axis=1) / 2
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target) / len(own)
            grads = [
                np.array([error.sum()], np.float32),
                z.T @ error,
                z.T @ (sums * error[:, None]) - (squares.T @ error)[:, None] * params[2],
            ]
            t += 1
            rate = step * 0.5 ** (epoch / 10)
            for p, g, m, v, d in zip(params, grads, first, second, decay, strict=True):
                g = g + d * p / 10
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return FactorisationMachine(float(params[0][0]), params[1], params[2], scale)


def _inputs(docs: DataFrame) -> DataFrame:
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select("doc_id", "text", chars.alias("n_chars"))


def remainder(doc_id: str = "doc_id"):
    """crc32 of the id as text modulo 5: 0 marks the rows kept from training."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def labelled_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, y, text, n_chars) of at most ``sample`` labelled ids outside the held-out fifth, one row each.

    Of rows that repeat an id, the one whose text has the smallest hash stands for it.
    """
    known = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("int").alias("y"))
        .where(remainder() != 0)
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    own = _inputs(docs).withColumn("doc_id", F.col("doc_id").cast("long")).join(F.broadcast(known), "doc_id")
    one = own.groupBy("doc_id").agg(F.min_by(F.struct("y", "text", "n_chars"), F.struct(F.xxhash64("text"), "n_chars")).alias("row"))
    return one.select("doc_id", "row.*")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorisationMachine:
    """Model from at most ``sample`` labelled rows outside the held-out fifth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = features(encoded(column(batch, "text")), column(batch, "n_chars").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), column(batch, "y"), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "y", "x"]
            )

    rows = labelled_rows(docs, labels, sample).mapInArrow(run, "doc_id long, y int, x binary").toArrow()
    table = rows.sort_by([("doc_id", "ascending")]).to_pydict()
    x = np.frombuffer(b"".join(table["x"]), np.float32).reshape(-1, WIDTH)
    return fit(x, np.array(table["y"], np.int64))


def score(docs: DataFrame, model: FactorisationMachine, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with ``score`` and ``predicted`` (which replace any of that name).

    A null text is scored as an empty one.
    """
    docs = docs.drop("score", "predicted")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches):
            chars = column(batch, "n_chars").cast(pa.int64()).to_pylist() if "n_chars" in names else [None] * batch.num_rows
            values = own.scores(features(encoded(column(batch, "text")), chars))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values), pa.array((values >= threshold).astype(np.int32))], [*batch.schema.names, "score", "predicted"]
            )

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{out}, score double, predicted int")
