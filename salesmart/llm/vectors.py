"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations.

Only vectors with equal, non-null labels are compared, by cosine in double precision. Vectors that
are null, zero, or hold null or non-finite components link with nothing.

A vector of norm one, padded to a power of two, goes through three rounds of random signs and a
fast Hadamard transform; its hash is the signed axis that lies nearest. A table joins ``hashes``
such axes to one bucket. The number of axes follows the number of vectors (about ``OCCUPANCY``
random vectors to a bucket), and the number of tables follows from it and from the chance that two
vectors at the threshold share an axis among the probed ones, so that ``RECALL`` is expected of
pairs right at the threshold, and more of closer ones. Besides its own bucket a vector probes the
``PROBES`` next likeliest of each table; a probing vector meets those that live in the bucket.

Equal vectors of a label are one class with a count before they are hashed. Pairs that meet are
verified by their exact cosine, in matrix blocks. A pair counts in the first table that brings it
together, so links are counted without writing any pair down; only the links of a spanning forest
leave a cell. A bucket of more than ``CELL`` members is cut into shares whose pairs are cells of
their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.components import components, forest, stored
from salesmart.llm.texts import column

THRESHOLD = 0.93
RECALL = 0.995
PROBES = 3
OCCUPANCY = 8
CELL = 1024
SEED = 7
# Buckets up to this size are checked pair by pair, larger ones in matrix blocks.
SMALL = 48


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (of power-of-two width), norms kept."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, -1, 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        step *= 2
        x = x.reshape(n, width)
    return x / math.sqrt(width)


class CrossPolytope:
    """``tables`` buckets per vector, each of ``hashes`` rotated axes, with probes."""

    def __init__(self, dim: int, hashes: int, tables: int, probes: int = PROBES, seed: int = SEED):
        self.dim, self.hashes, self.tables, self.probes = dim, hashes, tables, probes
        self.width = 1 << max(1, (dim - 1).bit_length())
        rng = np.random.default_rng(seed)
        self.signs = rng.choice((-1.0, 1.0), (tables, hashes, 3, self.width))

    def _axes(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best axis, second axis, loss of taking the second) for each hash."""
        best, second, loss = [], [], []
        for signs in self.signs[table]:
            y = x
            for s in signs:
                y = hadamard(y * s)
            size = np.abs(y)
            two = np.argpartition(size, -2, axis=1)[:, -2:]
            value = np.take_along_axis(size, two, 1)
            rows = np.arange(len(x))
            larger = value.argmax(axis=1)  # equal values must not name one axis twice
            first, other = two[rows, larger], two[rows, 1 - larger]
            best.append(2 * first + (y[rows, first] < 0))
            second.append(2 * other + (y[rows, other] < 0))
            loss.append((size[rows, first] - size[rows, other]) ** 2)
        return np.array(best), np.array(second), np.array(loss)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """(vectors, tables, 1 + probes): own bucket first; -1 where there are fewer probes."""
        n = len(x)
        padded = np.zeros((n, self.width))
        padded[:, : self.dim] = x
        out = np.full((n, self.tables, 1 + self.probes), -1, np.int64)
        base = (2 * self.width) ** np.arange(self.hashes, dtype=np.int64)
        masks = [[k for k in range(self.hashes) if m >> k & 1] for m in range(1, 1 << min(self.hashes, 10))]
        for t in range(self.tables):
            best, second, loss = self._axes(padded, t)
            own = (best * base[:, None]).sum(axis=0)
            out[:, t, 0] = own
            cost = np.array([loss[m].sum(axis=0) for m in masks])
            change = np.array([((second[m] - best[m]) * base[m][:, None]).sum(axis=0) for m in masks])
            rank = np.argsort(cost, axis=0, kind="stable")[: self.probes]
            out[:, t, 1 : 1 + len(rank)] = (own + np.take_along_axis(change, rank, 0)).T
        return out


def meeting_chance(dim: int, threshold: float, hashes: int, probes: int = PROBES) -> float:
    """Share of random pairs at the threshold that meet in one table (seeded simulation)."""
    rng = np.random.default_rng(SEED)
    a = rng.normal(size=(2000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(2000, dim))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    b = threshold * a + math.sqrt(1 - threshold**2) * b
    hasher = CrossPolytope(dim, hashes, 1, probes)
    x, y = hasher.buckets(a)[:, 0], hasher.buckets(b)[:, 0]
    return float(((x == y[:, :1]).any(axis=1) | (y == x[:, :1]).any(axis=1)).mean())


def plan(vectors: int, dim: int, threshold: float = THRESHOLD, recall: float = RECALL, probes: int = PROBES) -> tuple[int, int]:
    """(hashes, tables) for so many vectors."""
    axes = 2 << max(1, (dim - 1).bit_length())
    hashes = max(1, min(6, round(math.log(max(vectors, 1) / OCCUPANCY) / math.log(axes)))) if vectors > OCCUPANCY else 1
    miss = max(1e-6, 1 - meeting_chance(dim, threshold, hashes, probes))
    return hashes, max(1, math.ceil(math.log(1 - recall) / math.log(miss)))


def _rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, label_id, dim, x, usable): components as doubles, -0.0 as 0.0; usable rows can link."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists(x, lambda v: v != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & fine & some
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label_id"), F.size(x).alias("dim"),
        F.transform(x, lambda v: v + F.lit(0.0)).alias("x"), F.coalesce(usable, F.lit(False)).alias("usable"),
    )


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _signed(classes: DataFrame, hasher: CrossPolytope, kind: str) -> DataFrame:
    """(id, n, raw, sign): components and all buckets of each class, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = column(part, "x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, hasher.dim)
                buckets = hasher.buckets(_unit(x))
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "label_id"), column(part, "id"), column(part, "n"),
                        pa.array([u.tobytes() for u in x.astype(kind)], pa.binary()),
                        pa.array(buckets.reshape(len(x), -1).tolist(), pa.list_(pa.int64())),
                    ],
                    ["label_id", "id", "n", "raw", "sign"],
                )

    return classes.select("label_id", "id", "n", "x").mapInArrow(
        run, "label_id string, id long, n long, raw binary, sign array<bigint>"
    )


def _first_meeting(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(table, bucket) where each pair of bucket arrays (pairs, tables, ways) meets first."""
    far = np.int64(np.iinfo(np.int64).max)
    x = np.where((b == a[:, :, :1]).any(axis=2), a[:, :, 0], far)
    y = np.where((a == b[:, :, :1]).any(axis=2), b[:, :, 0], far)
    meet = np.minimum(x, y)
    table = (meet < far).argmax(axis=1)
    return table, meet[np.arange(len(a)), table]


class _Links:
    """Links found in one cell: counts and a spanning forest."""

    def __init__(self, pdf: pd.DataFrame, threshold: float, tables: int, kind: str):
        self.threshold = threshold
        self.ids, self.n, self.home = (pdf[c].to_numpy() for c in ("id", "n", "home"))
        self.bucket = pdf["bucket"].to_numpy()
        self.t = int(pdf["t"].iloc[0])
        self.unit = _unit(np.frombuffer(b"".join(pdf["raw"]), kind).astype(float).reshape(len(pdf), -1))
        self.sign = np.array(pdf["sign"].tolist(), np.int64).reshape(len(pdf), tables, -1)
        self.count = np.zeros(len(pdf), np.int64)
        self.labels = np.arange(len(pdf))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Counts pairs at the threshold that meet here first."""
        table, place = _first_meeting(self.sign[a], self.sign[b])
        first = (table == self.t) & (place == self.bucket[a])
        a, b = a[first], b[first]
        np.add.at(self.count, a, self.n[b])
        np.add.at(self.count, b, self.n[a])
        forest(a, b, self.labels)

    def near(self, a: np.ndarray, b: np.ndarray) -> None:
        """Checks pairs given one by one."""
        met = self.home[a] | self.home[b]
        a, b = a[met], b[met]
        for at in range(0, len(a), 20_000):
            i, j = a[at : at + 20_000], b[at : at + 20_000]
            close = np.einsum("ij,ij->i", self.unit[i], self.unit[j]) >= self.threshold
            self.add(i[close], j[close])

    def block(self, rows: np.ndarray, others: np.ndarray, ordered: bool) -> None:
        """Checks all of ``rows`` against ``others`` in matrix blocks (later ones only, if ordered)."""
        for at in range(0, len(rows), 256):
            part = rows[at : at + 256]
            close = self.unit[part] @ self.unit[others].T >= self.threshold
            close &= self.home[part][:, None] | self.home[others][None, :]
            if ordered:
                close &= others[None, :] > part[:, None]
            i, j = np.nonzero(close)
            for k in range(0, len(i), 20_000):
                self.add(part[i[k : k + 20_000]], others[j[k : k + 20_000]])

    def rows(self) -> pd.DataFrame:
        linked = np.flatnonzero(self.count)
        return pd.DataFrame({"id": self.ids[linked], "links": self.count[linked], "other": self.ids[self.labels[linked]]})


def _cell(pdf: pd.DataFrame, threshold: float, tables: int, kind: str) -> pd.DataFrame:
    """(id, links, other) of one cell: shares of one bucket, or many small buckets of one table."""
    pdf = pdf.sort_values(["label_id", "bucket", "id"], kind="stable")
    found = _Links(pdf, threshold, tables, kind)
    side = pdf["side"].to_numpy()
    if (side == 1).any():
        found.block(np.flatnonzero(side == 0), np.flatnonzero(side == 1), False)
        return found.rows()
    label = pd.factorize(pdf["label_id"])[0]
    new = np.concatenate(([True], (np.diff(label) != 0) | (np.diff(found.bucket) != 0)))
    start = np.flatnonzero(new)
    size = np.diff(np.concatenate((start, [len(pdf)])))
    group = np.cumsum(new) - 1
    small = size[group] <= SMALL
    for step in range(1, min(SMALL, int(size.max()))):
        a = np.flatnonzero((group[:-step] == group[step:]) & small[:-step])
        found.near(a, a + step)
    for k in np.flatnonzero(size > SMALL):
        rows = np.arange(start[k], start[k] + size[k])
        found.block(rows, rows, True)
    return found.rows()


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, cell: int = CELL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row.

    Rows that repeat a ``vec_id`` are vectors of their own, whatever their labels and vectors: each is
    answered by its own links, and only links join components, not a shared id. A row without an id is
    answered with no links and a null component.
    """
    rows = _rows(vectors)
    member = rows.where("usable").drop("usable")
    lonely = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    # a class has a number of its own: one vec_id may come with several labels or vectors
    classes = stored(
        member.groupBy("label_id", "dim", "x").agg(F.min("vec_id").alias("least"), F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()),
        "vector-classes",
    )
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    kind = "<f4" if single else "<f8"
    links, edges = None, None
    # one index per dimension; vectors of different dimension have no cosine
    for row in classes.groupBy("dim").count().orderBy("dim").collect():
        own = classes.where(F.col("dim") == row["dim"])
        # labels separate vectors already, so buckets are sized by the largest label
        most = own.groupBy("label_id").count().agg(F.max("count")).first()[0]
        hashes, tables = plan(most, row["dim"], threshold, recall)
        hasher = CrossPolytope(row["dim"], hashes, tables)
        found = stored(_linked(own, hasher, kind, threshold, cell), "vector-links")
        part = found.groupBy("id").agg(F.sum("links").alias("links"))
        tree = found.where("id <> other").select(F.col("id").alias("a"), F.col("other").alias("b"))
        links = part if links is None else links.unionByName(part)
        edges = tree if edges is None else edges.unionByName(tree)
    if links is None:
        return lonely.withColumn("kept", F.lit(True))
    joined = components(edges)
    small = classes.select("id", "least")
    # the smallest vec_id of each component, by its class numbers
    lowest = joined.join(small, F.col("id") == F.col("node")).groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(lowest, "component").select(F.col("node").alias("id"), "component_id")
    answers = classes.join(links, "id", "left").join(named, "id", "left").select(
        "label_id", "dim", "x",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    # rows find their class through the vector once more; hot classes are split by adaptive joins
    known = member.join(answers, ["label_id", "dim", "x"]).select("vec_id", "n_links", "component_id")
    return known.unionByName(lonely).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked(classes: DataFrame, hasher: CrossPolytope, kind: str, threshold: float, cell: int) -> DataFrame:
    """(id, links, other) of all cells."""
    ways = 1 + hasher.probes
    signed = stored(_signed(classes, hasher, kind), "vector-buckets")
    light = signed.select("label_id", "id", F.posexplode("sign").alias("p", "bucket")).where("bucket >= 0").select(
        "label_id", "id", "bucket", F.expr(f"p div {ways}").cast("int").alias("t"), (F.col("p") % ways == 0).alias("home")
    )
    keys = ["label_id", "t", "bucket"]
    # a bucket matters if someone lives there and someone else comes
    sizes = light.groupBy(*keys).agg(F.count("*").alias("m"), F.count_if("home").alias("homes")).where("m > 1 AND homes > 0")
    groups = max(1, -(-signed.count() * ways // (4 * cell)))
    met = (
        light.join(sizes.select(*keys, "m"), keys)
        .withColumn("shares", F.when(F.col("m") > cell, F.ceil(2 * F.col("m") / cell)).otherwise(1).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int"))
        .withColumn("cell", F.when(F.col("shares") > 1, -1 - F.col("bucket")).otherwise(F.pmod(F.xxhash64("label_id", "bucket"), F.lit(groups))))
        .withColumn("alone", F.when(F.col("shares") > 1, F.col("label_id")))
    )
    pairs = F.expr("transform(sequence(0, shares - 1), k -> struct(least(own, k) AS i, greatest(own, k) AS j))")
    dealt = met.withColumn("c", F.explode(pairs)).select(
        *keys, "alone", "cell", "c.i", "c.j", "home", "id", F.when(F.col("own") == F.col("c.i"), 0).otherwise(1).alias("side")
    )
    heavy = dealt.join(signed.select("id", "n", "raw", "sign"), "id")
    tables = hasher.tables
    return heavy.groupBy("t", "alone", "cell", "i", "j").applyInPandas(
        lambda pdf: _cell(pdf, threshold, tables, kind), "id long, links long, other long"
    )
