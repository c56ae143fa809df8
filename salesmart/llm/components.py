"""Connected components of a graph given as an edge table, by star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.session import new_folder

MAX_ROUNDS = 60


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of a frame as a written table: cuts lineage and survives lost executors."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; component is its smallest node.

    ``edges`` has two long columns a, b in any direction, with repetitions and loops allowed.
    Each round hangs every node's larger neighbours on its smallest neighbour and then its
    smaller neighbours on the smallest of them, until nothing moves. The number of rounds
    grows with the logarithm of the longest path; edges never outnumber the first round's.
    """
    links = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    links = stored(links, "links")
    for _ in range(MAX_ROUNDS):
        if links.isEmpty():
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # every u keeps only smaller neighbours now, itself included through its own minimum
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        nxt = (
            small.select("u", F.col("m").alias("v"))
            .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        nxt = stored(nxt, "links")
        same = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        before = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        links = nxt
        if same == before:
            break
    else:
        raise RuntimeError("components did not settle")
    # settled: a star forest, each node on the smallest one of its component
    return (
        links.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")))
        .groupBy("node").agg(F.min("component").alias("component"))
    )


def forest(a: np.ndarray, b: np.ndarray, labels: np.ndarray) -> None:
    """Joins the classes in ``labels`` (each entry the index of a smaller or equal member) by pairs, in place."""
    while len(a):
        la, lb = labels[a], labels[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up
