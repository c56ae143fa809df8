"""Documented reference joins and incremental merge.

No join here is hinted. Spark broadcasts a lookup whose size is below its threshold; a larger one
is sort-merged, and adaptive execution splits a hot key of the big side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.sinks.releases import commit_partitions, has_release, read_release


def first_of_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key of a reference table: the smallest, so the choice needs no order of arrival."""
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("row")).select(key, "row.*").select(*df.columns)


def label_lookup(df: DataFrame, labels: DataFrame, key: str, label: str, name: str) -> DataFrame:
    """Add the label of a code; unknown codes keep their row, and a code has one label.

    The small side is dealt anew after its grouping, so the join has exchanges of its own on both
    sides and adaptive execution can split a hot code.
    """
    pairs = first_of_key(labels.select(key, F.col(label).alias(name)), key).hint("rebalance")
    return df.join(pairs, key, "left")


def address_join(df: DataFrame, links: DataFrame, addresses: DataFrame, key: str) -> DataFrame:
    """Rows -> address link -> address, one row per link."""
    return df.join(links, key).join(
        addresses.drop("coddep", "codcomm"), "idadr", "left"
    )


def fk_anti_join(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child keys without parent and their number of rows.

    Children are counted per key before the join: a key that holds a third of all rows is one row
    per task by then, and the count and the join share one shuffle.
    """
    keys = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("orphan_key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    parents = parent.select(F.col(parent_key).alias("orphan_key"))
    return keys.join(parents, "orphan_key", "left_anti")


def incremental_merge(
    existing: DataFrame, incoming: DataFrame, key: str, version: str
) -> DataFrame:
    """Existing rows overlaid by newer ones: the highest ``version`` of each key stays.

    The whole row travels as one struct through a two-phase maximum, so no key is ever gathered.
    Rows without a key are nobody's newer version: all of them stay.
    """
    both = existing.unionByName(incoming)
    rest = [c for c in both.columns if c not in (key, version)]
    newest = F.max(F.struct(version, *rest)).alias("row")
    keyed = both.filter(F.col(key).isNotNull()).groupBy(key).agg(newest).select(key, "row.*")
    return keyed.select(*both.columns).unionByName(both.filter(F.col(key).isNull()))


def merge_release(
    spark: SparkSession, path: str, incoming: DataFrame, key: str, version: str, year: str
) -> None:
    """Overlay a stored history, partitioned by ``year``, by a release; ``read_release`` reads it.

    Only year partitions that the release touches are read whole and replaced: those of its rows,
    and those where a stored row has one of its keys (a sale may have changed its year). The key
    column alone is read to find these. Other partitions keep their files. The replacement is one
    commit: until it is done, and if it never is, readers see the history as it was.
    """
    if not has_release(spark, path):
        first = incremental_merge(incoming.limit(0), incoming, key, version)
        commit_partitions(first, path, year, [])
        return
    stored = read_release(spark, path, year)
    # one value per partition
    moved = stored.select(key, year).join(incoming.select(key), key, "left_semi").select(year)
    touched = incoming.select(year).unionByName(moved).distinct()
    years = [r[0] for r in touched.toLocalIterator()]
    chosen = F.col(year).isin([y for y in years if y is not None])
    if None in years:
        chosen = F.coalesce(chosen, F.lit(True))
    order = incoming.columns
    merged = incremental_merge(stored.filter(chosen).select(*order), incoming, key, version)
    commit_partitions(merged, path, year, years)


def append_new(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Existing rows plus the incoming rows whose key is not there yet."""
    return existing.unionByName(incoming.join(existing.select(key), key, "left_anti"))
