"""Training-data pipeline over ``documents``: quality, line dedup, near-dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns
of ``docs``. A stage's result is written and read again before the next one starts, so each stage
works on rows that a lost executor cannot take away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import decontaminate, line_dedup, near_copies, packing, quality, simhash
from salesmart.llm.components import stored
from salesmart.llm.texts import table, unused
from salesmart.llm.tokens import default_tokenizer
from salesmart.session import new_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts."""
    names = docs.columns
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select(*names)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds."""
    names = docs.columns
    kept = line_dedup.dedup_once(docs)
    if "n_chars" in names:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*names)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate group, in one row; rows without an id all stay.

    Groups are those of ``simhash`` first. Of the rows that repeat a kept id, the one whose text has
    the smallest hash stays. Among these documents ``near_copies`` then finds those that share 0.8
    of their five-word shingles with another, which fingerprints two bits apart do not reach.
    """
    names = docs.columns
    key, lost, row = (unused(names, x) for x in ("__id", "__gone", "__row"))
    own = docs.withColumn(key, F.col("doc_id").cast("long"))
    first = simhash.near_duplicates(docs).where("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    kept = own.join(first, key, "left_semi")
    twice = stored(own.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key), "repeated-ids")
    if not twice.isEmpty():
        order = F.struct(F.xxhash64("text"), F.xxhash64(F.to_json(F.struct(*names))))
        repeated = kept.join(twice, key, "left_semi").groupBy(key).agg(F.min_by(F.struct(*names), order).alias(row))
        kept = kept.join(twice, key, "left_anti").select(*names).unionByName(repeated.select(f"{row}.*"))
    kept = stored(kept.select(*names), "one-of-group")
    gone = near_copies.superseded(kept).select(F.col("doc_id").alias(lost))
    return kept.join(gone, F.col("doc_id").cast("long") == F.col(lost), "left_anti").unionByName(docs.where(F.col("doc_id").cast("long").isNull()))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans that occur in the benchmark."""
    names = docs.columns
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark")).select(*names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences."""
    return packing.pack_documents(docs, default_tokenizer())


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", keep_one_of_group),
    ("benchmark decontamination", remove_benchmark),
    ("packing", pack),
]

#: Fingerprints, tokens and the classifier have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, "pipeline-" + name.split()[0].lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
