import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import quality


def test_pairs_in_linear_time_equal_all_pairs():
    rng = np.random.default_rng(0)
    model = quality.FactorisationMachine(0.3, rng.normal(size=12), rng.normal(size=(12, 3)), rng.random(12))
    x = rng.normal(size=(5, 12))
    z = x * model.scale
    want = [
        0.3 + z[k] @ model.linear + sum(model.factors[i] @ model.factors[j] * z[k, i] * z[k, j] for i in range(12) for j in range(i))
        for k in range(5)
    ]
    assert np.allclose(model.margins(x), want)


def test_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = np.zeros((3000, quality.WIDTH), np.float32)
    x[:, -2:] = rng.choice((-1.0, 1.0), (3000, 2))
    y = (x[:, -1] * x[:, -2] > 0).astype(int)
    model = quality.fit(x[:2500], y[:2500])
    assert ((model.scores(x[2500:]) > 0.5) == y[2500:]).mean() > 0.95


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = [b"One two", b"", "é É 漢\n| x | $$$".encode(), b" ", b"word " * 3000, b"tail"]
    together = quality.features(texts, [7, None, 3, 1, 15000, 9])
    for k, t in enumerate(texts):
        assert np.allclose(together[k], quality.features([t], [[7, None, 3, 1, 15000, 9][k]])[0], atol=1e-6)
    assert np.isfinite(together).all()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).join(labels, "doc_id").where("quality IS NOT NULL").select("doc_id", "score", "predicted", "quality").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good = [r for r in held if r.quality == 1]
    bad = [r for r in held if r.quality == 0]
    assert len(held) > 500
    assert sum(r.predicted for r in good) / len(good) > 0.99
    assert sum(1 - r.predicted for r in bad) / len(bad) > 0.95


def test_labels_and_names_are_no_features(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (6, 1), (7, 0), (8, None), (None, 1)], "doc_id long, quality int")
    model = quality.train(odd_docs, labels)
    from pyspark.sql import functions as F

    renamed = odd_docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("other")).withColumn("doc_id", F.col("doc_id") + 1000)
    one = sorted(r.score for r in quality.score(odd_docs, model).collect())
    assert one == sorted(r.score for r in quality.score(renamed, model).collect())


@pytest.mark.parametrize("rows", [[], [(1, 1), (2, 1)]])
def test_no_or_one_class(spark, odd_docs, no_docs, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    model = quality.train(odd_docs, labels)
    got = quality.score(odd_docs, model)
    assert got.columns == [c for c in odd_docs.columns if c != "score"] + ["score", "predicted"]
    assert all(0 <= r.score <= 1 for r in got.collect()) and got.count() == odd_docs.count()
    assert quality.score(no_docs, model).collect() == []


def test_sample_bounds_rows_not_ids(spark):
    docs = spark.range(1, 30).selectExpr("id AS doc_id", "'text ' || id AS text", "7L AS n_chars", "explode(sequence(1, 50)) AS copy")
    docs = docs.withColumn("text", F.concat("text", (F.col("copy") % 3).cast("string")))
    labels = spark.range(1, 30).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    rows = quality.labelled_rows(docs, labels, 5).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 5
    assert sorted(map(tuple, rows)) == sorted(map(tuple, quality.labelled_rows(docs.orderBy(F.desc("text")), labels, 5).collect()))
