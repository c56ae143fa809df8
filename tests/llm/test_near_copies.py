import random

import corpus_pipeline
import numpy as np
import pytest

from salesmart.llm import near_copies


def jaccard(a, b):
    cut = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))} if t.split() else set()
    x, y = cut(a), cut(b)
    return len(x & y) / len(x | y) if x and y else 0


def copies(seed, n=60):
    """Single-line texts, some with a few words changed."""
    r = random.Random(seed)
    texts = [" ".join(f"w{r.randrange(5000)}" for _ in range(r.randrange(80, 200))) for _ in range(n)]
    for k in range(n):
        words = r.choice(texts[:n]).split()
        for _ in range(r.randrange(1, 5)):
            words[r.randrange(len(words))] = f"new{r.random()}"
        texts.append(" ".join(words))
    return list(enumerate(texts))


@pytest.mark.parametrize("stars, cell", [(0, 512), (4, 512), (0, 2), (1, 3)])
def test_no_two_near_copies_remain(spark, stars, cell):
    rows = copies(1) + [(1000, None), (1001, ""), (1002, "one two"), (1003, "One  two"), (1004, "three")]
    texts = {k: t or "" for k, t in rows}
    gone = [r.doc_id for r in near_copies.superseded(spark.createDataFrame(rows, "doc_id long, text string"), stars, cell).collect()]
    near = {(a, b) for a in texts for b in texts if a < b and jaccard(texts[a], texts[b]) >= 0.8}
    left = set(texts) - set(gone)
    assert len(near) > 30 and not [p for p in near if set(p) <= left]
    assert all(any((a, g) in near for a in texts) for g in gone) and {1000, 1001, 1002, 1004} <= left


def test_buckets_meet_as_often_as_promised():
    assert 1 - (1 - 0.8**near_copies.ROWS) ** near_copies.BANDS >= 1 - near_copies.MISS
    rng = np.random.default_rng(0)
    met = 0
    for _ in range(400):
        h = rng.integers(0, 2**64, 180, np.uint64)
        a, b = np.sort(h[:162]), np.sort(h[18:])  # 144 of 180 in common
        met += bool(set(near_copies.bucket_values(a)) & set(near_copies.bucket_values(b)))
        assert near_copies.near(a, b)
    assert met == 400


def test_sketches_agree_as_often_as_promised():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(400):
        h = rng.integers(0, 2**64, 180, np.uint64)
        a, b = (near_copies.minima(x) >> np.uint64(48) for x in (np.sort(h[:162]), np.sort(h[18:])))
        agree.append(int((a == b).sum()))
    assert min(agree) >= near_copies.AGREE and abs(np.mean(agree) - 0.8 * 120) < 1.5


def test_unlike_variants_of_one_text_are_not_paired(spark):
    r = random.Random(9)
    base = [f"w{r.randrange(5000)}" for _ in range(100)]
    pairs = []
    for n in (200, 400, 800):
        rows = []
        for k in range(n):
            words = list(base)
            for at in r.sample(range(100), 5):
                words[at] = f"new{r.random()}"
            rows.append((k, " ".join(words)))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        met = near_copies._buckets(docs)
        pairs.append(near_copies._unlike(met, docs, near_copies.CELL).count())
        if n == 200:
            texts = dict(rows)
            gone = {x.doc_id for x in near_copies.superseded(docs).collect()}
            left = sorted(set(texts) - gone)
            assert not [(a, b) for a in left for b in left if a < b and jaccard(texts[a], texts[b]) >= 0.8]
    assert all(found <= n / 4 for found, n in zip(pairs, (200, 400, 800), strict=True))


def test_stage_drops_near_copies_of_a_single_line(spark, sf):
    rows = copies(2)
    out = corpus_pipeline.keep_one_of_group(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf)
    left = {r.doc_id: r.text for r in out.collect()}
    assert not [(a, b) for a in left for b in left if a < b and jaccard(left[a], left[b]) >= 0.8]


def test_stage_keeps_rows_without_id_and_one_row_per_id(spark, sf, odd_docs):
    rows = odd_docs.unionByName(odd_docs.where("doc_id IS NULL OR doc_id IN (-9, 6)"))
    out = corpus_pipeline.keep_one_of_group(spark, rows, sf)
    assert out.columns == odd_docs.columns
    ids = sorted([r.doc_id for r in out.collect()], key=str)
    # 5 repeats the text of 1; 3 and 4 are empty like 2
    assert ids == sorted([-9, 1, 2, 6, 7, 8, None, None], key=str)
    other = spark.createDataFrame([(1, "b b c d e f g"), (1, "a b c d e f g h"), (1, "b b c d e f g"), (None, None)], "doc_id int, text string")
    once = [(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_group(spark, other, sf).collect()]
    again = [(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_group(spark, other.orderBy("text"), sf).collect()]
    assert sorted(once, key=str) == sorted(again, key=str) and len(once) == 2 and (None, None) in once


def test_stage_with_columns_named_like_its_own(spark, sf):
    rows = spark.createDataFrame([(1, "a b c", "x", {"k": 1}), (2, "a b c", "y", {}), (2, "d e", "z", None)], "doc_id long, text string, __id string, __row map<string,int>")
    out = corpus_pipeline.keep_one_of_group(spark, rows, sf)
    assert out.columns == rows.columns
    assert sorted((r.doc_id, r["__id"]) for r in out.collect()) in ([(1, "x"), (2, "z")], [(1, "x"), (2, "y")], [(1, "x")])
