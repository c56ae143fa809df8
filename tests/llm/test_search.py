"""Ranked search against plain loops."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesmart.llm import ranked_search


def terms(text):
    plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", plain)


def by_hand(docs, items, top):
    held = [(d, Counter(terms(t))) for d, t in docs]
    filled = [c for _, c in held if c]
    big_n, big_l = len(filled), sum(sum(c.values()) for c in filled)
    df = Counter(t for c in filled for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        scored = []
        for d, c in held:
            n = sum(c.values())
            score = 0
            for t in own & c.keys():
                w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                m = 50 + (50 * n * big_n) // big_l
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case(spark):
    r = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "é", "漢字", "Word", "x_y"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    text = lambda n: " ".join(r.choices(vocabulary, weights, k=n))
    docs = [(k, text(r.randrange(60))) for k in range(400)]
    docs += [(400 + k, docs[k % 5][1]) for k in range(40)] + [(7, docs[8][1]), (8, docs[8][1]), (500, None), (501, ""), (502, "..."), (None, text(30))]
    docs += [(600, "W3 " * 30000)]
    items = [(k, text(12)) for k in range(25)] + [(3, "漢字 w59"), (None, "w1, w2; É"), (90, None), (91, "!!"), (92, "nowhere"), (-1, "w0")]
    return docs, items, spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("top, owners, block", [(5, 4, 4096), (5, 3, 16), (50, 1, 64), (1000, 4, 32)])
def test_matches_brute_force(case, top, owners, block):
    docs, items, d, b = case
    got = [tuple(r) for r in ranked_search.search(d, b, top, owners, block).collect()]
    assert sorted(got, key=str) == by_hand(docs, items, top)


def test_item_blocks(case, monkeypatch):
    docs, items, d, b = case
    monkeypatch.setattr(ranked_search, "ITEM_BLOCK", 7)
    blocks = list(ranked_search._item_blocks(b))
    assert [len(x) for x in blocks] == [7, 7, 7, 7]
    monkeypatch.setattr(ranked_search, "ITEM_BLOCK", 20)
    assert sorted((tuple(r) for r in ranked_search.search(d, b, 5).collect()), key=str) == by_hand(docs, items, 5)


def test_bundles_that_cannot_win_are_left_behind(spark):
    # every document holds the frequent terms; only a few can be among the best
    docs = [(k, "low common " * 3 + (f"rare{k % 40} filler{k}" if k < 200 else "")) for k in range(2000)]
    item = spark.createDataFrame([(1, " ".join(f"rare{k}" for k in range(40)) + " low common")], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    made = []
    original = ranked_search._stage
    try:
        ranked_search._stage = lambda *a: made.append(original(*a)) or made[-1]
        rows = ranked_search.search(df, item, 10, 3, 128).collect()
    finally:
        ranked_search._stage = original
    assert len(rows) == 10
    assert made[-1].select(F.sum(F.size("slots"))).first()[0] <= 200


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "quick brown fox"), (2, None)], "item_id long, text string").withColumn("block", F.lit(1))
    got = [tuple(r) for r in ranked_search.search(odd_docs, items).orderBy("rank").collect()]
    assert [(r[0], r[1], r[2]) for r in got] == [(1, 1, -9), (1, 2, 1), (1, 3, 5), (1, 4, 5)]
    assert ranked_search.search(no_docs, items).collect() == []
    assert ranked_search.search(odd_docs, items.where("1 = 0")).collect() == []
