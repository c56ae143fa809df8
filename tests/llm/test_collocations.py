"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesmart.llm import collocations


def by_hand(rows, longest, least, top):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", plain):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, longest + 1):
                    if i + k <= len(words):
                        f[lang, words[i : i + k]] += 1
    candidates = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    covered = set()
    for (lang, w), a in candidates.items():
        for m in range(2, len(w)):
            for s in range(len(w) - m + 1):
                if 100 * a >= 100 * f[lang, w[s : s + m]]:
                    covered.add((lang, w[s : s + m]))
    out = []
    for lang in total:
        own = []
        for (g, w), a in candidates.items():
            if g != lang or (g, w) in covered:
                continue
            cuts = [(1000 * a * total[g] // (f[g, w[:k]] * f[g, w[k:]]), k, f[g, w[:k]], f[g, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            own.append((-score, -a, " ".join(w).encode(), left, right))
        own.sort()
        out += [(lang, k + 1, x[2].decode(), -x[1], x[3], x[4], total[lang], -x[0]) for k, x in enumerate(own[:top])]
    return sorted(out, key=str)


def made(seed, n):
    r = random.Random(seed)
    fixed = ["new york city hall", "a b c d e f", "x x x x", "É ü", "in Spite Of"]
    rows = []
    for _ in range(n):
        parts = [r.choice(fixed) if r.random() < 0.4 else r.choice("abcdefgh") for _ in range(r.randrange(25))]
        rows.append((r.choice(["en", "en", "en", "de", None, ""]), r.choice([" ", "\t", "  "]).join(parts).replace(" g", ". g").replace("h", "\nh")))
    return [*rows, ("en", None), ("en", ""), ("fr", "once only"), ("de", "w " * 30000), ("en", "\x01 \x01 a\x00b " * 20), ("fr", "\xa0   " * 30)]


@pytest.mark.parametrize("longest, least, top, bits, ranges", [
    (5, 10, 2000, 2**20, 4), (5, 10, 2000, 64, 40), (3, 5, 7, 2**12, 1), (2, 20, 2000, 2**20, 200), (5, 1, 300, 2**16, 9),
])
def test_matches_brute_force(spark, longest, least, top, bits, ranges):
    rows = made(longest + least, 150)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = [tuple(r) for r in collocations.mine(df, longest, least, top, bits, ranges).collect()]
    assert sorted(got, key=str) == by_hand(rows, longest, least, top)


def test_streams_are_cut_inside_a_prefix(spark):
    # one first word holds nearly all phrases; its count must reach every range
    rows = [("en", f"the w{k} x{k % 7}") for k in range(300) for _ in range(3)]
    df = spark.createDataFrame(rows, "lang string, text string")
    counts, _ = collocations.frequent_phrases(df, 3, 3, 2**20)
    out = collocations._stream(counts, 16)
    parts = out.where("parts IS NOT NULL AND words[0] = 'the'").select("words", "parts").collect()
    assert len(parts) == 600 and {r.parts[0] for r in parts} == {900}
    got = [tuple(r) for r in collocations.mine(df, 3, 3, 100, 2**20, 16).collect()]
    assert sorted(got, key=str) == by_hand(rows, 3, 3, 100)


def test_products_beyond_64_bits(spark):
    one = spark.createDataFrame([(3 * 10**9, 5 * 10**12, 10**10, 7 * 10**9)], "a long, n long, l long, r long")
    assert one.select(collocations._score(*(F.col(c) for c in "anlr"))).first()[0] == 1000 * 3 * 10**9 * 5 * 10**12 // (7 * 10**19)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    odd = odd_docs.withColumn("phrase", F.lit(1)).withColumn("n", F.lit(1)).withColumn("words", F.lit("w"))
    assert sorted((tuple(r) for r in collocations.mine(odd, least=2).collect()), key=str) == by_hand(rows, 5, 2, 2000)
    assert collocations.mine(no_docs).collect() == []
    assert collocations.mine(odd, least=10**6).collect() == []
