import hashlib
import random
import re

import corpus_pipeline
import numpy as np
import pytest

import __spark_entry__ as entry_module
from salesmart.llm import line_dedup, oracles, pii, queries, simhash

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([ -]?[0-9])+", r"\+[0-9][ ().0-9-]+[0-9]",
)


def base_by_hand(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                16 <= len(digits) <= 19 and pii.luhn(digits),
                8 <= len(digits) <= 15,
            )[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("letters", ["ab.@@-+01234567 ()%\n1.1", "0123456789- 45", "1.2.25600.@a", "+1 (0)-.9"])
def test_base_spans(letters):
    r = random.Random(letters)
    for _ in range(8000):
        text = "".join(r.choice(letters) for _ in range(r.randrange(50)))
        assert pii.base_spans(text) == base_by_hand(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000, "@" * 100_000, "a@" * 50_000, "1." * 50_000, "+1" * 50_000, "1 " * 50_000])
def test_long_runs_take_linear_time(text):
    base = pii.base_spans(text)
    pii.added_spans([text], [base], pii.trained())


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    n = len(pii.LABELS)
    field = pii.ShapeField(rng.normal(size=(pii.BUCKETS, n)), rng.normal(size=(n, n)))
    chains = [[rng.integers(0, pii.BUCKETS, 12).tolist() for _ in range(k)] for k in (1, 2, 4, 4)]
    from itertools import product

    for chain, labels in zip(chains, field.viterbi(chains), strict=True):
        scores = field.emit[np.array(chain)].sum(axis=1)

        def value(path, scores=scores):
            around = (0, *path, 0)
            return sum(scores[t][y] for t, y in enumerate(path)) + sum(field.move[a, b] for a, b in zip(around, around[1:], strict=False))

        assert value(tuple(labels)) == pytest.approx(max(value(p) for p in product(range(n), repeat=len(chain))))


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("call (415) 555-2671 now", "phone:5:19"),
        ("then +1 (269) 555-3296 4524132264652876 and", "card:23:39,phone:5:22"),
        ("card 4111.1111.1111.1111 ok", "card:5:24"),
        ("host 2001:db8::2 up", "ip:5:16"),
        ("in 2019 we had 12 of 40 and 3.5 percent", ""),
        ("token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff", ""),
        ("4785380592391135$$$ ci%%% 15&&&", ""),
    ],
)
def test_added_spans(text, found):
    added = pii.added_spans([text], [pii.base_spans(text)], pii.trained())[0]
    assert pii._joined(added) == found


def test_pii_rows(spark, odd_docs, no_docs):
    rows = pii.find(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert pii.find(no_docs).collect() == []


def test_pii_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in pii.find(docs).collect():
        base = base_by_hand(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii._joined(base).encode()).hexdigest()
        assert len(r.spans.split(",")) - (r.spans == "") == len(base) + r.n_added


def test_registered():
    names = entry_module.queries()
    assert {n.split("_")[0] for n in queries.REGISTRY} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.REGISTRY) | {"pipeline"} <= set(names)
    assert set(oracles.build()) <= set(queries.REGISTRY)


@pytest.mark.parametrize("name", sorted(oracles.build()))
def test_query_matches_its_sql(spark, sf, name):
    from oracle_compare import compare, connect

    assert compare(spark, connect(sf), sf, name) == ""


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    from salesmart.llm.components import stored

    good = stored(stages["quality classifier"](spark, docs, sf), "t")
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    lines = stored(stages["line dedup"](spark, good, sf), "t")
    assert lines.columns == docs.columns and lines.count() == good.count()
    want = {r.doc_id: r.text for r in line_dedup.dedup_once(good).collect()}
    assert {r.doc_id: r.text for r in lines.collect()} == want
    one = stored(stages["SimHash near-dedup"](spark, lines, sf), "t")
    prints = simhash.near_duplicates(lines).collect()
    assert sorted(r.doc_id for r in one.select("doc_id").collect()) == sorted({r.component_id for r in prints})
    clean = stored(stages["benchmark decontamination"](spark, one, sf), "t")
    assert clean.columns == docs.columns and clean.count() == one.count()
    got = {r.doc_id: r.doc_tokens for r in stages["packing"](spark, clean, sf).collect()}
    assert set(got) == {r.doc_id for r in clean.collect()}
    whole = {r.doc_id: r.doc_tokens for r in corpus_pipeline.run(spark, sf).collect()}
    assert whole == got


def test_pipeline_odd_rows(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        at = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, sf)
            assert at.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, at, sf).collect()
