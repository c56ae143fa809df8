import hashlib
import random

import numpy as np
import pytest
import xxhash

from salesmart.llm import line_dedup, simhash
from salesmart.llm.cuckoo import CuckooFilter
from salesmart.llm.simhash import GrayIndex, fingerprint, gray_rank

WS = " \t\n\x0b\x0c\r"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def lines_by_hand(docs):
    """{doc_id: [(n_lines, n_dropped, kept)]} of (id, text) rows with ids."""
    holders = {}
    for d, text in docs:
        for line in (text or "").split("\n"):
            holders.setdefault(low(line.strip(WS)), set()).add(d)
    out = []
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(k := low(x.strip(WS))) >= 10 and len(holders[k]) > 1 and d != min(holders[k]))]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def random_docs(seed, n=60):
    r = random.Random(seed)
    pool = ["shared line number one", "  SHARED line number one\t", "zehn Zeichen ü", "ÜBER zehn Zeichen", "über zehn Zeichen", "short", "", "123456789", "1234567890", "漢字" * 5, "漢字" * 4]
    return [(i, "\n".join(r.choice([*pool, f"own {r.random()}"]) for _ in range(r.randrange(6)))) for i in range(n)]


def answers(df):
    return sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect()], key=str)


@pytest.mark.parametrize("broadcast", [10**8, -1])
def test_lines_match_brute_force(spark, broadcast):
    docs = random_docs(1)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    store = line_dedup.LineStore(spark, broadcast=broadcast)
    store.insert(df)
    assert answers(store.dedup(df)) == lines_by_hand(docs)


def test_filters_beyond_the_broadcast_are_asked_group_by_group(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 40)
    r = random.Random(6)
    pool = [f"a line that some share, number {k}" for k in range(300)]
    # one line stands in every document
    docs = [(i, "\n".join(["a line that all share", *(r.choice([*pool, f"a line of its own {r.random()}"]) for _ in range(12))])) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    whole, parts = line_dedup.LineStore(spark), line_dedup.LineStore(spark, broadcast=300)
    for store in (whole, parts):
        store.insert(df)
    assert parts.shards > 4
    size = sum(len(x.table) + len(x.overflow) for x in parts.filters.collect())
    assert size > 3 * 300
    one, other = (sorted(map(tuple, s._maybe_shared(df).collect())) for s in (whole, parts))
    assert one == other  # the same filters answer, none is passed over
    everything = line_dedup._keys(df, 10, lambda hi, lo: np.ones(len(hi), bool)).count()
    assert len(other) < everything
    assert answers(parts.dedup(df)) == lines_by_hand(docs)


def test_lines_in_batches_and_back(spark):
    docs = random_docs(2)
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    store = line_dedup.LineStore(spark)
    store.insert(make(docs[20:]))
    store.insert(make(docs[:20]))
    assert answers(store.dedup(make(docs))) == lines_by_hand(docs)
    store.delete(make([(d, "") for d, _ in docs[:25]]).select("doc_id"))
    assert answers(store.dedup(make(docs[25:]))) == lines_by_hand(docs[25:])
    store.insert(make(docs[:25]))
    assert answers(store.dedup(make(docs))) == lines_by_hand(docs)


def test_lines_of_odd_rows(spark, odd_docs, no_docs):
    got = line_dedup.dedup_once(odd_docs)
    rows = got.collect()
    assert len(rows) == odd_docs.count() and set(odd_docs.columns) <= set(got.columns)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].text is None and by_id[2].n_lines == 1 and by_id[None].n_dropped == 0
    assert by_id[-9].n_dropped == 0 and by_id[1].n_dropped == 1 and by_id[1].text == ""
    assert sum(r.doc_id == 5 and r.n_dropped == 1 for r in rows) == 2
    assert line_dedup.dedup_once(no_docs).collect() == []
    digest = {r.doc_id: r for r in line_dedup.digest(got).collect()}
    assert digest[2].kept_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("n", [0, 1, 50, 5000])
def test_cuckoo_filter(n):
    rng = np.random.default_rng(n)
    hi, lo = (rng.integers(-(2**63), 2**63 - 1, n) for _ in range(2))
    own = CuckooFilter.sized(n)
    own.insert(hi, lo)
    own = CuckooFilter.load(*own.dump())
    assert own.contains(hi, lo).all()
    other = rng.integers(-(2**63), 2**63 - 1, (2, 4000))
    assert own.contains(*other).mean() < 0.01
    half = n // 2
    own.delete(hi[:half], lo[:half])
    assert own.contains(hi[half:], lo[half:]).all()
    assert half < 20 or own.contains(hi[:half], lo[:half]).mean() < 0.05


def test_cuckoo_filter_overflows_exactly():
    rng = np.random.default_rng(0)
    hi, lo = (rng.integers(-(2**63), 2**63 - 1, 60) for _ in range(2))
    own = CuckooFilter(8)
    own.insert(hi, lo)
    assert len(own.overflow) and own.contains(hi, lo).all()
    own.delete(hi, lo)
    assert not len(own.overflow) and not own.table.any()
    with pytest.raises(KeyError):
        own.delete(hi[:1], lo[:1])


def print_by_hand(text):
    words = low(text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


@pytest.mark.parametrize("text", ["", " \n", "one", "one Two", "a b c", "a b c d", "É é É é x y z", "w " * 70000, "A\x0bB\x0cC\rD"])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == print_by_hand(text)


def near(values, distance):
    return {(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if bin(a ^ b).count("1") <= distance}


@pytest.mark.parametrize("n", [1, 2, 16, 17, 300, 700])
def test_gray_index(n):
    r = random.Random(n)
    centres = [r.getrandbits(64) for _ in range(max(1, n // 20))]
    values = [r.choice(centres) ^ sum(1 << r.randrange(64) for _ in range(r.randrange(4))) & (2**64 - 1) for _ in range(n)]
    prints = np.array(values, np.uint64)
    query, place = GrayIndex(prints).search(prints, 2)
    assert set(zip(query.tolist(), place.tolist(), strict=True)) == near(values, 2) and len(query) == len(near(values, 2))


def test_gray_rank():
    codes = np.array([i ^ (i >> 1) for i in range(512)], np.uint64)
    assert gray_rank(codes).tolist() == list(range(512))


@pytest.mark.parametrize("cell", [4096, 8])
def test_links_match_brute_force(spark, cell):
    r = random.Random(4)
    centres = [r.getrandbits(64) for _ in range(12)]
    values = sorted({r.choice(centres) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(6)) for _ in range(150)})
    rows = [(v - 2**64 if v >= 2**63 else v, i) for i, v in enumerate(values)]
    found = simhash.links(spark.createDataFrame(rows, "print long, doc long"), cell=cell)
    from salesmart.llm.components import components

    got = {x.node: x.component for x in components(found).collect()}
    label = list(range(len(values)))
    pairs = near(values, 2)
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low_ = min(label[i], label[j])
            if label[i] != low_ or label[j] != low_:
                label[i] = label[j] = low_
                changed = True
    assert [got.get(i, i) for i in range(len(values))] == label


def test_simhash_of_documents(spark, odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[5].component_id == 1 and by_id[2].fingerprint == "0" * 16
    assert by_id[2].component_id == by_id[3].component_id == by_id[4].component_id == 2
    assert by_id[None].component_id is None
    assert all(int(r.fingerprint, 16) == print_by_hand(t) for r in rows for (d, t, *_) in odd_docs.collect() if d == r.doc_id)
    assert simhash.near_duplicates(no_docs).collect() == []
