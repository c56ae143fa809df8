import hashlib
import random
import re

import pytest

from salesmart.llm import decontaminate


def words(text):
    plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", plain)


def by_hand(docs, items, width=10):
    out = []
    for d, text in docs:
        own, hit, found = words(text), set(), set()
        for item, t in items:
            w = words(t)
            n = min(width, len(w))
            for i in range(len(w) - n + 1) if n else ():
                for j in range(len(own) - n + 1):
                    if own[j : j + n] == w[i : i + n]:
                        hit.update(range(j, j + n))
                        found.add(str(item))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(own), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case(spark):
    r = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "é1", "漢字", "x", "7"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(10, text(14)), (2, text(10)), (3, text(3)), (4, text(1)), (5, None), (6, ""), (7, "!!!"), (2, text(12)), (None, text(12))]
    docs = []
    for i in range(40):
        parts = [text(r.randrange(30))]
        if i % 3 == 0:
            parts.append(r.choice([t for _, t in items if t]).upper())
        parts.append(text(r.randrange(20)))
        docs.append((i, r.choice([" ", ", ", "\n"]).join(parts)))
    docs += [(100, None), (101, ""), (102, "..."), (7, docs[7][1])]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("limit", [10**8, -1])
def test_matches_brute_force(case, limit):
    docs, items, d, b = case
    got = sorted([tuple(r) for r in decontaminate.find(d, b, limit=limit).collect()], key=str)
    assert got == by_hand(docs, [x for x in items if x[0] is not None])


@pytest.mark.parametrize("limit", [10**8, -1])
def test_spans_go_and_the_rest_stays(spark, limit):
    bench = "one two three four five six seven eight nine ten eleven"
    rows = [
        (1, f"Keep this. {bench.upper()}, keep that."),
        (2, "Nothing of it here: one two three four five six seven eight nine."),
        (3, bench),
        (4, None),
        (5, f"é {bench} ü {bench} 漢"),
    ]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    b = spark.createDataFrame([(1, bench)], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.remove_spans(df, b, limit=limit).collect()}
    assert got == {1: "Keep this. , keep that.", 2: rows[1][1], 3: "", 4: None, 5: "é  ü  漢"}


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "quick brown fox"), (2, None)], "item_id long, text string")
    rows = decontaminate.find(odd_docs, bench).collect()
    assert len(rows) == odd_docs.count() and sum(r.contaminated for r in rows) == 4
    cleaned = decontaminate.remove_spans(odd_docs, bench)
    assert cleaned.columns == odd_docs.columns and cleaned.count() == odd_docs.count()
    assert decontaminate.find(no_docs, bench).collect() == []
    none = bench.where("1 = 0")
    assert not any(r.contaminated for r in decontaminate.find(odd_docs, none).collect())


@pytest.mark.parametrize("limit", [10**8, -1])
def test_items_without_an_id_hit_too(spark, limit):
    nameless = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(None, nameless), (None, "red green blue"), (7, nameless)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a {nameless} b"), (2, "red green blue"), (3, "red green")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.find(docs, items, limit=limit).collect()}
    sha = lambda names: hashlib.sha256(names.encode()).hexdigest()
    # as the SQL twin counts them: no id is one item more, without a name
    assert got == {1: (10, 2, sha("7"), True), 2: (3, 1, sha(""), True), 3: (0, 0, sha(""), False)}
    kept = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, items, limit=limit).collect()}
    assert kept == {1: "a  b", 2: "", 3: "red green"}
