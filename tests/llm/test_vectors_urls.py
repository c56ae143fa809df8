import math
import random

import numpy as np
import pytest

from salesmart.llm import licenses, url_filter, vectors


def by_hand(rows, threshold=0.93):
    def unit(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, float)
        return x / np.sqrt((x * x).sum())

    units = [unit(v) for _, v, _ in rows]
    links, root = [0] * len(rows), {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(units):
        for j, b in enumerate(units):
            same = rows[i][2] is not None and rows[i][2] == rows[j][2]
            if i != j and same and a is not None and b is not None and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                u, v = find(rows[i][0]), find(rows[j][0])
                root[max(u, v)] = min(u, v)
    return {r[0]: (links[k], find(r[0])) for k, r in enumerate(rows)}


def clustered(seed, n, dim=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 10, dim))
    rows = []
    for k in range(n):
        noise = rng.choice((0.05, 0.2, 0.3, 0.5))
        v = (centres[rng.integers(len(centres))] + noise * rng.normal(size=dim)).astype(np.float32)
        rows.append((k, [float(x) for x in v], int(rng.integers(2))))
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("cell", [1024, 16])
def test_links_and_components(spark, cell):
    rows = clustered(1, 600)
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(50)]  # a large group of copies
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA), cell=cell).collect()}
    want = by_hand(rows)
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(g[0] for g in got.values()) >= 0.98 * sum(w[0] for w in want.values())
    assert np.mean([got[k][1] == want[k][1] for k in want]) > 0.97


def rows_by_hand(rows, threshold=0.93):
    """(vec_id, n_links, component_id) of each row; rows of one id are vectors of their own."""
    numbered = [(k, v, label) for k, (_, v, label) in enumerate(rows)]
    found = by_hand(numbered, threshold)
    least = {}
    for k, (vec_id, _, _) in enumerate(rows):
        root = found[k][1]
        least[root] = min(least.get(root, vec_id), vec_id)
    return sorted((vec_id, found[k][0], least[found[k][1]]) for k, (vec_id, _, _) in enumerate(rows))


def test_one_id_with_several_labels_and_vectors(spark):
    near = [[1.0, 0.02 * k] + [0.0] * 6 for k in range(4)]
    rows = [(1, near[0], 0), (2, near[1], 0), (1, near[2], 1), (3, near[3], 1)]
    # one id with unlike vectors of one label, links on both sides
    rows += [(9, [0.0, 0.0, 1.0] + [0.0] * 5, 0), (9, [0.0] * 3 + [1.0] + [0.0] * 4, 0), (5, [0.0, 0.0, 1.0, 0.1] + [0.0] * 4, 0), (7, [0.0, 0.0, 0.1, 1.0] + [0.0] * 4, 0)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == rows_by_hand(rows)
    assert got[:4] == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_random_rows_that_share_ids(spark):
    rows = [(k % 40, v, label) for k, v, label in clustered(5, 300)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    want = rows_by_hand(rows)
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want) and sum(g[1] for g in got) <= sum(w[1] for w in want)
    assert sum(g == w for g, w in zip(got, want, strict=True)) > 0.95 * len(want)


def test_recall_at_the_threshold():
    hashes, tables = vectors.plan(100_000, 64)
    # no number of tables is cut short of the recall that was asked for
    many = vectors.plan(100_000, 64, recall=0.999999)
    assert 1 - (1 - vectors.meeting_chance(64, 0.93, many[0])) ** many[1] >= 0.999999
    assert 1 - (1 - vectors.meeting_chance(64, 0.93, hashes)) ** tables >= vectors.RECALL
    assert vectors.plan(10**10, 64)[0] > hashes


def test_hadamard_keeps_norms_and_angles():
    x = np.random.default_rng(0).normal(size=(3, 64))
    y = vectors.hadamard(x)
    assert np.allclose(x @ x.T, y @ y.T)


def test_odd_vectors(spark):
    v = [1.0] * 8
    rows = [
        (1, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [0.0] * 8, 1), (7, [float("nan")] * 8, 1), (8, [1.0, None] * 4, 1),
        (9, [float("inf")] * 8, 1), (10, [], 1), (11, [2.0] * 8, 1), (12, [1e38] * 8, 1), (13, [1.0] * 5, 1), (14, [-1.0] * 8, 1), (None, v, 1), (15, v, 3), (15, v, 3),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = vectors.near_duplicates(df).collect()
    by_id = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert len(got) == len(rows)
    assert by_id[1] == (3, 1, True) and by_id[2] == (3, 1, False) and by_id[12] == (3, 1, False)
    assert all(by_id[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10, 13, 14))
    assert vectors.near_duplicates(df.where("1 = 0")).collect() == []


HTML = '<a href="{}">x</a>'


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_rules_and_parts(spark):
    rows = [
        (1, "http://WWW.Example.com/en/1?q=/es/#x", None), (2, "https://example.com/en/", ""), (3, "https://a.b.net/es/x", None),
        (4, "https://net/fr/", None), (5, "https://a.net/en/", None), (6, None, None), (7, "no scheme", None), (8, "http://example.com", None),
        (9, "http://x.com?en", None), (10, "http://notexample.com/en/", None), (11, "://h.org/p#f?q", None), (12, "http://ex.net/es", None), (12, "http://ex.net/es", None),
    ]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages(spark, rows)).collect()}
    assert got == {
        1: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 2: ("example.com", "/en/", "example.com/en/", "block"),
        3: ("a.b.net", "/es/x", "net/es/", "block"), 4: ("net", "/fr/", "net/fr/", "block"), 5: ("a.net", "/en/", None, "allow"),
        6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("example.com", "", None, "allow"), 9: ("x.com", "", None, "allow"),
        10: ("notexample.com", "/en/", "com/", "allow"), 11: ("h.org", "/p", None, "allow"), 12: ("ex.net", "/es", None, "allow"),
    }
    assert url_filter.judge(pages(spark, rows).where("1 = 0")).collect() == []


def test_distrust_goes_against_links_and_trust_along_them(spark):
    bad, good = "http://bad.net/es/1", "http://good.com/1"
    rows = [
        (1, bad, HTML.format("http://victim.org/")), (2, good, HTML.format("https://User@Praised.ORG/x")),
        (3, "http://linker.org/1", HTML.format("//bad.net/x")), (4, "http://victim.org/1", ""), (5, "http://praised.org/1", "<p>http://bad.net</p>"),
        (6, "http://both.org/1", HTML.format("http://bad.net/")), (7, "http://good.com/2", HTML.format("http://both.org/")), (8, "http://good.com/3", HTML.format("http://both.org/")),
    ]
    got = {r.page_id: r.verdict for r in url_filter.judge(pages(spark, rows)).collect()}
    # trust from two good pages makes up for the one link to the blocked host
    assert got == {1: "block", 2: "allow", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow"}


def test_page_rank_by_hand(spark):
    r = random.Random(2)
    names = [f"h{k}" for k in range(12)]
    edges = {(r.choice(names), r.choice(names)): r.randrange(1, 5) for _ in range(30)}
    edges = {k: n for k, n in edges.items() if k[0] != k[1]}
    seeds = [(n, float(k < 3), float(k > 9)) for k, n in enumerate(names)]
    got = {
        x.host: (x.trust, x.distrust)
        for x in url_filter.host_scores(
            spark.createDataFrame(seeds, "host string, trust double, distrust double"),
            spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, n long"),
            rounds=url_filter.ROUNDS,
        ).collect()
    }
    for side, ways in ((0, edges), (1, {(b, a): n for (a, b), n in edges.items()})):
        start = {n: s[1 + side] for n, s in zip(names, seeds, strict=True)}
        total = {a: sum(n for (x, _), n in ways.items() if x == a) for a in names}
        score = {n: 0.15 * start[n] for n in names}
        for _ in range(url_filter.ROUNDS):
            score = {n: 0.15 * start[n] + sum(0.85 * w / total[a] * score[a] for (a, b), w in ways.items() if b == n) for n in names}
        assert all(abs(got.get(n, (0, 0))[side] - score[n]) < 1e-9 for n in names)


def test_distrust_goes_as_far_as_it_exceeds_the_margin(spark):
    rows = [(k, f"http://bad{k}.net/es/1", "") for k in range(40)]
    rows += [(100 + k, "http://far1.org/1", HTML.format(f"http://bad{k}.net/")) for k in range(40)]
    rows += [(200 + k, f"http://far{k}.org/1", HTML.format(f"http://far{k - 1}.org/")) for k in range(2, 33)]
    got = {r.host: r.verdict for r in url_filter.judge(pages(spark, rows)).collect()}
    want = {f"far{k}.org": "block" if 40 * 0.15 * 0.85**k >= url_filter.MARGIN else "allow" for k in range(1, 33)}
    assert {h: v for h, v in got.items() if h in want} == want and want["far11.org"] == "block" and "allow" in want.values()


def test_cycles_get_all_their_score(spark):
    seeds = spark.createDataFrame([("a", 1.0, 0.0)], "host string, trust double, distrust double")
    links = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, n long")
    got = {r.host: r.trust for r in url_filter.host_scores(seeds, links, rounds=None).collect()}
    assert abs(got["a"] - 0.15 / (1 - 0.85**2)) < 1e-6 and abs(got["b"] - 0.85 * got["a"]) < 1e-6


def containment(text, template):
    import re

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    w = words(text)
    length, step = template.window
    best = 0
    for at in range(0, max(0, len(w) - 4), step):
        part = w[at : at + length]
        has = {" ".join(part[i : i + 5]) for i in range(len(part) - 4)}
        best = max(best, len(has & set(template.shingles)))
    return best >= template.needed


def test_licenses_by_hand(spark):
    r = random.Random(5)
    own = licenses.templates(licenses.TEMPLATES)
    filler = "lorem ipsum dolor licensed sit amet released international software license é".split()
    docs = []
    for k in range(60):
        parts = [" ".join(r.choice(filler) for _ in range(r.randrange(80)))]
        for text in r.sample(list(licenses.TEMPLATES.values()), r.randrange(3)):
            words = text.split()
            if r.random() < 0.5:
                words[r.randrange(len(words))] = "changed"
            parts += [" ".join(words).upper() if r.random() < 0.3 else " ".join(words), " ".join(r.choice(filler) for _ in range(r.randrange(80)))]
        docs.append((k, "\n".join(parts)))
    got = {x.doc_id: (x.n_licenses, x.licenses) for x in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k, text in docs:
        names = sorted(t.name for t in own if containment(text, t))
        assert got[k] == (len(names), ",".join(names))
    assert sum(n for n, _ in got.values()) > 20


def test_anchors_lose_nothing():
    for t in licenses.templates(licenses.TEMPLATES):
        without = [s for s in t.shingles if not t.anchors & set(s.split())]
        assert len(without) < t.needed
        assert 1 - (1 - t.least_similarity) ** licenses.bands([t]) >= 1 - licenses.MISS


def test_licenses_odd_rows(spark, odd_docs, no_docs):
    rows = licenses.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count() and not any(r.n_licenses for r in rows)
    assert licenses.scan(no_docs).collect() == []
    with pytest.raises(ValueError):
        licenses.templates({"short": "only four words here"})
