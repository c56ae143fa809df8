"""Simple-8b files and packing against plain encodings."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesmart.llm import packing, simple8b, token_store
from salesmart.llm.tokens import default_tokenizer
from salesmart.session import new_folder


def encode(text):
    model = Tokenizer.from_file(default_tokenizer())
    return model.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50256), st.integers(0, 2**60 - 1)), max_size=400))
def test_simple8b_round_trip(ids):
    x = np.array(ids, np.uint64)
    words, starts = simple8b.encode(x)
    assert simple8b.decode(words, starts, len(x)).tolist() == ids


@pytest.mark.parametrize("n", [4095, 4096, 4097, 9000])
def test_simple8b_blocks(n):
    x = np.random.default_rng(n).integers(0, 50257, n).astype(np.uint64)
    words, starts = simple8b.encode(x)
    assert len(starts) == -(-n // simple8b.BLOCK) and (simple8b.decode(words, starts, n) == x).all()
    assert len(words) * 8 < 4 * n


def test_simple8b_rejects():
    with pytest.raises(ValueError):
        simple8b.encode(np.array([2**60], np.uint64))
    with pytest.raises(ValueError):
        simple8b.decode(np.zeros(1, np.uint64), np.zeros(1, np.uint32), 1)


def test_token_files(spark, odd_docs, no_docs):
    path = new_folder(spark, "tokens")
    token_store.write(odd_docs, path, default_tokenizer())
    rows = token_store.summary(spark, path).collect()
    docs = sorted(((r.doc_id, r.text) for r in odd_docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    at = 0
    want = []
    for d, text in docs:
        ids = [*encode(text), 2]
        want.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=lambda x: x[1]) == want
    texts = {r.doc_id: list(r.ids) for r in token_store.read_tokens(spark, path).collect()}
    assert texts[1] == [*encode(docs[2][1]), 2]
    empty = new_folder(spark, "tokens")
    token_store.write(no_docs, empty, default_tokenizer())
    assert token_store.summary(spark, empty).collect() == []


def check_packing(rows, docs, length=1024):
    """Every id once, sequences without gaps; returns the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    left = defaultdict(list)
    for d, text in docs:
        left[d].append([*encode(text), 0])
    for d, copies in left.items():
        # copies of one row are told apart only by their number
        ids, pieces = copies[0], sorted(by_doc[d], key=lambda r: r.start)
        assert all(c == ids for c in copies)
        assert sum(p.length for p in pieces) == len(ids) * len(copies)
        assert all(p.ids_crc32 == crc(ids[p.start : p.start + p.length]) and p.doc_tokens == len(ids) for p in pieces)
        if len(copies) == 1:
            at = 0
            for p in pieces:
                assert p.start == at
                at += p.length
    padded = total = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= length
        total += at
        padded += 0 if at & (at - 1) == 0 else length - at
    return padded / max(1, total)


def test_packing_odd_rows(spark, odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs, default_tokenizer()).collect()
    assert check_packing(rows, [(r.doc_id, r.text) for r in odd_docs.collect()]) == 0
    assert packing.pack_documents(no_docs, default_tokenizer()).collect() == []


def test_packing_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack_documents(docs, default_tokenizer()).collect()
    assert check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()]) < 0.01


@pytest.mark.parametrize("loss_limit", [None, 300])
def test_limits_hold_together(loss_limit):
    rng = np.random.default_rng(1)
    items = [(k, int(n), int(n * rng.random())) for k, n in enumerate(rng.integers(1, 900, 400))]
    packer = packing.Packer(1024, 6, loss_limit)
    found = packer.pack(items[:200]) + packer.pack(items[200:], last=True)
    tokens, segments, loss = defaultdict(int), defaultdict(int), defaultdict(float)
    share = {k: x / n for k, n, x in items}
    done = defaultdict(int)
    for sequence, offset, key, _, n in found:
        assert offset == tokens[sequence]
        tokens[sequence] += n
        segments[sequence] += 1
        loss[sequence] += n * share[key]
        done[key] += n
    assert done == {k: n for k, n, _ in items}
    assert max(tokens.values()) <= 1024 and max(segments.values()) <= 6 and max(loss.values()) <= (loss_limit or 1024) + 1e-6


def test_full_sequences_leave_little_room():
    rng = np.random.default_rng(2)
    packer = packing.Packer()
    found = packer.pack([(k, int(n), int(n)) for k, n in enumerate(rng.integers(1, 3000, 500))], last=True)
    size = defaultdict(int)
    for sequence, _, _, _, n in found:
        size[sequence] += n
    assert sum(n != 1024 and n & (n - 1) != 0 for n in size.values()) == 0


@pytest.mark.parametrize("tokens, limit", [(5, None), (1, None), (700, 300)])
def test_no_padding_where_another_limit_closes_a_sequence(tokens, limit):
    packer = packing.Packer(loss_limit=limit)
    items = [(k, tokens, tokens // 2) for k in range(3000)]
    out = packer.pack(items[:2000]) + packer.pack(items[2000:], last=True)
    sizes, segments, loss = defaultdict(int), defaultdict(int), defaultdict(float)
    for sequence, offset, _, _, n in out:
        assert offset == sizes[sequence]
        sizes[sequence] += n
        segments[sequence] += 1
        loss[sequence] += n * (tokens // 2) / tokens
    assert sum(sizes.values()) == 3000 * tokens and all(n & (n - 1) == 0 and n <= packing.LENGTH for n in sizes.values())
    assert max(segments.values()) <= packing.SEGMENTS and max(loss.values()) <= (limit or packing.LENGTH)
