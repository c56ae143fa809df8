import array

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesmart.llm.components import components
from salesmart.llm.tokens import bpe_encoder, default_tokenizer


@pytest.fixture(scope="module")
def plain():
    model = Tokenizer.from_file(default_tokenizer())
    return lambda text: model.encode(text, add_special_tokens=False).ids


def ids(text):
    return list(array.array("I", bpe_encoder(default_tokenizer()).encode([text])[0]))


@pytest.mark.parametrize(
    "text",
    ["a  b", "a   b", " a", "  a", "a ", "a  ", "a \nb", "a\n \nb", "\n b", "it's 'they're' don't", "a\x85 b", "a\xa0 b", "a\x1c \x1cb",
     "word,\nNext.", "word,\n next", "w.\n\nx", "é,è.\nÜ", "<|endoftext|> x", "see <|endoftext|> here", "a<|endoftext|>b, c", "a\x01 b", "w.,\nx.", "a.5 b,", "a. ", "a.\n", "É.\nÜ.x","x²,½", "1,2.3 4", "漢字 かな", "..., a", "a.,\nB.", "", "ßẞ,", "a\tb \tc"],
)
def test_pieces_give_the_ids_of_the_whole(plain, text):
    assert ids(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcé ÀX,.\n\t'12 s t-  漢"), max_size=60))
def test_any_text(text):
    model = Tokenizer.from_file(default_tokenizer()) if not hasattr(test_any_text, "m") else test_any_text.m
    test_any_text.m = model
    assert ids(text) == model.encode(text, add_special_tokens=False).ids


def test_null_and_empty():
    assert bpe_encoder(default_tokenizer()).encode([None, ""]) == [b"", b""]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    import random

    r = random.Random(seed)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7)]
    r.shuffle(edges)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        u, v = find(a), find(b)
        root[max(u, v)] = min(u, v)
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
