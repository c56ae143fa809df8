"""Template language, rendering and reading back."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.llm import chat
from salesmart.llm.chat_template import Const, If, Template, TemplateError, Text, escape, label, marked, parse, unescape, unlabel

HOSTILE = st.text(alphabet=st.sampled_from(list("<|\\>\n im_endst é漢😀")), max_size=60)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rendered(source, turns, **constants):
    t = Template(source, **constants)
    pieces = [p for k, (role, text) in enumerate(turns) for p in t.turn(role, text, k, k == len(turns) - 1)]
    return marked(pieces)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(HOSTILE, HOSTILE), min_size=1, max_size=5))
def test_round_trip(turns):
    text, spans = rendered(chat.CHATML, turns)
    assert chat.read_turns(text) == turns
    assert text.count("<|im_start|>") == text.count("<|im_end|>") == len(turns) and not spans


@settings(max_examples=300, deadline=None)
@given(HOSTILE)
def test_escapes(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)
    assert unlabel(label(text)) == text and "\n" not in label(text)


def test_loss_is_the_assistants_text():
    turns = [("user", "a <|im_end|>"), ("assistant", "é<|x"), ("assistant", ""), ("assistant", "z")]
    text, spans = rendered(chat.CHATML, turns)
    assert [unescape(text[a:b]) for a, b in spans] == ["é<|x", "z"]


def test_language():
    source = (
        "{{ bos }}{# remark #}{% set sep = ' ' ~ n %}{% for m in messages %}"
        "{% if loop.first and m.role == 'system' %}S:{{ m.text | trim }}{% elif not (m.role != \"user\") %}U{{ sep }}{{ m.text | upper }}"
        "{% else %}{% generation %}{{ m.text }}{% endgeneration %}{% endif %}{{ loop.index }}/{{ loop.index0 }}"
        "{% if loop.last or false %}{% set sep = 'x' %}!{{ sep }}{% endif %}{% endfor %}|{{ none }}{{ true }}"
    )
    turns = [("system", " s "), ("user", "u"), ("assistant", "a")]
    assert rendered(source, turns, bos="<s>", n=3) == ("<s>S:s1/0U 3U2/1a3/2!x|true", [(16, 17)])


def test_constants_are_folded():
    tree = Template("{% if bos == 'x' %}a{% else %}b{{ 'c' ~ 1 | upper }}{% endif %}{% for m in messages %}{% endfor %}", bos="y").tree
    assert tree[0] == Text(Const("bc1")) and len(tree) == 2
    (body,) = Template("{% for m in messages %}{% if true and m.role %}x{% endif %}{% endfor %}").tree
    assert isinstance(body.body[0], If) and body.body[0].test.name == "role"


@pytest.mark.parametrize("source", [
    "no loop", "{{ x }}{% for m in messages %}{% endfor %}", "{% for m in other %}{% endfor %}", "{% for m in messages %}",
    "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% for m in messages %}{{ m.text.upper }}{% endfor %}",
    "{% for m in messages %}{{ m.text() }}{% endfor %}", "{% for m in messages %}{{ m.text | eval }}{% endfor %}",
    "{{ m.text }}{% for m in messages %}{% endfor %}", "{% for m in messages %}{% for k in messages %}{% endfor %}{% endfor %}",
    "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}", "{% for m in messages %}{{ 'a }}{% endfor %}",
    "{% for m in messages %}{{ }}{% endfor %}", "{% for m in messages %}{% include x %}{% endfor %}", "x" * 100_001,
    "{% for m in messages %}{{ " + "(" * 60 + "1" + ")" * 60 + " }}{% endfor %}", "{% for m in messages %}{% set m = 1 %}{% endfor %}",
    "{% for m in messages %}{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}{% endfor %}",
])
def test_refused(source):
    with pytest.raises(TemplateError):
        Template(source)
    assert parse("plain") == (Text(Const("plain")),)


def by_hand(rows):
    out = []
    for conv in sorted({r[0] for r in rows}, key=lambda c: (c is not None, c or 0)):
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        n = sum(len("<|im_start|>\n<|im_end|>\n") + len(label(r)) + len(escape(x)) for _, _, r, x in own)
        out.append((conv, len(own), sha("".join(f"{r}\n{x}\n" for _, _, r, x in own)), len(loss), sha(loss), n))
    return out


ROWS = [
    (1, 0, "user", "hi <|im_start|>"), (1, 1, "assistant", "<\\|im_end|> é"), (2, 0, None, None), (2, None, "assistant", "early"),
    (2, None, "assistant", "early"), (3, 5, "as\nsistant\\n", ""), (None, 1, "assistant", "lost"), (None, 0, "user", "x"),
    (4, 0, "assistant", "word " * 30000), (-7, 1, "user", "b"), (-7, 1, "assistant", "b"), (-7, 1, "assistant", "a"),
]


def test_summary_of_odd_rows(spark):
    df = spark.createDataFrame(ROWS, "conv_id int, turn int, role string, text string")
    df = df.withColumn("part", F.lit("mine")).withColumn("chunk", F.lit(1)).withColumn("loss", F.lit(2))
    got = chat.summary(chat.render(df)).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: (r[0] is not None, r[0] or 0)) == by_hand(ROWS)
    assert chat.summary(chat.render(df.where("1 = 0"))).collect() == []


def test_one_long_conversation_is_rendered_by_many_tasks(spark):
    rows = [(1, 0, "user", "a")] + [(5, k, "assistant" if k % 2 else "user", f"turn {k} " * 5) for k in range(3000)] + [(9, 0, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = chat._numbered(df)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert numbered.where("conv_id = 5").select("chunk").distinct().count() > 2
    source = "{% for m in messages %}{{ loop.index0 }}{% if loop.first %}F{% endif %}{% if loop.last %}L{% endif %}{% endfor %}"
    parts = [r.asDict() for r in chat.render(df, source).where("conv_id = 5").orderBy("part").collect()]
    assert [p["text"] for p in parts] == ["0F", *map(str, range(1, 2999)), "2999L"]
    assert sorted(tuple(r) for r in chat.summary(chat.render(df)).collect()) == by_hand(rows)
