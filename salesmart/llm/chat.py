"""Conversations as training texts: rendered by a compiled template, and read back.

Turns of a conversation are ordered by turn (null first), then role, then text; null roles and
texts are empty, rows without a conversation id are one conversation without id, repeated rows are
turns of their own. Only the four columns conv_id, turn, role and text play a part.

``render`` cuts the ordered turns into ranges, so that a conversation of any length is rendered by
many tasks: each range is numbered where it is written, and the driver only learns for every range
how far its first conversation had come before it and whether its last one goes on. It returns one
part per turn, (conv_id, part, text, loss): parts of a conversation in order are its text, ``loss``
holds the code point spans of a part that bear loss. ``summary`` reads the parts of a ``CHATML``
rendering back. Its two digests are of whole conversations, so the turns of one conversation pass
through one task there, as a sorted stream that holds one turn at a time. Turns that share
conversation, turn, role and the first ``TIE_LENGTH`` characters of text lie in one range.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.chat_template import Template, marked, unescape, unlabel
from salesmart.llm.components import stored
from salesmart.llm.texts import column, slices

CHATML = (
    "{% for message in messages %}<|im_start|>{{ message.role | label }}\n"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}<|im_end|>\n{% endfor %}"
)
TIE_LENGTH = 64

_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_PARTS = "conv_id long, part long, text string, loss array<struct<start:int,end:int>>"
_NUMBERED = "chunk int, seq long, ends boolean, conv_id long, role string, text string"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _numbered(turns: DataFrame) -> DataFrame:
    """Ordered turns with the range they lie in, their place in their conversation within it, and whether
    the conversation ends with them (null: the range ends first)."""
    plain = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    dealt = plain.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, TIE_LENGTH))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, seq, before = TaskContext.get().partitionId(), 0, None
        kept: tuple | None = None  # the row whose successor is not known yet

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], _NAMES)

        for batch in slices(batches):
            rows = []
            for conv, role, text in zip(*(column(batch, c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                same = kept is not None and conv == before
                if kept is not None:
                    rows.append((chunk, kept[0], not same, *kept[1:]))
                seq = seq + 1 if same else 0
                kept, before = (seq, conv, role, text), conv
            if rows:
                yield out(rows)
        if kept is not None:
            yield out([(chunk, kept[0], None, *kept[1:])])

    return stored(dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, _NUMBERED), "chat-turns")


_NAMES = [x.split()[0] for x in _NUMBERED.split(", ")]


def _borders(rows: DataFrame) -> dict[int, tuple[tuple, int, bool]]:
    """Of each range: its first conversation, the turns of that one before the range, and whether the
    last conversation of the range ends with it. One row a range reaches the driver."""
    edges = rows.groupBy("chunk").agg(
        # a range is sorted by conversation, nulls first
        F.min_by(F.struct("conv_id"), F.struct(F.col("conv_id").isNotNull(), "conv_id")).alias("first"),
        F.max(F.when(F.col("ends").isNull(), F.struct("conv_id", "seq"))).alias("last"),
    )
    found: dict[int, tuple[tuple, int, bool]] = {}
    open_conv, open_turns, before = None, 0, None
    for r in sorted(edges.collect(), key=lambda r: r.chunk):
        first, last = (r["first"].conv_id,), (r["last"].conv_id,)
        goes_on = first == open_conv
        if goes_on:
            found[before] = (*found[before][:2], False)
        start = open_turns if goes_on else 0
        found[r.chunk] = (first, start, True)
        open_conv, open_turns, before = last, r["last"].seq + 1 + (start if first == last else 0), r.chunk
    return found


def render(turns: DataFrame, template: str = CHATML, **constants: str | int | bool | None) -> DataFrame:
    """(conv_id, part, text, loss) of all conversations."""
    Template(template, **constants)  # a template that is refused is refused here
    rows = _numbered(turns)
    borders = _borders(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template, **constants)
        for batch in slices(batches):
            parts, texts, spans = [], [], []
            columns = (column(batch, c).to_pylist() for c in _NAMES)
            for chunk, seq, ends, conv, role, text in zip(*columns, strict=True):
                first, start, closed = borders[chunk]
                index = seq + (start if (conv,) == first else 0)
                rendered, loss = marked(compiled.turn(role, text, index, closed if ends is None else ends))
                parts.append(index)
                texts.append(rendered)
                spans.append([{"start": a, "end": b} for a, b in loss])
            yield pa.RecordBatch.from_arrays(
                [column(batch, "conv_id"), pa.array(parts, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, _SPANS)],
                ["conv_id", "part", "text", "loss"],
            )

    return rows.mapInArrow(run, _PARTS)


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in a ``CHATML`` text."""
    found, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        found.append((unlabel(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError("not a rendered conversation")
    return found


def summary(parts: DataFrame) -> DataFrame:
    """Digests of conversations from their ``CHATML`` parts.

    turns_sha256 is of role, line feed, text, line feed of each turn; loss_chars and loss_sha256 are
    of the unescaped text under the loss mask; formatted_chars counts the rendered text. All count
    code points and hash UTF-8.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        at: tuple | None = None
        n = chars = loss_chars = 0
        turns, losses = hashlib.sha256(), hashlib.sha256()

        def close() -> None:
            if at is not None:
                done.append((at[0], n, turns.hexdigest(), loss_chars, losses.hexdigest(), chars))

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = [x.split()[0] for x in schema.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

        for batch in slices(batches):
            for conv, text, loss in zip(*(column(batch, c).to_pylist() for c in ("conv_id", "text", "loss")), strict=True):
                if (conv,) != at:
                    close()
                    at, n, chars, loss_chars, turns, losses = (conv,), 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, own in read_turns(text):
                    n += 1
                    turns.update(f"{role}\n{own}\n".encode())
                for span in loss:
                    own = unescape(text[span["start"] : span["end"]])
                    loss_chars += len(own)
                    losses.update(own.encode())
                chars += len(text)
            if done:
                yield out()
                done.clear()
        close()
        if done:
            yield out()

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, schema)
