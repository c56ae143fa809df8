"""Vector bin packing of token pieces into training sequences.

Every piece has a size in three dimensions: tokens, segments (one) and loss-bearing tokens. A
sequence has a limit in each. Items longer than a sequence first give off whole sequences. Of what
remains, an open sequence takes, among the pieces that still fit, the one with the largest dot
product of its size and the free room, both as shares of the limits. Where no piece fits any more
and tokens and segments are left over, the largest waiting piece is cut to fill the room.

Each task packs its own rows in windows of ``WINDOW`` items, so no row is shuffled, memory is
bounded by a window, and a lost task is repeated alone with the same result. What a window leaves
in its last sequence is carried to the next window. A sequence that ends short of its tokens, since
the rows end or since it has all the segments or loss it admits, is split into sequences of
power-of-two length, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from salesmart.llm.texts import column, keyed, slices
from salesmart.llm.tokens import ENCODED_BYTES, bpe_encoder

LENGTH = 1024
SEGMENTS = 32
END = 0
WINDOW = 2048

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Packs items (key, tokens, loss tokens at the front of them) of one task.

    ``pack`` yields (sequence, offset, key, start, length) for pieces of complete sequences.
    ``loss_limit`` bounds the loss-bearing tokens of a sequence; loss is spread evenly over an
    item, so a piece bears its share, rounded up.
    """

    def __init__(self, length: int = LENGTH, segments: int = SEGMENTS, loss_limit: int | None = None):
        self.limits = np.array([length, segments, loss_limit or length], float)
        self.length, self.sequence = length, 0
        self.waiting: list[tuple[object, int, int, float]] = []  # key, start, tokens, loss share

    def _cut_to(self, tokens: int, share: float, room: np.ndarray) -> int:
        """Most tokens of an item that the room admits."""
        if room[1] < 1:
            return 0
        most = min(tokens, int(room[0]))
        return most if not share else min(most, int(room[2] / share))

    def _close(self, pieces: list) -> list[tuple]:
        out, at = [], 0
        for key, start, n in pieces:
            out.append((self.sequence, at, key, start, n))
            at += n
        self.sequence += 1
        return out

    def pack(self, items: list[tuple[object, int, int]], last: bool = False) -> list[tuple]:
        out = []
        for key, tokens, loss in items:
            share = loss / tokens if tokens else 0.0
            whole = self._cut_to(self.length, share, self.limits)
            start = 0
            while whole and tokens - start >= whole and whole == self.length:
                out += self._close([(key, start, whole)])
                start += whole
            if start < tokens:
                self.waiting.append((key, start, tokens - start, share))
        target = 0 if last else min(len(self.waiting), 64)
        waiting = self.waiting
        n = len(waiting)
        left = np.array([w[2] for w in waiting], np.int64)
        begin = np.array([w[1] for w in waiting], np.int64)
        share = np.array([w[3] for w in waiting], float)
        open_ = np.ones(n, bool)
        while open_.sum() > target:
            room = self.limits.copy()
            pieces: list[tuple] = []
            while room[0] >= 1 and room[1] >= 1:
                alive = np.flatnonzero(open_)
                if not len(alive):
                    break
                loss = np.ceil(left[alive] * share[alive])
                fits = (left[alive] <= room[0]) & (loss <= room[2])
                if fits.any():
                    free = room / self.limits
                    gain = left[alive] / self.limits[0] * free[0] + loss / self.limits[2] * free[2] + free[1] / self.limits[1]
                    pick = alive[np.argmax(np.where(fits, gain, -1.0))]
                    take = int(left[pick])
                else:
                    pick = alive[np.argmax(left[alive])]
                    take = self._cut_to(int(left[pick]), share[pick], room)
                    if take < 1:
                        break
                pieces.append((waiting[pick][0], int(begin[pick]), take))
                begin[pick] += take
                left[pick] -= take
                open_[pick] = left[pick] > 0
                room -= (take, 1, np.ceil(take * share[pick]))
            if not pieces:
                raise ValueError("an item has a token that bears more loss than a sequence admits")
            # full sequences stay whole; one that another limit closed early is cut like the last one
            out += self._powers(pieces)
        self.waiting = [(w[0], int(b), int(x), w[3]) for w, b, x, o in zip(waiting, begin, left, open_, strict=True) if o]
        return out

    def _powers(self, pieces: list[tuple]) -> list[tuple]:
        """Pieces as one full sequence, or as sequences of power-of-two length."""
        total, out = sum(p[2] for p in pieces), []
        rest = list(pieces)
        while total:
            size = self.length if total >= self.length else 1 << (total.bit_length() - 1)
            room, own = size, []
            while room:
                key, start, n = rest[0]
                take = min(n, room)
                own.append((key, start, take))
                rest[0] = (key, start + take, n - take)
                if take == n:
                    rest.pop(0)
                room -= take
            out += self._close(own)
            total -= size
        return out


def pack_documents(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, segments: int = SEGMENTS, loss_limit: int | None = None, end: int = END
) -> DataFrame:
    """Pieces of all documents, each its ids and the end id; every id lies in exactly one piece.

    All tokens of a plain document bear loss. A null text is empty and has the end id alone. Rows
    that repeat an id are documents of their own; rows without an id are packed under a null id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = bpe_encoder(tokenizer), Packer(length, segments, loss_limit)
        base = TaskContext.get().partitionId() << 36
        tail = np.array([end], "<u4").tobytes()
        ids: dict[int, tuple] = {}
        number, items = 0, []

        def rows(found: list[tuple]) -> pa.RecordBatch:
            cols: list[list] = [[] for _ in range(7)]
            for sequence, offset, key, start, n in found:
                doc, raw = ids[key]
                crc = zlib.crc32(raw[4 * start : 4 * (start + n)])
                for c, v in zip(cols, (doc, start, n, crc, len(raw) // 4, base + sequence, offset), strict=True):
                    c.append(v)
            alive = {w[0] for w in packer.waiting}
            for key in [k for k in ids if k not in alive]:
                del ids[key]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

        for batch in slices(batches, size=ENCODED_BYTES):
            docs_ = column(batch, "doc_id").to_pylist()
            for doc, raw in zip(docs_, encoder.encode(column(batch, "text").to_pylist()), strict=True):
                ids[number] = (doc, raw + tail)
                items.append((number, len(raw) // 4 + 1, len(raw) // 4 + 1))
                number += 1
            if len(items) >= WINDOW:
                found = packer.pack(items)
                items = []
                yield rows(found)
        yield rows(packer.pack(items, last=True))

    return keyed(docs, "doc_id", "text").mapInArrow(run, PIECES)
