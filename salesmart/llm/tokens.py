"""Byte-level BPE encoding of whole texts inside tasks, by the ``tokenizers`` library.

The ids are those of the library's plain call with ``add_special_tokens=False``. Its pre-tokenizer
never joins characters across a blank that has a character other than white space on at least one
side, nor a letter and the points and commas after it, nor those or a letter and the line break
after it where another letter follows. So a text may be cut there and its pieces encoded one by one
with the same ids. All texts of a batch are cut at once, the distinct pieces are looked up or
encoded, and the ids of the batch are gathered by piece number. Running text repeats its words,
hence each worker keeps the ids of pieces it has met. Texts that hold the string of a special token,
the cut mark, or a blank between white space on both sides are encoded in one go.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Entries a worker keeps (about 100 MB): frequent pieces come first; later ones are encoded anew.
CACHE_PIECES = 500_000
# Text encoded at once, which looks up a repeated piece once; one document may be larger.
ENCODED_BYTES = 4_000_000
# A longer piece is encoded but not remembered, which bounds the memory in bytes.
CACHE_PIECE_LENGTH = 48

_MARK = "\x01"
_LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_UNSAFE = re.compile(r"[\s\x85\xa0] (?=[\s\x85\xa0]|\Z)")
_STOPS = re.compile(rf"[.,](?<={_LETTER}[.,])[.,]*(?=[{_MARK}\n]|\Z)")
_BREAK = re.compile(rf"\n(?<=(?:{_LETTER}|[.,])\n)(?={_LETTER})")
_WORD = re.compile(rf" {_LETTER}+")
_LOADED: dict[str, BpeEncoder] = {}


def cut(text: str) -> str:
    """The text with marks where it may be cut."""
    marked = _STOPS.sub(rf"{_MARK}\g<0>", text.replace(" ", f"{_MARK} "))
    return _BREAK.sub(f"{_MARK}\n{_MARK}", marked) if "\n" in marked else marked


class BpeEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes. Null and empty texts have none."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        added = self.model.get_added_tokens_decoder()
        self.special = [x.content for x in added.values()]
        self.blank = np.zeros(max([self.model.get_vocab_size() - 1, *added]) + 1, bool)  # ids that begin with a blank
        self.blank[[k for x, k in self.model.get_vocab(with_added_tokens=False).items() if x[0] == "Ġ"]] = True
        self.known: dict[bytes, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.model.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of pieces not met before. Blank and letters: in one call, each begins with the only ids that hold a blank."""
        words, texts, others = [], [], []
        for piece in pieces:
            text = piece.decode()
            if _WORD.fullmatch(text):
                words.append(piece)
                texts.append(text)
            else:
                others.append((piece, text))
        found = dict(zip([p for p, _ in others], self._encode([t for _, t in others]), strict=True))
        for at in range(0, len(words), 10_000):
            (raw,) = self._encode(["".join(texts[at : at + 10_000])])
            cuts = [*(4 * np.flatnonzero(self.blank[np.frombuffer(raw, "<u4")])).tolist(), len(raw)]
            found.update(zip(words[at : at + 10_000], [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [x or "" for x in texts]
        odd = [k for k, x in enumerate(texts) if _MARK in x or any(s in x for s in self.special) or _UNSAFE.search(x)]
        whole = dict(zip(odd, self._encode([texts[k] for k in odd]), strict=True))
        lists = pc.split_pattern(pa.array(["" if k in whole else cut(x) for k, x in enumerate(texts)], pa.large_string()), _MARK)
        words = lists.flatten().dictionary_encode()
        _, bounds, letters = words.dictionary.buffers()
        at, letters = np.frombuffer(bounds, np.int64, len(words.dictionary) + 1).tolist(), letters.to_pybytes() if letters else b""
        pieces = [letters[a:b] for a, b in zip(at, at[1:], strict=False)]
        known = self.known
        ids = [known.get(x) for x in pieces]
        new = [k for k, x in enumerate(ids) if x is None]
        fresh = self._learn([pieces[k] for k in new])
        for k in new:
            ids[k] = fresh[pieces[k]]
        for piece, value in fresh.items():
            if len(known) >= CACHE_PIECES:
                break
            if len(piece) <= CACHE_PIECE_LENGTH:
                known[piece] = value
        # ids of all pieces in the order of the texts
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        order = words.indices.to_numpy()
        lengths = sizes[order]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        flat = np.frombuffer(b"".join(ids), "<u4")
        gathered = flat[np.repeat(starts[order] - ends[:-1], lengths) + np.arange(ends[-1])].tobytes()
        cuts = ends[lists.offsets.to_numpy()] * 4
        out = [gathered[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        for k, raw in whole.items():
            out[k] = raw
        del lists, words, order
        pa.default_memory_pool().release_unused()  # a worker lives on after its task
        return out


def bpe_encoder(path: str) -> BpeEncoder:
    """The encoder of a worker process, loaded once per file."""
    if path not in _LOADED:
        _LOADED[path] = BpeEncoder(path)
    return _LOADED[path]


def default_tokenizer() -> str:
    """Path of the public byte-level vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
