"""Simple-8b coding of unsigned ids in numpy, block by block.

A 64-bit word holds a selector in its top four bits and ids of one width in the other sixty; the
encoder takes the selector that packs the most of the ids that follow. Ids are coded in blocks of
``BLOCK``, each starting a word of its own, so blocks are encoded and decoded side by side. An id
too wide for its neighbours escapes to a word with fewer, wider slots, the widest being one slot
of sixty bits. The last word of a block is filled with zeros, which the block's length cuts off.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4096
# Fixed values of the code: ids per word by selector; selectors 0 and 1 are not used.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = tuple(60 // n for n in COUNTS)
FIRST_SELECTOR = 2
SELECTORS = len(COUNTS)


def _compared(ids: np.ndarray) -> np.ndarray:
    out = np.zeros(ids.shape, np.uint8)
    for width in WIDTHS:
        out += ids >= np.uint64(1 << width)
    return out


_SHORT = _compared(np.arange(1 << 16, dtype=np.uint64))


def _too_narrow(ids: np.ndarray) -> np.ndarray:
    """For each id how many selectors are too narrow for it."""
    if int(ids.max()) < len(_SHORT):
        return _SHORT[ids.astype(np.uint16)]
    return _compared(ids)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block) of an array of ids below 2**60."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    wide = np.zeros((blocks, BLOCK + COUNTS[0]), np.uint64)
    full = np.zeros(blocks * BLOCK, np.uint64)
    full[:n] = ids
    wide[:, :BLOCK] = full.reshape(blocks, BLOCK)
    if int(full.max()) >> 60:
        raise ValueError("ids must be below 2**60")
    need = _too_narrow(wide)
    # running maxima over as many ids as each selector packs, built from shorter ones
    most, reach = need, 1
    fits = np.zeros((blocks, BLOCK), np.uint8)
    for k in range(SELECTORS - 1, -1, -1):
        count = COUNTS[k]
        while reach < count:
            step = min(reach, count - reach)
            longer = most.copy()
            longer[:, :-step] = np.maximum(most[:, :-step], most[:, step:])
            most, reach = longer, reach + step
        # distinct widths grow from selector to selector, so k too narrow ones are the first k
        fits += most[:, :BLOCK] <= k
    chosen = SELECTORS - fits  # fitting selectors are the last ones
    jump = np.array([*COUNTS, 1], np.int64)[chosen]
    limit = np.full(blocks, BLOCK)
    limit[-1] = n - (blocks - 1) * BLOCK
    at = np.zeros(blocks, np.int64)
    lanes = np.arange(blocks)
    trail: list[tuple[np.ndarray, np.ndarray]] = []
    while len(lanes):
        trail.append((lanes, at))
        at = at + jump[lanes, at]
        go = at < limit[lanes]
        lanes, at = lanes[go], at[go]
    lane, place = (np.concatenate([t[i] for t in trail]) for i in (0, 1))
    order = np.lexsort((place, lane))
    lane, place = lane[order], place[order]
    selector = chosen[lane, place]
    words = np.zeros(len(lane), np.uint64)
    for k in range(SELECTORS):
        own = np.flatnonzero(selector == k)
        if len(own):
            value = np.full(len(own), np.uint64(k + FIRST_SELECTOR) << np.uint64(60))
            for j in range(COUNTS[k]):
                value |= wide[lane[own], place[own] + j] << np.uint64(j * WIDTHS[k])
            words[own] = value
    return words, np.searchsorted(lane, np.arange(blocks)).astype(np.uint32)


def decode(words: np.ndarray, block_starts: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids that were encoded."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64) - FIRST_SELECTOR
    if len(words) == 0 or selector.min() < 0:
        raise ValueError("not a Simple-8b stream")
    count = np.array(COUNTS, np.int64)[selector]
    before = np.cumsum(count) - count
    lane = np.searchsorted(block_starts, np.arange(len(words)), "right") - 1
    place = lane * BLOCK + before - before[block_starts.astype(np.int64)][lane]
    out = np.zeros(len(block_starts) * BLOCK + COUNTS[0], np.uint64)
    stop = (lane + 1) * BLOCK
    for k in range(SELECTORS):
        own = np.flatnonzero(selector == k)
        mask = np.uint64((1 << WIDTHS[k]) - 1)
        for j in range(COUNTS[k] if len(own) else 0):
            to = place[own] + j
            real = to < stop[own]
            out[to[real]] = (words[own[real]] >> np.uint64(j * WIDTHS[k])) & mask
    return out[:n]
