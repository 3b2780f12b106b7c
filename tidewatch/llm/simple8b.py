"""Word-aligned coding of token ids: a 64-bit word holds a selector in its top four bits and as many ids as fit in
lanes of that selector's width.

Ids are cut into blocks of ``BLOCK``; a block starts a new word, and the offset of each block's first word is kept, so
any block can be decoded alone and all of them at once. An id too large for the widest lane is escaped: its lane has
the largest value a lane can hold, and the id stands in a list beside the words, in order.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128
ESCAPE_BITS = 15
ESCAPE = (1 << ESCAPE_BITS) - 1

# Lanes per word and bits per lane, by selector: every count for which 60 bits give another width.
LANES = tuple((60 // bits, bits) for bits in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, ESCAPE_BITS))
_COUNT = np.array([c for c, _ in LANES], np.int64)
_WIDEST = LANES[0][0]
_BITS = np.array([max(1, v.bit_length()) for v in range(ESCAPE + 1)], np.uint8)

_MAGIC = 0x42383453  # "S48B"


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each place of each block, the selector with most lanes into which the ids from there on fit."""
    rows, width = bits.shape
    padded = np.zeros((rows, width + _WIDEST), np.uint8)
    padded[:, :width] = bits
    best = np.full((rows, width), len(LANES) - 1, np.uint8)
    spans = {1: padded}
    power = 1
    while power * 2 <= _WIDEST:
        wide = spans[power].copy()
        np.maximum(wide[:, :-power], spans[power][:, power:], out=wide[:, :-power])
        spans[power * 2] = wide
        power *= 2
    for selector in range(len(LANES) - 2, -1, -1):
        count, lane = LANES[selector]
        power = 1 << (count.bit_length() - 1)
        top = spans[power][:, :width]
        if count > power:  # two overlapping spans cover the count
            top = np.maximum(top, spans[power][:, count - power : count - power + width])
        best[top <= lane] = selector
    return best


def encode(ids: np.ndarray) -> bytes:
    """The ids (unsigned, below 2^32) as header, block offsets, words and escapes, little-endian."""
    ids = np.ascontiguousarray(ids, np.uint32)
    blocks = -(-len(ids) // BLOCK)
    values = np.zeros((blocks, BLOCK + _WIDEST), np.uint64)
    full = np.zeros(blocks * BLOCK, np.uint32)
    full[: len(ids)] = ids
    escaped = full >= ESCAPE
    values[:, :BLOCK] = np.where(escaped, ESCAPE, full).reshape(blocks, BLOCK)
    length = np.minimum(BLOCK, len(ids) - BLOCK * np.arange(blocks))
    selectors = _selectors(_BITS[values[:, :BLOCK].astype(np.int64)])

    place = np.zeros(blocks, np.int64)
    alive = np.arange(blocks)
    owners, places, chosen = [], [], []
    while len(alive):  # every block takes its next word; 32 rounds at most
        selector = selectors[alive, place[alive]]
        owners.append(alive)
        places.append(place[alive])
        chosen.append(selector)
        place[alive] += _COUNT[selector]
        alive = alive[place[alive] < length[alive]]
    none = [np.zeros(0, np.int64)]
    owner, at, selector = (np.concatenate(x or none).astype(np.int64) for x in (owners, places, chosen))
    order = np.argsort(owner * BLOCK + at, kind="stable")
    owner, at, selector = owner[order], at[order], selector[order]
    words = selector.astype(np.uint64) << np.uint64(60)
    flat = values.ravel()
    begin = owner * values.shape[1] + at
    for s, (count, lane) in enumerate(LANES):
        these = np.flatnonzero(selector == s)
        if len(these):
            for k in range(count):
                words[these] |= flat[begin[these] + k] << np.uint64(lane * k)
    offsets = np.searchsorted(owner, np.arange(blocks)).astype("<u4")
    escapes = full[escaped].astype("<u4")
    header = np.array([_MAGIC, len(ids), len(words), len(escapes)], "<u8")
    return header.tobytes() + offsets.tobytes() + words.astype("<u8").tobytes() + escapes.tobytes()


def decode(data: bytes) -> np.ndarray:
    """The ids of ``encode``."""
    magic, n, n_words, n_escapes = (int(x) for x in np.frombuffer(data, "<u8", 4))
    if magic != _MAGIC:
        raise ValueError("not a block of coded ids")
    blocks = -(-n // BLOCK)
    offsets = np.frombuffer(data, "<u4", blocks, 32).astype(np.int64)
    words = np.frombuffer(data, "<u8", n_words, 32 + 4 * blocks)
    escapes = np.frombuffer(data, "<u4", n_escapes, 32 + 4 * blocks + 8 * n_words)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNT[selector]
    before = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(blocks), np.diff(np.append(offsets, n_words)))
    width = BLOCK + _WIDEST
    begin = owner * width + before[:-1] - before[offsets][owner]
    out = np.zeros((blocks, width), np.uint32)
    flat = out.ravel()
    for s, (count, lane) in enumerate(LANES):
        these = np.flatnonzero(selector == s)
        if len(these):
            mask = np.uint64((1 << lane) - 1)
            for k in range(count):
                flat[begin[these] + k] = (words[these] >> np.uint64(lane * k)) & mask
    ids = out[:, :BLOCK].ravel()[:n]
    ids[ids == ESCAPE] = escapes
    return ids
