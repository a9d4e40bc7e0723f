"""Simple-8b coding of unsigned integers in 64-bit words, with numpy.

The top four bits of a word select how many values it holds and how wide each
is; values fill the word from its low end. Selector 15 is the escape: the word
after it is one raw 64-bit value, for values of 2**60 and more. Selector 0 is
not used. A stream is cut into blocks of at most ``BLOCK`` values; the size and
the first word of each are listed, so blocks are decoded independently and all
at once, and streams are joined by joining their words and lists.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4096
#: (values, bits) of selectors 1 to 14, fixed by the format.
PACKINGS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7),
    (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
ESCAPE = 15
COUNTS = np.array([0, *[n for n, _ in PACKINGS], 1], dtype=np.int64)
WIDTHS = np.array([0, *[w for _, w in PACKINGS], 64], dtype=np.int64)


def block_sizes(lengths: np.ndarray) -> np.ndarray:
    """Sizes of the blocks of several streams one after another; no block spans two."""
    lengths = np.asarray(lengths, dtype=np.int64)
    counts = -(-lengths // BLOCK)
    sizes = np.full(int(counts.sum()), BLOCK, dtype=np.int64)
    last = np.cumsum(counts)[counts > 0] - 1
    sizes[last] = (lengths - (counts - 1) * BLOCK)[counts > 0]
    return sizes


def _selectors(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """At each position the selector of the word that would start there.

    A word may reach past the end of its block: it is filled with zeros.
    """
    pad = PACKINGS[0][0]
    place = np.arange(len(values)) + np.repeat(np.arange(len(sizes)) * pad, sizes)
    bits = np.zeros(len(values) + (len(sizes) + 1) * pad, dtype=np.uint8)
    bits[place] = np.frexp(values.astype(np.float64))[1]  # may be one too many from 2**53 on
    chosen = np.full(len(bits), ESCAPE, dtype=np.uint8)
    window, reach = bits.copy(), 1
    for selector in range(len(PACKINGS), 0, -1):  # ever more and narrower values; the last that fits stays
        count, width = PACKINGS[selector - 1]
        more = count - reach  # no more than ``reach``, so two windows cover the larger one
        if more:
            np.maximum(window[:-more], window[more:], out=window[:-more])
            reach = count
        np.putmask(chosen, window <= width, selector)
    return chosen[place]


def encode(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, number of words of each block) of non-negative integers in blocks of ``sizes``."""
    values = np.asarray(values).astype(np.uint64)
    if not len(values):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(sizes), dtype=np.int64)
    chosen = _selectors(values, sizes)
    step = COUNTS[chosen]
    stops = np.cumsum(sizes)
    # All blocks at once, a word of each at a time.
    first = np.zeros(len(values), dtype=bool)
    at, until = (stops - sizes)[sizes > 0], stops[sizes > 0]
    while len(at):
        first[at] = True
        at = at + step[at]
        inside = at < until
        if not inside.all():
            at, until = at[inside], until[inside]
    starts = np.flatnonzero(first)
    per_block = np.diff(np.searchsorted(starts, stops), prepend=0)
    kinds = chosen[starts]
    escapes = (kinds == ESCAPE).astype(np.int64)
    place = np.arange(len(starts)) + np.cumsum(escapes) - escapes
    words = np.zeros(len(starts) + int(escapes.sum()), dtype=np.uint64)
    ends = np.repeat(stops, per_block)
    whole = starts + COUNTS[kinds] <= ends
    for kind in np.unique(kinds):
        mine = np.flatnonzero(kinds == kind)
        first = starts[mine]
        if kind == ESCAPE:
            words[place[mine]] = np.uint64(ESCAPE << 60)
            words[place[mine] + 1] = values[first]
            continue
        word = np.full(len(first), int(kind) << 60, dtype=np.uint64)
        # Only the last word of a block may reach past its end.
        inner, short = whole[mine], mine[~whole[mine]]
        full = first[inner]
        filled = word[inner]
        rest, edge, last = word[~inner], starts[short], ends[short]
        for k in range(COUNTS[kind]):
            shift = np.uint64(k * int(WIDTHS[kind]))
            filled |= values[full + k] << shift
            there = edge + k < last
            rest[there] |= values[edge[there] + k] << shift
        word[inner], word[~inner] = filled, rest
        words[place[mine]] = word
    block = np.repeat(np.arange(len(sizes)), per_block)
    return words, per_block + np.bincount(block, escapes, len(sizes)).astype(np.int64)


def decode(words: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of blocks with ``counts`` words and ``sizes`` values, all words of one kind at a time."""
    words = np.asarray(words, dtype=np.uint64)
    kinds = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    firsts = np.cumsum(counts) - counts
    if (kinds == ESCAPE).any():
        # A raw value may look like any word: walk the blocks that hold escapes.
        for at, count in zip(firsts.tolist(), np.asarray(counts).tolist(), strict=True):
            stop = at + count
            if (kinds[at:stop] == ESCAPE).any():
                while at < stop:
                    if kinds[at] == ESCAPE:
                        raw[at + 1] = True
                        at += 1
                    at += 1
    block = np.repeat(np.arange(len(sizes)), counts)[~raw]
    heads = np.flatnonzero(~raw)
    kinds = kinds[heads]
    held = COUNTS[kinds]
    before = np.cumsum(held) - held
    first_head = np.searchsorted(heads, firsts)
    begins = np.cumsum(sizes) - sizes
    out_at = before - before[np.minimum(first_head, len(heads) - 1)][block] + begins[block]
    limit = (begins + sizes)[block]
    out = np.zeros(int(np.sum(sizes)), dtype=np.uint64)
    for kind in np.unique(kinds):
        mine = kinds == kind
        where, stop, head = out_at[mine], limit[mine], heads[mine]
        if kind == ESCAPE:
            out[where] = words[head + 1]
            continue
        width = int(WIDTHS[kind])
        mask = np.uint64((1 << width) - 1)
        for k in range(COUNTS[kind]):
            there = where + k < stop
            out[where[there] + k] = words[head[there]] >> np.uint64(k * width) & mask
    return out
