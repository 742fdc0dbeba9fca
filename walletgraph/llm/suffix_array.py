"""Repeated windows by a sparse suffix array.

The suffixes are those that start at the chosen phrases. They are sorted by their words, and each is compared
with the next: the number of words that both start with tells where, at each depth, a run of suffixes that
agree begins. Matches are then extended to the left, word by word: at offset o two neighbours of a run that
agrees for `size` - o words match if their o words to the left agree too.
"""

from __future__ import annotations

import numpy as np

from walletgraph.llm.passages import Context
from walletgraph.llm.words import mix

#: Words that are sorted at a time; at most one phrase's more.
MOST = 1 << 20


def matrix(words: np.ndarray, at: np.ndarray, many: np.ndarray, width: int, step: int) -> np.ndarray:
    """A row of `width` words from each place on, or back from it; zeros where there are fewer than that."""
    column = np.arange(width)
    inside = column[None, :] < many[:, None]
    index = np.where(inside, at[:, None] + step * column[None, :], 0)
    return np.where(inside, words[index], np.uint64(0)) if len(words) else np.zeros((len(at), width), np.uint64)


def sorted_suffixes(suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of words, and how many words each row has in common with the one before; -1 for the first."""
    n, width = suffixes.shape
    order = np.argsort(suffixes.astype(">u8").view(f"S{8 * width}").ravel(), kind="stable")
    own = suffixes[order]
    differ = np.c_[own[1:] != own[:-1], np.ones((max(n - 1, 0), 1), bool)]
    return order, np.r_[-1, differ.argmax(axis=1)][:n]


def match(context: Context, size: int, k: int) -> np.ndarray:
    place, right = context.start + context.offset, context.length - context.offset
    order, common = sorted_suffixes(matrix(context.words, place, right, size, 1))
    place, offset, right, doc = place[order], context.offset[order], right[order], context.doc[order]
    left = matrix(context.words, place - 1, offset, size - k, -1)
    mask, extended = np.zeros(len(order), np.uint64), np.zeros(len(order), np.uint64)
    for o in range(size - k + 1):
        if o:
            extended = mix(extended + left[:, o - 1])
        run = np.cumsum(common < size - o)
        live = np.flatnonzero((o <= offset) & (right >= size - o))
        live = live[np.lexsort((extended[live], run[live]))]
        first = np.flatnonzero(np.r_[True, (run[live][1:] != run[live][:-1]) | (extended[live][1:] != extended[live][:-1])][: len(live)])
        if len(first):
            least = np.minimum.reduceat(doc[live], first)
            later = live[doc[live] > np.repeat(least, np.diff(np.r_[first, len(live)]))]
            mask[later] |= np.uint64(1) << np.uint64(o)
    out = np.zeros(len(order), np.uint64)
    out[order] = mask
    return out
