"""Repeated windows by Aho-Corasick automata over recurring passages.

Of the segments in a shard, the passages that two documents have are confirmed by their words, each in the
document with the smallest id: consecutive windows of it that another document has too. The passages are
compiled into an automaton, and the segments of all documents stream through it; its matches are the
passages' occurrences. A match in a document with a larger id than the passage's is a repeated window.

An automaton reads letters. Words are read in blocks of up to ten, each block as a few letters of its hash;
the blocks that start at the same place modulo their length follow each other, so a window is a string, and
matches start at blocks, as a block's first letter is of its own alphabet. Windows of 50 words are compared
by 100 bits. Alphabets are small because the library's nodes look for their edges one by one.
"""

from __future__ import annotations

import ahocorasick
import numpy as np

from walletgraph.llm.passages import Context, spread
from walletgraph.llm.words import SPACED, Hasher, mix

#: Words that stream through one automaton, at most one phrase's more; its patterns are fewer.
MOST = 1 << 18
_BITS, _FIRST, _INNER, _GAP = 5, 64, 96, 33


def block_words(size: int) -> int:
    return max(d for d in range(1, 11) if size % d == 0)


def letters(blocks: np.ndarray, many: int) -> np.ndarray:
    """A row of `many` letters for each block's hash."""
    shift = np.arange(many, dtype=np.uint64) * np.uint64(_BITS)
    code = (blocks[:, None] >> shift & np.uint64((1 << _BITS) - 1)).astype(np.uint8)
    return code + np.where(np.arange(many) == 0, _FIRST, _INNER).astype(np.uint8)


class Stream:
    """Segments as one string: for each place modulo a block's length the blocks from there on, then a gap."""

    def __init__(self, context: Context, size: int):
        self.block = block_words(size)
        self.count = size // self.block
        self.letters = min(12, -(-20 // self.count))
        phases = np.arange(self.block)
        many = np.maximum(0, (context.length[:, None] - self.block - phases[None, :]) // self.block + 1)
        self.entry = np.repeat(np.arange(len(many)), (many + 1).sum(axis=1))  # of each block: its segment
        many = many.ravel() + 1
        nth = spread(np.zeros(len(many), np.int64), many)
        self.start = np.repeat(np.tile(phases, len(context.length)), many) + self.block * nth  # and its first word
        gap = nth == np.repeat(many, many) - 1
        hashes = mix(Hasher(SPACED).grams(context.words, self.block))
        where = np.where(gap, 0, context.start[self.entry] + self.start)
        self.rows = np.where(gap[:, None], np.uint8(_GAP), letters(hashes[where], self.letters)) if len(hashes) else np.zeros((0, self.letters), np.uint8)
        self.whole = np.zeros(len(gap), bool)  # a window starts here
        if len(gap):
            left = np.repeat(many - 1, many) - nth
            self.whole = left >= self.count

    def patterns(self, at: np.ndarray) -> list[str]:
        width = self.count * self.letters
        flat = self.rows.ravel()
        index = (at * self.letters)[:, None] + np.arange(width)[None, :]
        return flat[index].view(f"S{width}").ravel().astype(f"U{width}").tolist() if len(at) else []

    def text(self) -> str:
        return self.rows.tobytes().decode("ascii")


def passages(context: Context, stream: Stream, size: int) -> list[np.ndarray]:
    """Recurring passages, as the places of their windows in the stream: each window once, in the smallest document that has it."""
    at = np.flatnonzero(stream.whole)
    at = at[np.lexsort((stream.start[at], stream.entry[at]))]
    place = context.start[stream.entry[at]] + stream.start[at]
    windows, doc = Hasher(SPACED).grams(context.words, size)[place], context.doc[stream.entry[at]]
    order = np.lexsort((np.arange(len(at)), doc, windows))
    first = np.flatnonzero(np.r_[True, windows[order][1:] != windows[order][:-1]][: len(order)])
    last = np.r_[first[1:], len(order)] - 1 if len(first) else first
    own = np.sort(order[first[doc[order[first]] != doc[order[last]]]])
    breaks = np.flatnonzero((np.diff(place[own]) != 1) | (np.diff(stream.entry[at[own]]) != 0)) + 1
    return np.split(at[own], breaks) if len(own) else []


def compiled(stream: Stream, found: list[np.ndarray]) -> tuple[ahocorasick.Automaton, np.ndarray]:
    """An automaton of the passages' windows, whose values count them, and the segment of each."""
    machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    own = np.concatenate(found) if found else np.zeros(0, np.int64)
    for i, pattern in enumerate(stream.patterns(own)):
        machine.add_word(pattern, i)
    machine.make_automaton()
    return machine, stream.entry[own]


def match(context: Context, size: int, k: int) -> np.ndarray:
    mask = np.zeros(len(context.doc), np.uint64)
    if not len(mask):
        return mask
    stream = Stream(context, size)
    machine, holder = compiled(stream, passages(context, stream, size))
    if not len(machine):
        return mask
    hits = np.array(list(machine.iter(stream.text())), np.int64).reshape(-1, 2)
    start = hits[:, 0] // stream.letters - (stream.count - 1)
    entry = stream.entry[start]
    later = context.doc[entry] > context.doc[holder[hits[:, 1]]]
    entry, start = entry[later], start[later]
    np.bitwise_or.at(mask, entry, np.uint64(1) << (context.offset[entry] - stream.start[start]).astype(np.uint64))
    return mask
