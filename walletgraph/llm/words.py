"""Words and word n-grams of whole texts as 64-bit hashes, computed on the UTF-8 bytes of Arrow batches.

A word's hash is a polynomial over its bytes, taken as a difference of prefix sums (modulo 2^64), then
mixed; an n-gram's hash is the same over its words' hashes. All of it is vectorised, and texts are worked
on in pieces of about a megabyte, cut between words, so memory does not grow with a text's length beyond
its words' hashes. Texts of equal words have equal hashes; different ones collide with odds of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
PIECE = 1 << 20


@dataclass(frozen=True)
class Alphabet:
    """is_word: by byte. fold: the byte that each byte counts as."""

    is_word: bytes
    fold: bytes


_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SAME = bytes(range(256))
#: Words [^\x20\x09-\x0D]+, unchanged or with A-Z lower-cased.
SPACED = Alphabet(bytes(b not in (32, 9, 10, 11, 12, 13) for b in range(256)), _SAME)
SPACED_LOWER = Alphabet(SPACED.is_word, _FOLD)
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lower-cased.
PLAIN_LOWER = Alphabet(bytes(b >= 128 or 48 <= _FOLD[b] <= 57 or 97 <= _FOLD[b] <= 122 for b in range(256)), _FOLD)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Keeps the tables of powers between batches of one task."""

    def __init__(self, alphabet: Alphabet):
        fold = np.frombuffer(alphabet.fold, np.uint8)
        self.is_word = np.frombuffer(alphabet.is_word, np.uint8).astype(bool)
        self.values = _BYTE_VALUES[fold]
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = _powers(BASE, size), _powers(BASE_INVERSE, size)
        return self.up, self.down

    def _piece(self, seg: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the words; a word also ends at each of cuts."""
        word = self.is_word[seg]
        edge = np.flatnonzero(word[1:] & ~word[:-1]) + 1
        inner = cuts[(cuts > 0) & (cuts < len(seg))]
        starts = np.union1d(edge, inner[word[inner]]) if len(inner) else edge
        if len(seg) and word[0]:
            starts = np.r_[0, starts[starts > 0]]
        stop = np.flatnonzero(word[:-1] & ~word[1:]) + 1
        ends = np.union1d(stop, inner[word[inner - 1]]) if len(inner) else stop
        if len(seg) and word[-1]:
            ends = np.r_[ends[ends < len(seg)], len(seg)]
        up, down = self.powers(len(seg))
        total = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(self.values[seg] * up[: len(seg)], out=total[1:])
        return starts, ends, mix((total[ends] - total[starts]) * down[starts])

    def words(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of consecutive documents: index of the first, number of words of each, and all words' hashes."""
        data, offsets = raw_bytes(column)
        n, at = len(offsets) - 1, 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, side="right")) - 1)
            lo, hi = int(offsets[at]), int(offsets[to])
            if hi - lo <= 2 * PIECE:
                starts, _, hashes = self._piece(data[lo:hi], offsets[at:to] - lo)
                counts = np.diff(np.searchsorted(starts, offsets[at : to + 1] - lo))
            else:  # one long text
                parts = []
                while lo < hi:
                    cut = min(hi, lo + PIECE)
                    while cut < hi:  # on to the end of a word
                        gap = np.flatnonzero(~self.is_word[data[cut : min(hi, cut + PIECE)]])
                        cut = cut + int(gap[0]) if len(gap) else min(hi, cut + PIECE)
                        if len(gap):
                            break
                    parts.append(self._piece(data[lo:cut], np.zeros(0, np.int64))[2])
                    lo = cut
                hashes = np.concatenate(parts)
                counts = np.array([len(hashes)])
            yield at, counts, hashes
            at = to

    def grams(self, hashes: np.ndarray, k: int) -> np.ndarray:
        """Hash of each k consecutive words, across documents too; see whole()."""
        n = len(hashes)
        if n < k:
            return np.zeros(0, np.uint64)
        up, down = self.powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * up[:n], out=total[1:])
        return mix((total[k:] - total[: n - k + 1]) * down[: n - k + 1])

    def spans(self, hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of the words from lo to hi, for each pair; that of an n-gram if they are n."""
        up, down = self.powers(len(hashes) + 1)
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[: len(hashes)], out=total[1:])
        return mix((total[hi] - total[lo]) * down[lo])

    def sequence(self, hashes: np.ndarray) -> int:
        """Hash of a whole sequence, never that of an n-gram of another length."""
        up, _ = self.powers(len(hashes) + 1)
        return int(mix(np.array([(hashes * up[: len(hashes)]).sum(dtype=np.uint64) + np.uint64(len(hashes))]))[0])


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets; null texts are empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    body = column.buffers()[2]
    return (np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)), offsets


def within(counts: np.ndarray, k: int) -> np.ndarray:
    """For each start of k consecutive words among all documents' words: whether they are of one document."""
    n = int(counts.sum())
    if n < k:
        return np.zeros(0, bool)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(n)
    return left[: n - k + 1] >= k


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, in time that does not depend on w."""
    n = len(x)
    if n < w:
        return x[:0]
    pad = np.full(-n % w, np.iinfo(x.dtype).max, x.dtype)
    rows = np.r_[x, pad].reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])
