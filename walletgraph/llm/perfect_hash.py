"""A minimal perfect hash of 128-bit keys, without the keys: levels of bits, as in BBHash (Limasset et al., 2017).

On each level the keys that are left are hashed to twice as many places; those alone at theirs set a bit and are
done, the others go on to the next level. A key's number is the count of bits before its own. It takes some 3.3 bits
a key; keys that were not among those it was made of get any number, or none.
"""

from __future__ import annotations

import numpy as np

from walletgraph.llm.words import BASE, mix

#: Places for each key that is left, at least 64.
SPARE = 2


def _places(level: int, high: np.ndarray, low: np.ndarray, size: int) -> np.ndarray:
    odd = np.uint64((BASE * (2 * level + 3) | 1) & (1 << 64) - 1)
    return mix((high ^ low * odd) + np.uint64(level + 1) * np.uint64(0xD1B54A32D192ED03 >> 8)) % np.uint64(size)


class PerfectHash:
    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.before = np.cumsum(np.bitwise_count(bits), dtype=np.int64) - np.bitwise_count(bits)
        self.base = np.cumsum(sizes) - sizes

    @staticmethod
    def of(high: np.ndarray, low: np.ndarray) -> PerfectHash:
        """Of distinct pairs."""
        sizes, bits = [], []
        while len(high):
            size = max(64, -(-SPARE * len(high) // 64) * 64)
            at = _places(len(sizes), high, low, size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size), bits.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = ~alone[at]
            high, low = high[left], low[left]
        return PerfectHash(np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, np.uint64))

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """A number for each key, -1 for some of those that it was not made of."""
        out, left = np.full(len(high), -1, np.int64), np.arange(len(high))
        for level, (size, base) in enumerate(zip(self.sizes.tolist(), self.base.tolist(), strict=True)):
            if not len(left):
                break
            at = _places(level, high[left], low[left], size).astype(np.int64) + base
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            hit = word >> bit & np.uint64(1) == 1
            own = np.bitwise_count(word & (np.uint64(1) << bit) - np.uint64(1)).astype(np.int64) + self.before[at >> 6]
            out[left[hit]] = own[hit]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        return np.r_[len(self.sizes), self.sizes].astype(np.int64).tobytes() + self.bits.tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> PerfectHash:
        many = int(np.frombuffer(data, np.int64, 1)[0])
        return PerfectHash(np.frombuffer(data, np.int64, many, 8), np.frombuffer(data, np.uint64, -1, 8 * (many + 1)))
