"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                     0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_CACHE_LIMIT = 300_000


class WordHashes(dict):
    """Word -> 64-bit hash, remembered for the words of recent texts."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHE_LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: str) -> np.ndarray:
        """Hashes of the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; bytes methods do just that."""
        words = text.encode("utf-8", "surrogatepass").lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


# A number for each byte of a word; A-Z stand for a-z.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) << np.uint64(17))
_BYTES[65:91] = _BYTES[97:123]
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = 0x9E3779B97F4A7C15
SEGMENT = 1 << 18  # bytes of a text hashed at a time


def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


class TextHashes:
    """Word hashes of whole texts at once: polynomials over a word's bytes, from running sums over the text's."""

    def __init__(self):
        self.up, self.down = _powers(_BASE, 4096), _powers(pow(_BASE, -1, 1 << 64), 4096)

    def _part(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n > len(self.up):
            self.up, self.down = _powers(_BASE, 2 * n), _powers(pow(_BASE, -1, 1 << 64), 2 * n)
        edges = np.flatnonzero(np.diff(_BLANK[data].view(np.int8), prepend=1, append=1))
        begins, ends = edges[::2], edges[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * self.up[:n], out=sums[1:])
        return mix((sums[ends] - sums[begins]) * self.down[begins])

    def of(self, text: str) -> np.ndarray:
        """Hashes of the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        if len(data) <= SEGMENT:
            return self._part(data)
        parts, low = [], 0
        while low < len(data):
            # A segment ends at a blank, so that no word is cut.
            rest = _BLANK[data[low + SEGMENT :]]
            high = low + SEGMENT + int(rest.argmax()) if rest.any() else len(data)
            parts.append(self._part(data[low:high]))
            low = high
        return np.concatenate(parts)


def shingles(words: np.ndarray) -> np.ndarray:
    """Distinct shingle hashes, ascending; a text of fewer words is one shingle, an empty one none."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < WORDS:
        return mix((words * _FACTORS[:n]).sum(keepdims=True) + np.uint64(n))
    total = np.zeros(n - WORDS + 1, np.uint64)
    for i in range(WORDS):
        total += words[i : n - WORDS + 1 + i] * _FACTORS[i]
    total = mix(total)
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]
