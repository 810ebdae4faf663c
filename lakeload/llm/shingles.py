"""Word and shingle hashes inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_MASK = (1 << 64) - 1


def _odd_numbers(seed: int, count: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(str(i), seed) | 1 for i in range(count)], dtype=np.uint64)


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    """Spread the bits of 64-bit values; one-to-one for each seed."""
    out = values ^ np.uint64(xxhash.xxh64_intdigest("mix", seed))
    for shift, factor in ((np.uint64(30), _MIXERS[0]), (np.uint64(27), _MIXERS[1])):
        out = (out ^ (out >> shift)) * factor
    return out ^ (out >> np.uint64(31))


_MIXERS = _odd_numbers(11, 2)


class WordHashes:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, limit: int = 500_000):
        self.limit, self.known = limit, _Known()

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known = _Known()
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.uint64, count=len(words))


class _Known(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class Shingler:
    """Distinct shingle hashes of a text, sorted."""

    def __init__(self, width: int = 5):
        self.width, self.words = width, WordHashes()
        self.factors = _odd_numbers(23, width)

    def __call__(self, text: bytes | None) -> np.ndarray:
        """ASCII-lower-cased words split at ASCII blanks. Fewer words than the width are one shingle."""
        words = self.words(text.lower().split()) if text else np.empty(0, np.uint64)
        count = len(words) - self.width + 1
        if len(words) == 0:
            return words
        if count < 1:
            value = np.array([len(words)], np.uint64)
            for i in range(len(words)):
                value = mix(value ^ (words[i:i + 1] * self.factors[i:i + 1]), 41)
            return value
        total = words[:count] * self.factors[0]
        for i in range(1, self.width):
            total += words[i:i + count] * self.factors[i]
        total = mix(total, 7)
        total.sort()
        return total[np.concatenate(([True], total[1:] != total[:-1]))]
