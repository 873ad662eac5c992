"""Hashed word n-grams and skip-grams, as numbers."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
CACHED_WORDS = 500_000


class WordHashes(dict):
    """Hash of each word seen; emptied when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        return np.fromiter((self[w] for w in words), np.uint64, len(words))


def mixed(numbers: np.ndarray) -> np.ndarray:
    """Spread numbers over 64 bits (the finisher of splitmix64, fixed values)."""
    numbers = (numbers ^ (numbers >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    numbers = (numbers ^ (numbers >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return numbers ^ (numbers >> np.uint64(31))


def grams(words: np.ndarray, up_to: int, skips: int, bits: int) -> np.ndarray:
    """Indexes below ``2 ** bits`` of all n-grams of ``up_to`` words, and of all pairs ``skips`` or fewer words apart."""
    found, run = [words], words
    for n in range(2, up_to + 1):
        run = mixed(run[:-1] * np.uint64(3) + words[n - 1 :]) if len(words) >= n else run[:0]
        found.append(run)
    for skip in range(1, skips + 1):
        if len(words) > skip + 1:
            found.append(mixed(words[: -skip - 1] * np.uint64(5 + 2 * skip) + words[skip + 1 :]))
    return (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)
