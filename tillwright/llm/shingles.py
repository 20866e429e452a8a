"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Distinct words whose hashes one worker keeps. It limits memory only.
MAX_WORDS = 100_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = _WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers in which every bit depends on all."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def chained(rows: np.ndarray) -> np.ndarray:
    """One hash for each column of a two-dimensional array, dependent on the order of its rows."""
    found = np.full(rows.shape[1:], len(rows), np.uint64)
    for row in rows:
        found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + row)
    return found


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word: A-Z in lower case, cut at space, tab and the line breaks of ASCII."""
    if len(_hashes) > MAX_WORDS:
        _hashes.clear()
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; a shorter text is one run, none without words."""
    if not text:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(text)
    if len(hashes) <= words:
        return chained(hashes[:, None]) if len(hashes) else hashes
    return np.unique(chained(np.stack([hashes[n : len(hashes) - words + 1 + n] for n in range(words)])))
