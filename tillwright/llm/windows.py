"""Fingerprints of all windows of a byte string, for sorting its suffixes digit by digit."""

from __future__ import annotations

import numpy as np

from tillwright.llm.shingles import mixed

_RANDOM = np.random.default_rng(20_260_202)
_LETTERS = _RANDOM.integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(base) * 2 + 1 for base in _RANDOM.integers(1 << 60, 1 << 62, 2, np.uint64)]


_tables: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    """Powers of the base modulo 2**64; the longest table asked for is kept."""
    if len(_tables.get(base, ())) < size:
        found = np.full(1 << int(size - 1).bit_length(), base, np.uint64)
        found[0] = 1
        _tables[base] = np.multiply.accumulate(found, out=found)
    return _tables[base]


class Fingerprints:
    """Fingerprint of any stretch of ``data`` in constant time, by sums of weighted letters."""

    def __init__(self, data: np.ndarray, which: int):
        powers = _powers(_BASES[which], len(data) + 1)
        self.inverse = _powers(pow(_BASES[which], -1, 1 << 64), len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTERS[which][data] * powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
        """64-bit fingerprints of the stretches from ``starts`` to ``ends``."""
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def windows(self, width: int) -> np.ndarray:
        """Fingerprint of the window at every place."""
        n = len(self.sums) - width
        return self.of(slice(0, n), slice(width, None))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbouring values: block-wise minima from the left and from the right."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])
