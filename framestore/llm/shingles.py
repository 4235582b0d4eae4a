r"""Word shingles of texts as 64-bit hashes, computed on whole Arrow batches with NumPy.

Words are runs of `[^\x20\x09-\x0D]` with A-Z in lower case. The set of a text holds its distinct
shingles of `width` words; a text with fewer words has its whole sequence as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.Generator(np.random.PCG64(2026))
#: A random number for each byte value.
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = np.uint64(_random.integers(1 << 62, 1 << 63, dtype=np.uint64) | np.uint64(1))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = int(base), pow(int(base), -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def need(self, n: int) -> None:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, size, 1 << 64))])


_POWERS = _Powers(_STEP)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and the n + 1 places where they begin and end."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return data, at - at[0]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] that does not depend on where it stands."""
    _POWERS.need(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _POWERS.up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _POWERS.down[starts] + (ends - starts).astype(np.uint64) * _ODD)


def sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, sorted. No words: an empty set."""
    data, at = text_bytes(column)
    if not len(data):
        yield from (np.zeros(0, np.uint64) for _ in range(len(column)))
        return
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[at] = True
    starts = np.flatnonzero(solid & (cut[:-1] | np.concatenate([[True], ~solid[:-1]])))
    ends = np.flatnonzero(solid & (cut[1:] | np.concatenate([~solid[1:], [True]]))) + 1
    lower = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    words = span_hashes(_BYTES[lower], starts, ends)
    first = np.searchsorted(starts, at)  # words before each text
    chain = words.copy()
    n = len(words) - width + 1
    if n > 0:
        full = words[:n].copy()
        for k in range(1, width):
            full = full * _ODD + words[k : n + k]
        chain[:n] = mix(full)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            found = np.sort(chain[a : b - width + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif b > a:
            one = np.uint64(b - a)
            for w in words[a:b]:
                one = mix(np.array([one * _ODD + w], dtype=np.uint64))[0]
            yield np.array([one], dtype=np.uint64)
        else:
            yield np.zeros(0, np.uint64)
