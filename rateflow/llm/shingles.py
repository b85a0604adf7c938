"""Sets of word shingles and their minwise signatures, on whole Arrow batches.

Words are the runs between ASCII white space, A-Z in lower case.  Hashes are
64 bits: a rolling polynomial over random values of the bytes, mixed per word
and again over the words of a shingle.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
_random = np.random.default_rng(20240607)
_BYTES = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BYTES[ord("A"):ord("Z") + 1] = _BYTES[ord("a"):ord("z") + 1]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(_MIX[0])
    x ^= x >> np.uint64(33)
    x *= np.uint64(_MIX[1])
    x ^= x >> np.uint64(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse (mod 2**64)."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * len(_POWERS[0]))
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts that lie one after the other in ``data``,
    and the number of words up to the end of each text."""
    space = _SPACE[data]
    inner = np.zeros(len(data) + 1, dtype=bool)          # no word goes over a text's end
    inner[1:] = space
    inner[0] = True
    inner[ends] = True
    starts = np.flatnonzero(inner[:-1] & ~space)
    stops = np.append(space, True)
    stops[ends] = True
    stops = np.flatnonzero(stops)
    stops = stops[np.searchsorted(stops, starts, side="right")] if len(starts) else starts
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * power[:-1], out=sums[1:])
    words = mixed((sums[stops] - sums[starts]) * inverse[starts])
    return words, np.searchsorted(starts, ends, side="left")


def shingle_sets(data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, upto = word_hashes(data, ends)
    rolled = words[: max(0, len(words) - WORDS + 1)].copy()
    for j in range(1, WORDS):
        rolled = mixed(rolled * np.uint64(_BASE) + words[j:j + len(rolled)])
    out, first = [], 0
    for last in upto:
        n = last - first
        if n >= WORDS:
            out.append(np.unique(rolled[first:last - WORDS + 1]))
        elif n:
            short = words[first:first + 1] + np.uint64(n)
            for j in range(1, n):
                short = mixed(short * np.uint64(_BASE) + words[first + j:first + j + 1])
            out.append(short)
        else:
            out.append(np.empty(0, np.uint64))
        first = last
    return out


def batch_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a non-null string column and where each text ends."""
    import pyarrow as pa

    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets[1:] - offsets[0]


MULTIPLIERS = np.random.default_rng(7).integers(0, 2**64, 128, dtype=np.uint64) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """128 minwise values (a 32-bit hash of each) of a non-empty set."""
    low = np.full(len(MULTIPLIERS), MASK, dtype=np.uint64)
    for at in range(0, len(shingles), 256):
        np.minimum(low, (MULTIPLIERS[:, None] * shingles[None, at:at + 256]).min(axis=1), out=low)
    return (mixed(low) >> np.uint64(32)).astype(np.uint32)
