"""Words of many texts at once, as arrays: their places and 64-bit hashes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
# Everything but letters, where those outside ASCII count as letters.
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

STEP = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number scattered over all 64 bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x5851F42D4C957F2D
_UP, _DOWN = _powers(_BASE, STEP + 1), _powers(pow(_BASE, -1, 1 << 64), STEP + 1)


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    # The first word of each text, and the number of all words at last.
    first: np.ndarray


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words of a slice."""
    up, down = _UP, _DOWN
    if len(data) >= len(up):
        up, down = _powers(_BASE, len(data) + 1), _powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODE[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start])


def words_of(data: np.ndarray, bounds: np.ndarray, lower: bool = False, apart: np.ndarray = WHITE) -> Words:
    """The words of the texts whose bytes lie in `data` one after the other, from `bounds` on.

    Words are what the bytes marked in `apart` part: white space (space, and 0x09 to 0x0D) if nothing
    else is said. A text's end parts words too.
    """
    inside = ~apart[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    opened = inside.copy()
    edges = bounds[:-1][bounds[:-1] < len(data)]
    joined = before[:-1]
    kept = joined[edges].copy()
    joined[edges] = False
    opened &= ~joined
    joined[edges] = kept
    start = np.flatnonzero(opened)
    closed = before[1:].copy()
    follows = np.zeros(len(data), bool)
    if len(data):
        follows[:-1] = inside[1:] & ~opened[1:]
    end = np.flatnonzero(closed & ~follows) + 1
    hashes = np.empty(len(start), np.uint64)
    source = _LOWER[data] if lower else data
    done = 0
    while done < len(start):
        low = int(start[done])
        last = max(done + 1, int(np.searchsorted(end, low + STEP, "right")))
        part = slice(done, last)
        hashes[part] = _hashes(source[low : int(end[last - 1])], start[part] - low, end[part] - low)
        done = last
    return Words(start, end, hashes, np.searchsorted(start, bounds))


def sequences(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every `length` consecutive words."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    n = len(hashes) - length + 1
    total = np.zeros(n, np.uint64)
    for k in range(length):
        total = total * np.uint64(0xD1342543DE82EF95) + hashes[k : k + n]
    return mixed(total)
