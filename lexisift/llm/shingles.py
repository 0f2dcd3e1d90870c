"""Word shingles of whole texts, as sorted 64-bit hashes, with numpy over an Arrow buffer.

Words are the stretches between ASCII white space of the UTF-8 bytes, A-Z lower-cased. A word's hash is a
polynomial of its bytes' random values modulo 2**64, read off one running sum over the buffer; a shingle's is
a polynomial of its words' mixed hashes. Two different shingles share a hash with probability 2**-64 each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORDS = 5
_U = np.uint64
_random = np.random.default_rng(20240501)
_PLAIN = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_VALUE = _PLAIN.copy()
_VALUE[65:91] = _PLAIN[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _U(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        ones = np.full(size, base, dtype=np.uint64)
        ones[0] = 1
        have = _powers[base] = np.multiply.accumulate(ones)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads all of them."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stretch_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, values: np.ndarray = _PLAIN) -> np.ndarray:
    """A hash of the bytes of each stretch of data, by one running sum over the buffer."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * _power(_BASE, len(data)), out=sums[1:])
    return mix((sums[stops] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts])


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one more at the end)."""
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    inner = bounds[1:-1]
    inner = inner[inner < len(data)]
    begins[inner] = ~space[inner]
    ends = ~space
    ends[:-1] &= space[1:]
    ends[inner[inner > 0] - 1] = ~space[inner[inner > 0] - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return stretch_hashes(data, starts, stops, _VALUE), np.searchsorted(starts, bounds)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted. Fewer than k words: the sequence as one; no word: empty."""
    words, at = word_hashes(data, bounds)
    n = len(words)
    rolled = np.zeros(max(n - k + 1, 0), dtype=np.uint64)
    for i in range(k):
        rolled = rolled * _STEP + words[i : i + len(rolled)]
    rolled = mix(rolled)
    sets = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= k:
            own = np.sort(rolled[a : b - k + 1])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            h = _U(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = h * _STEP + w
            sets.append(mix(np.array([h])))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and bounds of a string column; nulls are empty."""
    column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]] if len(column) else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]
