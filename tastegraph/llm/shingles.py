"""Hashes of word shingles of whole texts, computed on the bytes of an Arrow string array."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20  # bytes hashed at a time
LONGEST = 4096  # bytes of a word hashed with others; longer words are hashed alone

_rng = np.random.default_rng(7)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[0x41:0x5B] = _VALUE[0x61:0x7B]  # A-Z count as a-z
_P = int(_rng.integers(1 << 62, 1 << 63)) | 1
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.full(WINDOW + LONGEST + 1, _P, np.uint64))
    _INVERSE = np.cumprod(np.full(WINDOW + LONGEST + 1, pow(_P, -1, 1 << 64), np.uint64))
    _PLACES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 256))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string array; null rows are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def span_hashes(data: np.ndarray, at: np.ndarray, stop: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of the byte spans [at, stop) in ascending order, A-Z counting as a-z; each seed gives others."""
    value = _VALUE if not seed else mix(_VALUE + np.uint64(seed)) | np.uint64(1)
    out = np.zeros(len(at), np.uint64)
    short = np.flatnonzero(stop - at <= LONGEST)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(short):
            lo = at[short[i]]
            j = max(i + 1, int(np.searchsorted(at[short], lo + WINDOW)))
            a, b = at[short[i:j]] - lo, stop[short[i:j]] - lo
            v = value[data[lo:lo + b[-1]]]
            sums = np.zeros(len(v) + 1, np.uint64)
            np.cumsum(v * _POWER[:len(v)], out=sums[1:])
            out[short[i:j]] = mix((sums[b] - sums[a]) * _INVERSE[a] + (b - a).astype(np.uint64))
            i = j
    for i in np.flatnonzero(stop - at > LONGEST).tolist():
        word = data[at[i]:stop[i]].tobytes().translate(_LOWER)
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
    return out


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows in order, A-Z counting as a-z, and the number of words of each row."""
    data, offsets = buffers(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    blank = _BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = ~blank
    start[1:] &= blank[:-1] | first[1:-1]
    end = ~blank
    end[:-1] &= blank[1:] | first[1:-1]
    at, stop = np.flatnonzero(start), np.flatnonzero(end) + 1
    out = span_hashes(data, at, stop)
    row = np.searchsorted(offsets, at, "right") - 1
    return out, np.bincount(row, minlength=len(texts))


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each row its distinct shingle hashes, sorted.

    A row with fewer words than a shingle has one shingle, all its words; a row
    without words has none.
    """
    w, counts = word_hashes(texts)
    with np.errstate(over="ignore"):
        n = len(w) - words + 1
        rolled = np.zeros(max(0, n), np.uint64)
        for k in range(words if n > 0 else 0):
            rolled += w[k:k + n] * _PLACES[k]
        rolled = mix(rolled)
        at = 0
        for c in counts.tolist():
            if c >= words:
                yield np.unique(rolled[at:at + c - words + 1])
            elif c:
                yield mix(np.array([(w[at:at + c] * _PLACES[:c]).sum() + np.uint64(c)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
            at += c
