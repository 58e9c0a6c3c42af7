"""Words of many texts at once, as numpy arrays.

A word is a run of ASCII letters, digits and characters beyond ASCII; A-Z are
lower-cased. All bytes of a character beyond ASCII are 0x80 or more, so this
works on UTF-8 bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash

from .common import mix64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
#: Longer words are hashed one by one.
LONG = 64


def words_of(texts: list[bytes], word_bytes: np.ndarray = _WORD, lower: bool = True):
    """Joined texts, and start, end and text number of each word."""
    buf = np.frombuffer(b" ".join(texts) + b" " * 16, dtype=np.uint8)
    if lower:
        buf = _LOWER[buf]
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes + 1) - 1
    is_word = word_bytes[buf].view(np.int8)
    edge = np.diff(is_word, prepend=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return buf, starts, stops, np.searchsorted(ends, starts, side="right")


def word_hashes(buf: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes; ``buf`` ends in spare bytes."""
    size = stops - starts
    h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    grams = np.ndarray((max(len(buf) - 7, 0),), dtype="<u8", buffer=np.ascontiguousarray(buf), strides=(1,))
    most = int(size.max()) if len(size) else 0
    for at in range(0, min(most, LONG), 8):
        on = np.flatnonzero((size > at) & (size <= LONG)) if at or most > LONG else slice(None)
        left = np.minimum(size[on] - at, 8).astype(np.uint64)
        g = grams[starts[on] + at]
        g = g & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left * np.uint64(8)))
        h[on] = mix64(h[on] ^ g)
    for i in np.flatnonzero(size > LONG):
        h[i] = xxhash.xxh64_intdigest(buf[starts[i] : stops[i]].tobytes())
    return h


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive words (of the whole sequence: those that
    reach into the next text are included)."""
    n = max(len(h) - k + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[j : j + n]
        out ^= out >> np.uint64(32)
    return mix64(out)


def slices(texts: list[bytes], most: int):
    """Index ranges of consecutive texts with about ``most`` bytes together."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)
