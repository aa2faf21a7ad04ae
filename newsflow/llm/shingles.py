"""Sets of hashed word shingles of whole texts, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

from newsflow.llm.common import SPACES, mix64

SHINGLE = 5
LONG_WORD = 48

_GAP = np.zeros(256, bool)
_GAP[[ord(c) for c in SPACES]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: bytes | memoryview) -> np.ndarray:
    """64-bit hash of each word, A-Z lower-cased, in order."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    gap = _GAP[data]
    edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    sizes = ends - starts
    out = np.zeros(len(starts), np.uint64)
    short = np.flatnonzero(sizes <= LONG_WORD)
    k = 0
    codes = _BYTE[data]
    while len(short):
        out[short] = (out[short] + codes[starts[short] + k]) * _STEP
        k += 1
        short = short[sizes[short] > k]
    for i in np.flatnonzero(sizes > LONG_WORD):
        word = data[starts[i]:ends[i]].tobytes()
        out[i] = np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64)[0]
    return mix64(out + sizes.astype(np.uint64))


def shingle_set(text: bytes | memoryview) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; of the whole sequence when it is shorter; empty without words."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return words
    width = min(SHINGLE, n)
    out = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        out = mix64((out + words[k:n - width + 1 + k]) * _STEP + np.uint64(width))
    return np.unique(out)


def signature(hashes: np.ndarray, size: int) -> np.ndarray:
    """``size`` MinHash values of 16 bits each; ``hashes`` must not be empty.

    The hashes are well mixed, so an odd multiplier each, modulo 2 ** 32, deals them out anew.
    """
    places = np.arange(size, dtype=np.uint64)
    seeds = (mix64(places + np.uint64(7)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(size, np.uint32(2 ** 32 - 1))
    for at in range(0, len(upper), 4096):
        part = upper[at:at + 4096]
        for i in range(0, size, 16):
            low[i:i + 16] = np.minimum(low[i:i + 16], (part[None, :] * seeds[i:i + 16, None]).min(axis=1))
    return (mix64(low + (places << np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)
