"""Hashes of a text's words, and of its word shingles, in numpy.

A word is a run of bytes other than ASCII white space; A-Z count as a-z. Words are
hashed all at once: with a random number for each byte value and powers of an odd
base, a word's hash is a difference of prefix sums modulo 2**64, scaled back to its
first byte.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Bytes hashed at once; a longer word makes a longer slice.
SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    table[65:91] = table[97:123]
    table[_SPACE] = 0
    return table


@lru_cache(2)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _slice_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    n = SLICE if len(data) <= SLICE else len(data)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * _powers(n, _BASE)[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _powers(n, _INVERSE)[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), starts


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word."""
    parts, at = [], 0
    whole = np.frombuffer(data, np.uint8)
    while at < len(whole):
        end = min(at + SLICE, len(whole))
        while end < len(whole) and not _SPACE[whole[end]]:
            found = np.flatnonzero(_SPACE[whole[end : end + SLICE]])
            end = end + int(found[0]) if len(found) else min(end + SLICE, len(whole))
        hashes, starts = _slice_hashes(whole[at:end])
        parts.append((hashes, starts + at))
        at = end
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words; of fewer words, of the whole sequence."""
    size = min(n, len(words))
    if not size:
        return np.empty(0, np.uint64)
    out = np.full(len(words) - size + 1, np.uint64(size), np.uint64)
    for k in range(size):
        out = mix(out + words[k : len(words) - size + 1 + k])
    return out


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    out, i = [], 0
    while i < len(data):
        j, total = i, 0
        while j < len(data) and (j == i or total + len(data[j]) < SLICE):
            total += len(data[j]) + 1
            j += 1
        hashes, starts = word_hashes(b"\n".join(data[i:j]))
        ends = np.cumsum([len(d) + 1 for d in data[i:j]])
        for part in np.split(hashes, np.searchsorted(starts, ends[:-1])):
            out.append(np.unique(shingles(part, n)))
        i = j
    return out
