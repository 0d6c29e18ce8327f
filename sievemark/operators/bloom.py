"""Bloom filters: MurmurHash3_x64_128 positions, distributed build, probe, file format.

Positions come from numpy over whole Arrow batches; the bits are OR-ed into 64-bit
words by a grouped ``bit_or``, so what is shuffled and collected is the filter
itself (m / 64 words), not the keys. Probing broadcasts the filter, whose size is
checked first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import streamed_digest

#: The hash's constants, sizing, and the file header.
_C1, _C2 = 0x87C37B91114253D5, 0x4CF5AD432745937F
_F1, _F2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
_ADD1, _ADD2 = 0x52DCE729, 0x38495AB5
K_HASHES, FPR = 10, 0.001
MAGIC, VERSION, HEADER = b"RSBF", 1, 63
SEED = 20260416
#: Bytes of a filter that may be broadcast.
MOST_BYTES = 256 << 20


def optimal_bits(n: int, p: float = FPR) -> int:
    return max(8, math.ceil(-n * math.log(p) / math.log(2) ** 2 / 8) * 8)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _scramble(k: np.ndarray, a: int, r: int, b: int) -> np.ndarray:
    return _rotl(k * np.uint64(a), r) * np.uint64(b)


def _finish(x: np.ndarray) -> np.ndarray:
    for factor in (_F1, _F2):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def murmur3(keys: list[bytes], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the 128-bit hash of every key. Keys are padded with zeros to
    whole 16-byte rows of one matrix; a row takes part in the block rounds as long
    as its key has whole blocks, and its rest is the tail."""
    n = len(keys)
    lengths = np.fromiter(map(len, keys), np.int64, n)
    width = int(lengths.max(initial=0)) // 16 * 16 + 16
    data = np.zeros((n, width), np.uint8)
    for i, key in enumerate(keys):
        data[i, : len(key)] = np.frombuffer(key, np.uint8)
    words = data.view("<u8").astype(np.uint64).reshape(n, width // 8)
    h1, h2 = np.full(n, seed & 0xFFFFFFFF, np.uint64), np.full(n, seed & 0xFFFFFFFF, np.uint64)
    whole = lengths // 16
    for b in range(int(whole.max(initial=0))):
        on = whole > b
        x, y = h1[on] ^ _scramble(words[on, 2 * b], _C1, 31, _C2), h2[on]
        x = (_rotl(x, 27) + y) * np.uint64(5) + np.uint64(_ADD1)
        y = y ^ _scramble(words[on, 2 * b + 1], _C2, 33, _C1)
        y = (_rotl(y, 31) + x) * np.uint64(5) + np.uint64(_ADD2)
        h1[on], h2[on] = x, y
    rows = np.arange(n)
    # Zero words scramble to zero, so a missing tail changes nothing.
    h2 ^= _scramble(words[rows, 2 * whole + 1], _C2, 33, _C1)
    h1 ^= _scramble(words[rows, 2 * whole], _C1, 31, _C2)
    h1 ^= lengths.astype(np.uint64)
    h2 ^= lengths.astype(np.uint64)
    h1 = h1 + h2
    h2 = h2 + h1
    h1, h2 = _finish(h1), _finish(h2)
    h1 = h1 + h2
    return h1, h2 + h1


def positions(keys: list[bytes], m: int, k: int, seed: int) -> np.ndarray:
    """(h1 + i * h2 mod 2**64) mod m for i in 0..k-1, a row for each key."""
    h1, h2 = murmur3(keys, seed)
    return ((h1[:, None] + np.arange(k, dtype=np.uint64) * h2[:, None]) % np.uint64(m)).astype(np.int64)


@dataclass
class Bloom:
    m: int
    k: int
    seed: int
    bits: bytes  # position p is bit p % 8 of byte p // 8
    rows: int

    def contains(self, keys: list[bytes]) -> np.ndarray:
        at = positions(keys, self.m, self.k, self.seed)
        raw = np.frombuffer(self.bits, np.uint8)
        return ((raw[at // 8] >> (at % 8).astype(np.uint8)) & 1).all(axis=1)


def words(keys: DataFrame, key: str, m: int, k: int = K_HASHES, seed: int = SEED) -> DataFrame:
    """(word_idx, word): the filter of distinct keys, as 64-bit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [x.encode() for x in batch.column(0).to_pylist() if x is not None]
            yield pa.RecordBatch.from_arrays([pa.array(positions(got, m, k, seed).ravel() if got else [], pa.int64())], names=["position"])

    found = keys.select(F.col(key).cast("string")).mapInArrow(run, "position long")
    return or_words(found, "position")


def or_words(positions: DataFrame, column: str) -> DataFrame:
    """Bits at the given positions, OR-ed into 64-bit words."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col(column) % 64).cast("int"))
    return positions.groupBy(F.floor(F.col(column) / 64).alias("word_idx")).agg(F.bit_or(bit).alias("word"))


def build(keys: DataFrame, key: str, k: int = K_HASHES, fpr: float = FPR, seed: int = SEED) -> Bloom:
    """The filter of a column of distinct keys."""
    n = keys.count()
    m = optimal_bits(n, fpr)
    if m // 8 > MOST_BYTES:
        raise ValueError(f"a filter of {m // 8} bytes is more than {MOST_BYTES}: build one a partition")
    raw = np.zeros(-(-m // 64), np.uint64)
    found = words(keys, key, m, k, seed).toArrow()
    raw[found["word_idx"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return Bloom(m, k, seed, raw.astype("<u8").tobytes()[: m // 8], n)


def probe(rows: DataFrame, key: str, bloom: Bloom) -> DataFrame:
    """``rows`` with ``hit``; a null key is no member."""
    shared = rows.sparkSession.sparkContext.broadcast(bloom)
    kept = [c for c in rows.columns if c != "hit"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept) + ", hit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(kept.index(key)).to_pylist()
            hit = shared.value.contains([(x or "").encode() for x in keys]) & np.array([x is not None for x in keys], bool) if keys else np.empty(0, bool)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], names=[*kept, "hit"])

    return rows.select(*(F.col(f"`{c}`") for c in kept)).mapInArrow(run, schema)


def pack(bloom: Bloom, source_hash: bytes) -> bytes:
    """The file: header (magic, version, k, m, seed, rows, source digest) and bits."""
    if len(source_hash) != 32 or not 1 <= bloom.k <= 255 or len(bloom.bits) != -(-bloom.m // 8):
        raise ValueError("a filter that does not fit the format")
    numbers = b"".join(x.to_bytes(8, "little") for x in (bloom.m, bloom.seed, bloom.rows))
    return MAGIC + VERSION.to_bytes(2, "little") + bytes([bloom.k]) + numbers + source_hash + bloom.bits


def unpack(data: bytes) -> tuple[Bloom, bytes]:
    """(filter, source digest) of a file; anything amiss is refused."""
    if len(data) < HEADER or data[:4] != MAGIC or int.from_bytes(data[4:6], "little") != VERSION:
        raise ValueError("not a filter file of this version")
    m, seed, rows = (int.from_bytes(data[i : i + 8], "little") for i in (7, 15, 23))
    if len(data) != HEADER + -(-m // 8):
        raise ValueError("the bits do not match the header")
    return Bloom(m, data[6], seed, data[HEADER:], rows), data[31:63]


def digest(keys: DataFrame, key: str) -> bytes:
    """SHA-256 of the sorted keys, taken range after range."""
    return bytes.fromhex(streamed_digest(keys, key)[0])
