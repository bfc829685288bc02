"""Columnar word splitting and hashing over Arrow string columns (numpy, no per-word Python).

Every word operator of this package reads text the same way: a Python worker receives
Arrow batches, cuts them into blocks of a few megabytes (a single longer text makes a
block of its own) and works on the UTF-8 bytes of a block at once. A null text has no
words. Word separators are ASCII bytes only, so cutting bytes never cuts a code point.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BLOCK_BYTES = 3 << 20
CHUNK_BYTES = 1 << 18   # bytes whose prefix sums are held at once (a longer span is a chunk of its own)
_ODD = 0x9E3779B97F4A7C15
_INV = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_ODD))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(1 << (n - 1).bit_length(), CHUNK_BYTES + 1)
        for name, base in (("up", _ODD), ("down", _INV)):
            steps = np.full(size, base, dtype=U64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=U64)
    return _powers["up"], _powers["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``data[start:end]`` for many spans: polynomial prefix sums.

    Hashes do not depend on where a span lies, so spans in order are hashed a chunk of bytes
    at a time: the arrays of eight bytes a byte stay small, whatever the block's size."""
    if len(data) > CHUNK_BYTES and (np.diff(starts) >= 0).all() and (np.diff(ends) >= 0).all():
        out = np.empty(len(starts), dtype=U64)
        lo = 0
        while lo < len(starts):
            at = int(starts[lo])
            hi = max(int(np.searchsorted(ends, at + CHUNK_BYTES, side="right")), lo + 1)
            to = int(ends[hi - 1])
            out[lo:hi] = _span_hashes(data[at:to], starts[lo:hi] - at, ends[lo:hi] - at)
            lo = hi
        return out
    return _span_hashes(data, starts, ends)


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * U64(_ODD))


@dataclass
class Block:
    """Rows ``lo:hi`` of a batch: their bytes and where each row's text begins and ends."""
    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return self.hi - self.lo


@dataclass
class Words:
    """Words of a block in order: byte range, row inside the block, hash; ``bounds[r]:bounds[r+1]``
    are the words of row r."""
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES):
    """Cut a string column into blocks of about ``limit`` bytes. Workers live on from step to step:
    what Arrow no longer needs goes back to the system after every column."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    n = len(texts)
    _, at, raw = texts.buffers()
    if not n:
        return
    offsets = np.frombuffer(at, dtype=kind)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Block(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi
    pa.default_memory_pool().release_unused()


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry truth table of the byte ranges (inclusive)."""
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


# words [^\x20\x09-\x0D]+
PLAIN_WORD = ~byte_class((0x20, 0x20), (0x09, 0x0D))
# words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after A-Z are lower-cased)
ALNUM_WORD = ~byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that stay inside one row: starts, ends and row bounds."""
    before = np.empty(len(inside), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < len(inside))]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(inside), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cut - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def split(block: Block, word: np.ndarray, lower: bool = False) -> Words:
    """The words of a block; with ``lower``, A-Z count as a-z."""
    data = LOWER[block.data] if lower else block.data
    starts, ends, bounds = runs(word[data], block.offsets)
    return Words(starts, ends, bounds, span_hashes(data, starts, ends))


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k`` consecutive words inside a row, and each row's bounds; a row with
    fewer words, but some, gives its whole sequence as one (as a hash that depends on its length)."""
    counts = words.counts
    sums = np.zeros(len(words.hashes) + 1, dtype=U64)
    up, down = _power_tables(len(words.hashes) + 1)
    np.cumsum(words.hashes * up[:len(words.hashes)], out=sums[1:])
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    bounds = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(n, out=bounds[1:])
    first = np.arange(bounds[-1]) + np.repeat(words.bounds[:-1] - bounds[:-1], n)
    size = np.repeat(np.minimum(counts, k), n)
    return mix((sums[first + size] - sums[first]) * down[first] + size.astype(U64)), bounds
