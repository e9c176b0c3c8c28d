"""Words of many texts at once, as numpy arrays.

A word is a run of bytes that are not ASCII white space.  Its key is a
polynomial hash over a table of random 64-bit numbers, one for each byte value,
taken as a difference of prefix sums (multiplication by odd numbers can be
undone modulo 2^64) and mixed with the word's length, so the keys of all words
of a block come from a few vector operations and are the same on every worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20  # texts worked on at a time (one longer text makes a block of its own)
ROWS_AT_ONCE = 512      # rows of an Arrow batch whose texts are copied at a time

_rng = np.random.default_rng(0x5EED)
_TABLE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_CLASS = np.full(256, 3, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 4
_BASE = 0x9E3779B97F4A7C15
_UNDO = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n, modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = max(n + 1, BLOCK_BYTES + 4096)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 8 * BLOCK_BYTES:  # those of one very long text are not kept
            _powers[base] = have
    return have[:n + 1]


class PrefixHash:
    """Hashes of any substrings of a byte array."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data] * powers(_BASE, len(data))[:len(data)], out=self.sums[1:])
        self.undo = powers(_UNDO, len(data))

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.undo[start]

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(np.uint64))


class Words:
    """``doc``, ``start`` and ``end`` of every word of ``texts``, in order;
    starts and ends are places in the joined bytes."""

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        space = _SPACE[joined]
        change = np.flatnonzero(np.diff(space, prepend=True))
        self.start, self.end = change[0::2], change[1::2]
        if len(self.end) < len(self.start):
            self.end = np.append(self.end, len(joined))
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.offset = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.doc = np.searchsorted(self.offset, self.start, side="right") - 1
        self.data = joined

    @cached_property
    def _hash(self) -> PrefixHash:
        return PrefixHash(_LOWER[self.data])

    def hash_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Keys of substrings, A-Z taken as a-z."""
        return self._hash(start, end)

    def keys(self) -> np.ndarray:
        return self._hash(self.start, self.end)

    def classes(self) -> np.ndarray:
        """Per word, its bytes that are A-Z, a-z, 0-9, other ASCII, not ASCII."""
        sums = np.zeros(len(self.data) + 1, dtype=np.int32 if len(self.data) < 1 << 31 else np.int64)
        kind = _CLASS[self.data]
        out = np.empty((len(self.start), 5), dtype=np.int64)
        for k in range(5):
            np.cumsum(kind == k, out=sums[1:])
            out[:, k] = sums[self.end] - sums[self.start]
        return out


def blocks_of_texts(batches: Iterator[pa.RecordBatch], columns: list[str], text: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list[bytes], list[pa.Array]]]:
    """Cut Arrow batches into runs of rows with about ``block_bytes`` of text:
    the texts as UTF-8 (null as empty) and the columns named."""
    for batch in (whole.slice(at, ROWS_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
        texts = batch.column(text).cast(pa.large_binary()).to_pylist()
        first, held = 0, 0
        for i, t in enumerate(texts):
            if held and held + len(t or b"") > block_bytes:
                yield [x or b"" for x in texts[first:i]], [batch.column(c).slice(first, i - first) for c in columns]
                first, held = i, 0
            held += len(t or b"") + 1
        if first < len(texts):
            yield [x or b"" for x in texts[first:]], [batch.column(c).slice(first) for c in columns]
