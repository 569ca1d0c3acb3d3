"""Words and rolling hashes of a batch of texts as numpy arrays, without a Python object per word.

A batch is one run of UTF-8 bytes with document offsets. Long batches are cut into pieces of whole
documents, so memory follows the piece size or the longest document, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the bytes of ``column`` and the document offsets; null is empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        index = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(index), "").cast(pa.large_string())
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
            texts.offset : texts.offset + len(texts) + 1
        ]
        payload = texts.buffers()[2]
        data = np.frombuffer(payload, dtype=np.uint8) if payload else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1
            last = min(max(last, first + 1), len(texts))
            part = data[bounds[first] : bounds[last]]
            yield batch.slice(first, last - first), part, bounds[first : last + 1] - bounds[first]
            first = last


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.full(size, base, dtype=np.uint64)
        up[0] = 1
        down = np.full(size, inverse, dtype=np.uint64)
        down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(size: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    rounded = 1 << max(10, int(size).bit_length())
    up, down = _powers(base, rounded)
    return up[:size], down[:size]


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        z = values + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class Prefix:
    """Sums of values times a power of the base; spans of equal content have equal hashes."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        up, self.down = powers(len(values) + 1, base)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(values * up[: len(values)], dtype=np.uint64, out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
            return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of words between ASCII white space, and the first word of each document."""
    if not len(data):
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing, np.zeros(len(offsets), dtype=np.int64)
    inside = ~_IS_SPACE[data]
    before = np.empty(len(data) + 1, dtype=bool)
    before[0] = False
    before[1:] = inside
    after = np.empty(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[-1] = False
    before[offsets[:-1]] = False  # a document's first byte has nothing before it
    starts = np.flatnonzero(inside & ~before[:-1])
    after[offsets[1:]] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Prefix(data.astype(np.uint64) + np.uint64(1)).spans(starts, ends)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling; shorter than the input by width - 1."""
    low, have = values, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = width - have
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def within(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """All starts of spans of ``length`` items inside one document, and the document of each."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    total = int(counts.sum())
    shift = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total) + shift, owner


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
