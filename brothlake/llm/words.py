"""Vectorised words and word hashes over Arrow string batches.

A word is a run of bytes other than space and the controls 0x09-0x0D, the byte
form of ``[^\\x20\\x09-\\x0D]+``. Hashes are 64-bit, the same in every process,
and work on the UTF-8 buffers directly, so no Python object is made per word.
A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 18

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C17 | 3
_GRAM = 0xD1342543DE82EF97 | 3
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Block(NamedTuple):
    """The words of a run of whole documents."""

    first: int  # row of the first document in the batch
    data: np.ndarray  # bytes of the texts
    bounds: np.ndarray  # word index at which each document starts, and the end
    starts: np.ndarray  # byte at which each word starts
    ends: np.ndarray
    hashes: np.ndarray  # uint64 for each word
    offsets: np.ndarray  # byte at which each document starts, and the end


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i below n at least."""
    got = _powers.get(base)
    if got is None or len(got[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            got = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (base, pow(base, -1, 1 << 64)))
        if size <= 1 << 20:
            _powers[base] = got
    return got


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array, nulls as empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def blocks(texts: pa.Array, lower: bool = False, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Runs of whole documents with the hashes of their words."""
    data, offsets = buffers(texts)
    n, row = len(offsets) - 1, 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + block_bytes, "right")) - 1
        stop = min(max(stop, row + 1), n)
        part = data[offsets[row] : offsets[stop]]
        if lower:
            part = _LOWER[part]
        yield _block(row, part, offsets[row : stop + 1] - offsets[row])
        row = stop


def _block(first: int, data: np.ndarray, at: np.ndarray) -> Block:
    inside = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Block(first, data, np.searchsorted(starts, at), starts, ends, span_hashes(data, starts, ends), at)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for the bytes of each span; spans are in order and worked on in runs of a few megabytes of data, so a very long text takes no more room than its words."""
    if len(data) > 4 * BLOCK_BYTES and len(starts) > 1:
        out, at = np.empty(len(starts), np.uint64), 0
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES, "right")))
            first, last = starts[at], ends[stop - 1]
            out[at:stop] = span_hashes(data[first:last], starts[at:stop] - first, ends[at:stop] - first)
            at = stop
        return out
    up, down = powers(_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for the k words from each word on; the last k-1 places are missing."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    run = max(1 << 20, k)
    if len(hashes) > 2 * run:
        return np.concatenate([grams(hashes[at : at + run + k - 1], k) for at in range(0, len(hashes) - k + 1, run)])
    up, down = powers(_GRAM, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
        return mixed((sums[k:] - sums[:-k]) * down[: len(hashes) - k + 1])


def fitting(bounds: np.ndarray, k: int) -> np.ndarray:
    """Whether the k words from each place of grams() on are of one document."""
    n = int(bounds[-1])
    if n < k:
        return np.zeros(0, bool)
    fits = np.zeros(n + 1, np.int64)
    np.add.at(fits, bounds[:-1], 1)
    long = np.maximum(bounds[1:] - k + 1, bounds[:-1])
    np.add.at(fits, long, -1)
    return np.cumsum(fits)[: n - k + 1] > 0


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i:i+w] for each i."""
    done, out = 1, x
    while done < w:
        step = min(done, w - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out
