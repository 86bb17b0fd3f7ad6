"""Words of many texts at once, as numpy arrays over the Arrow buffers of a batch.

Words are maximal runs of bytes other than the six ASCII white-space characters, which are single bytes in
UTF-8, so byte runs and code-point runs are the same words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SPACE = "\\x20\\x09-\\x0D"
SLICE_BYTES = 2 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, min(2 * n, SLICE_BYTES + 1))
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of values[start:end] for each pair, independent of its place; one pass over values."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


class Words:
    """The words of a list of texts: byte ranges in ``data``; text i owns words ``first[i]`` to ``first[i + 1]``.

    ``apart`` marks the bytes between words; they must be ASCII.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, apart: np.ndarray = _WHITE):
        data, offsets = text_bytes(texts)
        self.data = _LOWER[data] if lower else data
        inside = ~apart[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        after = np.zeros(len(data) + 1, bool)
        after[:-1] = inside
        before[offsets] = False  # words don't go on across texts
        after[offsets] = False
        self.start = np.flatnonzero(inside & ~before[:-1])
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        self.offsets = offsets
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        return mix(rolling(self.data.astype(np.uint64) + np.uint64(1), self.start, self.end))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of each run of ``width`` words of one text, in order, and where each text's runs begin."""
    count = np.maximum(np.diff(first) - width + 1, 0)
    begin = np.concatenate([[0], np.cumsum(count)])
    start = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], count)
    return mix(rolling(hashes, start, start + width)), begin


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that arrays over the bytes of one stay small; a longer text is a slice of its own."""
    for batch in batches:
        column = batch.column(text)
        at = 0
        _, offsets = text_bytes(column)
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
