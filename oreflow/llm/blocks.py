"""Texts as blocks of word numbers, for statistics over whole corpora.

A block is a few megabytes of consecutive texts of one group (a language, say), with a dictionary of its own: the
distinct words, the commonest first, and the texts as numbers into it. Each word goes through a shuffle once a
block, not once an occurrence, and what becomes known about words over the whole corpus comes back the same way, so
a task only holds the part of the corpus's dictionary that its block needs. A block of exactly one text may be
longer than the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.words import Words, mix, slices

BLOCK_BYTES = 8 << 20
#: Bytes of texts that wait in a task until their groups fill a block.
WAITING_BYTES = 2 * BLOCK_BYTES
#: Bytes of texts that are cut to words at once.
PART_BYTES = 1 << 19
BREAK = -1

_END_HASH = mix(np.array([1], np.uint64))[0]


def bytes_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


class Waiting:
    """Words of one group that aren't written yet: each slice's own dictionary, and its texts as numbers into that."""

    def __init__(self) -> None:
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, w: Words, breaks: np.ndarray | None, end: bool, rows: pa.RecordBatch) -> None:
        hashes, length = w.hashes(), (w.end - w.start).astype(np.int32)
        start, count = w.start.astype(np.int32), w.counts()
        cut = None
        if breaks is not None:
            before = np.zeros(len(w.data) + 1, np.int32)
            np.cumsum(breaks[w.data], out=before[1:])
            cut = np.zeros(len(start), bool)  # a word begins a piece
            cut[1:] = before[start[1:]] != before[start[:-1]]
            cut[w.first[:-1][count > 0]] = True
        if end:
            at = w.first[1:]
            hashes, length = np.insert(hashes, at, _END_HASH), np.insert(length, at, 0)
            start, count = np.insert(start, at, 0), count + 1
        known, first, numbers, counts = distinct(hashes)
        start, length = start[first], length[first]
        if cut is not None:
            numbers = np.insert(numbers, np.flatnonzero(cut), BREAK)
        self.parts.append((known, byte_ranges(w.data, start, length), length, counts, numbers, count, rows))
        self.size += len(w.data) + 1

    def block(self) -> dict:
        """Dictionary, numbers and rows of everything that waits; nothing waits afterwards."""
        known, length, counts = (np.concatenate([p[k] for p in self.parts]) for k in (0, 2, 3))
        _, first, merged, _ = distinct(known)
        counts = np.bincount(merged, counts, len(first)).astype(np.int64)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        own = np.split(rank[merged], np.cumsum([len(p[0]) for p in self.parts])[:-1])
        first, data = first[order], np.concatenate([p[1] for p in self.parts])
        start = np.cumsum(length, dtype=np.int64) - length
        out = {
            "words": strings(data, start[first], length[first]),
            "counts": counts[order],
            "numbers": np.concatenate([np.append(new, np.int32(BREAK))[p[4]] for new, p in zip(own, self.parts)]),
            "rows": pa.concat_batches([p[6] for p in self.parts]),
            "lengths": np.concatenate([p[5] for p in self.parts]),
        }
        self.parts, self.size = [], 0
        return out


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, where each is first, the number of each entry's, and how often each is there."""
    order = np.argsort(hashes, kind="stable").astype(np.int32)
    ordered = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    begin = np.flatnonzero(new)
    numbers = np.empty(len(hashes), np.int32)
    numbers[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[begin], order[begin], numbers, np.diff(np.append(begin, len(hashes)))


def byte_ranges(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of some ranges in a row."""
    offsets = np.concatenate([[0], np.cumsum(length)])
    return data[np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)]


def strings(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """Byte ranges of UTF-8 data as an array of strings."""
    offsets = np.concatenate([[0], np.cumsum(length)])
    found = pa.py_buffer(byte_ranges(data, start, length))
    return pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(offsets), found).cast(pa.string())


def listed(values: pa.Array | np.ndarray) -> pa.ListArray:
    """All values as the one list of a row."""
    return pa.ListArray.from_arrays([0, len(values)], pa.array(values))


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed, behind their count."""
    data = numbers.astype("<i4").tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def raw(numbers: np.ndarray) -> pa.Array:
    """Packed numbers as the one binary value of a row."""
    return pa.array([packed(numbers)], pa.binary())


def numbers_of(value: pa.Scalar) -> np.ndarray:
    data = value.as_buffer()
    size = int.from_bytes(data[:8].to_pybytes(), "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd"), "<i4") if size else np.zeros(0, "<i4")


def encode(
    texts: DataFrame, schema: str, finish: Callable[[dict], list[pa.Array]], apart: bytes, breaks: bytes = b"",
    end: bool = False, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Blocks of a table (group string, text string, ...); words are lower-cased (A to Z).

    Bytes of ``apart`` and ``breaks`` stand between words; with ``breaks``, ``BREAK`` precedes each piece without
    one. With ``end`` every text ends with the empty word. ``finish`` gets a block (dictionary, numbers, the columns
    after the text of its rows, and their lengths in words) and returns what follows ``grp`` and ``block`` in its row,
    as arrays of one value.
    """
    marks, cuts = bytes_set(apart + breaks), bytes_set(breaks) if breaks else None
    names = ["grp", "block", *(c.strip().split(" ")[0] for c in schema.split(", "))]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, Waiting] = {}
        number = TaskContext.get().partitionId() << 32

        def write(group: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            done = finish(waiting[group].block())
            return pa.RecordBatch.from_arrays([pa.array([group]), pa.array([number], pa.int64()), *done], names=names)

        for part in slices(batches, "text", PART_BYTES):
            groups = part.column(0).dictionary_encode()
            for k, group in enumerate(groups.dictionary.to_pylist()):
                own = part.filter(pa.array(groups.indices.to_numpy() == k)) if len(groups.dictionary) > 1 else part
                words, others = Words(own.column(1), lower=True, apart=marks), own.select(range(2, own.num_columns))
                waiting.setdefault(group, Waiting()).add(words, cuts, end, others)
                if waiting[group].size >= block_bytes:
                    yield write(group)
            while sum(w.size for w in waiting.values()) >= WAITING_BYTES:
                yield write(max(waiting, key=lambda g: waiting[g].size))
        for group in waiting:
            if waiting[group].size:
                yield write(group)

    return texts.mapInArrow(rows, f"grp string, block long, {schema}")


def dictionary(blocks: DataFrame, *counts: str) -> DataFrame:
    """(grp, block, number, word, counts ...): one row for each word of a block."""
    zipped = F.arrays_zip("words", *counts)
    rows = blocks.select("grp", "block", F.posexplode(zipped).alias("number", "w"))
    return rows.select("grp", "block", "number", F.col("w.words").alias("word"), *(F.col(f"w.{c}").alias(c) for c in counts))
