"""Removal of passages that occur more than once in a corpus.

A window is a fixed number of consecutive words of one document; its Rabin-Karp hash comes from prefix sums over
the word hashes. A window is removed when its words also start anywhere else. Windows are counted by Spark, but
only those that can be repeated go through the shuffle. For that, every window has an anchor: of the word n-grams
inside it, the one with the smallest hash (winnowing). Equal windows have equal anchors, so a window whose anchor
occurs only once in the corpus cannot be repeated. Neighbouring windows mostly share an anchor, so there are far
fewer anchors than windows; they are counted first. Then the runs of windows that share a repeated anchor are
counted as one, and window by window those whose run is not repeated as a whole. Counts combine before the shuffle. Copies of a whole text are found by the text's hash, and only one of them is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import discard, stored
from oreflow.llm.words import Words, mix, rolling, signed, slices, windows

WIDTH = 35
GRAM = 8


def smallest_grams(hashes: np.ndarray, start: np.ndarray, width: int, gram: int) -> np.ndarray:
    """The smallest n-gram hash inside each window of words that begins at one of ``start``."""
    inside = width - gram + 1
    grams, _ = windows(hashes, np.array([0, len(hashes)]), gram)  # n-grams across texts are in no window
    padded = np.full(-(-len(grams) // inside) * inside, np.iinfo(np.uint64).max)
    padded[: len(grams)] = grams
    rows = padded.reshape(-1, inside)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[start], forward[start + inside - 1])


class Windows:
    """All windows of some texts: hash, anchor, number within the text; text i has ``begin[i]`` to ``begin[i+1]``."""

    def __init__(self, texts: pa.Array, width: int, gram: int):
        words = Words(texts)
        hashes = words.hashes()
        self.hash, self.begin = windows(hashes, words.first, width)
        count = np.diff(self.begin)
        self.text = np.repeat(np.arange(len(count)), count)
        self.number = np.arange(len(self.hash)) - self.begin[self.text]
        self.anchor = np.zeros(0, np.uint64)
        if len(self.hash):
            self.anchor = smallest_grams(hashes, self.number + words.first[self.text], width, gram)


def unseen(part: pa.RecordBatch, key: int, seen: set) -> pa.RecordBatch:
    """The rows of a batch whose key has not been met yet, one of each."""
    rows = []
    for k, value in enumerate(part.column(key).to_pylist()):
        if value not in seen:
            seen.add(value)
            rows.append(k)
    return part.take(pa.array(rows, pa.int32()))


def repeated_in(values: np.ndarray) -> np.ndarray:
    """Whether each value stands more than once in an array."""
    order = np.argsort(values)
    same = values[order[1:]] == values[order[:-1]]
    out = np.zeros(len(values), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def anchors(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """(key, anchor, own) of the texts (key, text): own if one of its windows is known to be repeated."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches, "text"):
            part = unseen(part, 0, seen)
            w = Windows(part.column(1), width, gram)
            if len(w.hash):
                new = np.ones(len(w.hash), bool)
                new[1:] = (w.anchor[1:] != w.anchor[:-1]) | (w.text[1:] != w.text[:-1])
                at = np.flatnonzero(new)
                own = np.logical_or.reduceat(repeated_in(w.hash), at)
                columns = [part.column(0).take(pa.array(w.text[at])), pa.array(signed(w.anchor[at])), pa.array(own)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "anchor", "own"])

    return texts.mapInArrow(rows, "key long, anchor long, own boolean")


def runs(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """(anchor, run, key, first, hashes) of texts (key, text, anchors): windows in a row that have one of the anchors.

    ``run`` names the windows' words, ``first`` is the number of the first window, ``hashes`` has one per window.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            w = Windows(part.column(1), width, gram)
            keep = np.zeros(len(w.hash), bool)
            for k, own in enumerate(part.column(2)):
                a, b = w.begin[k], w.begin[k + 1]
                keep[a:b] = np.isin(w.anchor[a:b], own.values.to_numpy().view(np.uint64))
            at = np.flatnonzero(keep)
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) > 1) | (w.anchor[at][1:] != w.anchor[at][:-1]) | (w.text[at][1:] != w.text[at][:-1])
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(at))
            head = at[begin] if len(at) else at
            name = mix(rolling(w.hash[at], begin, end if len(at) else begin) + (end[: len(begin)] - begin).astype(np.uint64))
            lists = pa.ListArray.from_arrays(np.append(begin, len(at)).astype(np.int32), signed(w.hash[at]))
            columns = [pa.array(signed(w.anchor[head])), pa.array(signed(name))]
            columns += [part.column(0).take(pa.array(w.text[head])), pa.array(w.number[head], pa.int32()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "run", "key", "first", "hashes"])

    return texts.mapInArrow(rows, "anchor long, run long, key long, first int, hashes array<long>")


def merged(covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal intervals (first, end) of words from overlapping or touching ones."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(covered):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM
) -> DataFrame:
    """(id, n_words, removed, kept) per row: the removal intervals in words, and the kept words with one space between.

    A word goes if it is in a window of ``width`` words that also starts anywhere else, in the same text or in
    that of another row; windows are judged on the input. Words are compared by 64-bit hashes.

    Defined cases. A null text has no words; texts shorter than a window are kept whole. Rows are separate
    documents even if they are equal: a repeated row counts as a copy. An id may be null. An empty table gives an
    empty result. Columns other than ``id`` and ``text`` are not read.
    """
    kind = docs.schema[id].dataType.simpleString()
    keyed = docs.select(F.col(id), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = keyed.withColumn("key", F.xxhash64("text", F.octet_length("text")))
    texts = keyed.select("key", "text")
    copied = keyed.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1")

    found = stored(anchors(texts, width, gram), "anchors")
    again = found.groupBy("anchor").agg(F.min("key").alias("x"), F.max("key").alias("y"), F.max("own").alias("own"))
    again = again.where("x <> y or own").select("anchor")
    again = found.join(again, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
    met = stored(runs(texts.join(again, "key").dropDuplicates(["key"]), width, gram), "runs")
    discard(found)

    # a run that is found again has only repeated windows; one that isn't shares some at most with runs of its anchor
    times = stored(met.groupBy("anchor", "run").agg(F.count("*").alias("times")), "times")
    once = times.where("times = 1")
    end = lambda n: (n + width).alias("end")
    whole = met.join(times.where("times > 1"), ["anchor", "run"]).select(
        "key", "first", end(F.col("first") + F.size("hashes") - 1)
    )
    single = met.join(once.select("anchor").distinct(), "anchor").join(once, ["anchor", "run"], "left").select(
        "key", "first", F.col("times").isNotNull().alias("once"), F.posexplode("hashes").alias("at", "hash")
    )
    single = stored(single.select("key", "once", (F.col("first") + F.col("at")).alias("first"), "hash"), "windows")
    twice = single.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1").select("hash")
    part = single.where("once").join(twice, "hash").select("key", "first", end(F.col("first")))
    covered = F.collect_list(F.struct("first", "end")).alias("covered")
    twice = stored(whole.unionByName(part).groupBy("key").agg(covered), "covered")
    for table in (met, times, single):
        discard(table)
    marked = twice.join(copied, "key", "full")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            columns: list[list] = [[], [], []]
            copies, found = part.column(2), part.column(3)
            for k, raw in enumerate(part.column(1).to_pylist()):
                words = raw.encode().split()  # bytes are split at the six ASCII characters only
                gone = []
                if copies[k].is_valid:
                    gone = [(0, len(words))] * (len(words) >= width)
                elif found[k].is_valid:
                    gone = merged([(x["first"], x["end"]) for x in found[k].as_py()])
                kept, at = [], 0
                for a, b in gone:
                    kept += words[at:a]
                    at = b
                for column, value in zip(columns, (len(words), gone, b" ".join(kept + words[at:]).decode())):
                    column.append(value)
            removed = pa.array([[{"first": a, "end": b} for a, b in x] for x in columns[1]], interval)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(columns[0], pa.int64()), removed, pa.array(columns[2], pa.string())],
                names=[id, "n_words", "removed", "kept"],
            )

    interval = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
    joined = keyed.join(marked, "key", "left").select(F.col(id), "text", "copies", "covered")
    schema = f"`{id}` {kind}, n_words long, removed array<struct<first: int, end: int>>, kept string"
    return joined.mapInArrow(rows, schema)
