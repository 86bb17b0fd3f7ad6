"""Packing token sequences: documents into as few sequences of a fixed length as a local search can find.

The work is split in two. ``tokenise`` cuts each document into pieces that fit a sequence. ``pack`` deals the
pieces (lengths only) into cells of a bounded number of pieces and packs each cell for itself: best fit gives a
first packing, then moves and exchanges between underfull sequences raise the sum of squared fills, so that
emptier ones run empty. Cells lose at most part of a sequence each, whatever the size of the table.

Defined cases. A null text is empty; an empty document is its end mark alone. Rows are packed one by one, so
repeated rows and rows without an id are kept as often as they come. An empty table gives an empty result. Other
columns of the input are not read, so their names don't matter.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import stored

LENGTH = 2048
END = 0
#: Pieces that one cell packs together; bounds the memory of a task.
CELL_PIECES = 20_000
#: Sequences in a row that could not be emptied, after which a cell is done.
PATIENCE = 40
#: The pattern without its look-ahead; the same for texts that have no two white-space characters in a row.
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
_TWO_SPACES = re.compile(r"\s\s")
_encoders: dict[str, tuple] = {}


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens() -> dict[str, int]:
    """The added tokens of the vocabulary's tokenizer, which stand for their names wherever a text holds them."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def encoder(ranks: str, added: dict[str, int] | None = None):
    """A function from text to ids for a rank file and added tokens; built once per worker."""
    added = added or {}
    key = ranks, *sorted(added.items())
    if key not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            merge = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[key] = tuple(
            tiktoken.Encoding(name, pat_str=p, mergeable_ranks=merge, special_tokens={})
            for name, p in (("whole", public_tokenizers.PATTERN), ("plain", PLAIN_PATTERN))
        )
    whole, plain = _encoders[key]

    def ordinary(text: str) -> list[int]:
        return (whole if _TWO_SPACES.search(text) else plain).encode_ordinary(text)

    if not added:
        return ordinary
    names = re.compile("|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)))

    def ids_of(text: str) -> list[int]:
        ids, at = [], 0
        for m in names.finditer(text):
            ids += [*ordinary(text[at : m.start()]), added[m.group()]]
            at = m.end()
        return ids + ordinary(text[at:]) if at else ordinary(text)

    return ids_of


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole sequences, the first piece takes what is over."""
    ends = list(range(n, 0, -length))[::-1]
    starts = [0, *ends[:-1]]
    return [(a, b - a) for a, b in zip(starts, ends)]


def tokenise(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, ranks: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of every document: id, piece, start, length, ids_crc32 and, if asked for, the ids (binary, 32 bit).

    Without ``ranks`` the ids are those of the vocabulary's tokenizer, its added tokens too; a rank file has none.
    """
    own = ranks is None
    ranks = ranks or vocabulary()
    kind = docs.schema[id].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(ranks, added_tokens() if own else None)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[list] = [[], [], [], [], [], []]
                for k, t in enumerate(part.column(1).to_pylist()):
                    ids = np.array([*ids_of(t or ""), END], "<u4")
                    for piece, (start, n) in enumerate(cuts(len(ids), length)):
                        raw = ids[start : start + n].tobytes()
                        for column, value in zip(rows, (k, piece, start, n, zlib.crc32(raw), raw)):
                            column.append(value)
                columns = [part.column(0).take(pa.array(rows[0], pa.int32())), pa.array(rows[1], pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in rows[2:5]]
                columns += [pa.array(rows[5], pa.binary())] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    names = [id, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return docs.select(F.col(id), F.col(text)).mapInArrow(pieces, schema)


def best_fit(lengths: np.ndarray, room: int) -> list[list[int]]:
    """Long pieces first, each into the fullest sequence that still takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(room + 1)]
    used = 0  # bit r is set if some sequence has room for exactly r more
    for item in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[item])
        fits = used >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                used ^= 1 << r
            bins[b].append(item)
        else:
            b, r = len(bins), room
            bins.append([item])
        by_room[r - n].append(b)
        if r > n:
            used |= 1 << (r - n)
    return bins


class Search:
    """Local search over the underfull sequences of a packing."""

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], room: int):
        self.length, self.room = lengths, room
        self.bins = bins
        self.fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
        self.open = [k for k in range(len(bins)) if self.fill[k] < room]
        self.items = np.array([i for k in self.open for i in bins[k]], np.int64)
        self.owner = np.full(len(lengths), -1, np.int64)
        for k, b in enumerate(bins):
            self.owner[b] = k

    def _shift(self, give: list[int], take: list[int], a: int, b: int) -> None:
        for items, x, y in ((give, a, b), (take, b, a)):
            for i in items:
                self.bins[x].remove(i)
                self.bins[y].append(i)
                self.owner[i] = y
                self.fill[x] -= self.length[i]
                self.fill[y] += self.length[i]

    def _gain(self, d: np.ndarray, to: np.ndarray, a: int) -> np.ndarray:
        """Growth of the sum of squared fills when d more ids go from sequence a to sequences ``to``."""
        return 2 * d * (self.fill[to] - self.fill[a] + d)

    def _move(self, a: int) -> bool:
        others = np.array([k for k in self.open if k != a and 0 < self.fill[k]])
        if not len(others):
            return False
        left = self.room - self.fill[others]
        for i in sorted(self.bins[a], key=lambda i: -self.length[i]):
            ok = left >= self.length[i]
            if ok.any():
                self._shift([i], [], a, int(others[np.where(ok, left, self.room + 1).argmin()]))
                return True
        return False

    def _exchange(self, a: int, give: list[int]) -> bool:
        """Give one or two pieces of sequence a for the one piece elsewhere that gains most."""
        n = int(self.length[give].sum())
        items, owner = self.items, self.owner[self.items]
        d = n - self.length[items]
        ok = (owner != a) & (d > 0) & (d <= self.room - self.fill[owner])
        gain = np.where(ok, self._gain(d, owner, a), 0)
        best = int(gain.argmax()) if len(gain) else 0
        if not len(gain) or gain[best] <= 0:
            return False
        self._shift(give, [int(items[best])], a, int(owner[best]))
        return True

    def _for_two(self, a: int, i: int) -> bool:
        """Give one piece for two smaller ones of another sequence."""
        n = int(self.length[i])
        for k in self.open:
            if k == a or len(self.bins[k]) < 2 or not 0 < self.fill[k] < self.room:
                continue
            own = sorted(self.bins[k], key=lambda j: self.length[j])
            sizes = [int(self.length[j]) for j in own]
            for x in range(len(own) - 1):
                y = bisect.bisect_left(sizes, n - sizes[x], x + 1) - 1  # the pair stays below n
                if y > x and n - sizes[x] - sizes[y] <= self.room - self.fill[k]:
                    if self._gain(np.int64(n - sizes[x] - sizes[y]), np.int64(k), a) > 0:
                        self._shift([i], [own[x], own[y]], a, k)
                        return True
        return False

    def step(self, a: int) -> bool:
        if self._move(a):
            return True
        own = sorted(self.bins[a], key=lambda i: -self.length[i])
        if any(self._exchange(a, [i]) for i in own):
            return True
        if any(self._exchange(a, [i, j]) for x, i in enumerate(own[:8]) for j in own[x + 1 : 9]):
            return True
        return any(self._for_two(a, i) for i in own[:8])

    def run(self, patience: int) -> None:
        least = -(-int(self.length.sum()) // self.room)
        stuck: set[int] = set()
        failed = 0
        while failed < patience and int((self.fill > 0).sum()) > least:
            left = [k for k in self.open if 0 < self.fill[k] and k not in stuck]
            if not left:
                return
            a = min(left, key=lambda k: self.fill[k])
            while self.fill[a] and self.step(a):
                pass
            if self.fill[a]:
                stuck.add(a)
                failed += 1
            else:
                failed = 0


def place(lengths: np.ndarray, room: int, patience: int = PATIENCE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece."""
    bins = best_fit(lengths, room)
    search = Search(lengths, bins, room)
    search.run(patience)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, own in enumerate(b for b in search.bins if b):
        sequence[own] = k
        offset[own] = np.cumsum(lengths[own]) - lengths[own]
    return sequence, offset


def pack(
    pieces: DataFrame, length: int = LENGTH, cell_pieces: int = CELL_PIECES, patience: int = PATIENCE
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (any columns beside ``length``; a stored table).

    ``sequence_id`` holds the cell in its upper half. The offsets within a sequence are gapless from 0.
    """
    cells = max(1, -(-pieces.count() // cell_pieces))

    def packed(cell: pa.Table) -> pa.Table:
        sequence, offset = place(cell["length"].to_numpy().astype(np.int64), length, patience)
        sequence += cell["_cell"].to_numpy() << np.int64(32)
        placed = cell.drop_columns("_cell")
        return placed.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    dealt = pieces.withColumn("_cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(cells)))
    return dealt.groupBy("_cell").applyInArrow(packed, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Where each piece of each document goes: id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(stored(tokenise(docs, id, text, length, with_ids=False), "pieces"), length)


def sequences(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """The packed sequences themselves: sequence_id, its documents in order, and its ids."""
    placed = pack(stored(tokenise(docs, id, text, length), "pieces"), length)
    ordered = F.array_sort(F.collect_list(F.struct("offset", F.col(id).alias("id"), "ids")))
    return placed.groupBy("sequence_id").agg(ordered.alias("p")).select(
        "sequence_id",
        F.col("p.id").alias("documents"),
        F.aggregate(F.col("p.ids"), F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
    )
