"""Phrases whose words stand together far more often than by chance.

Phrases are counted level by level. The frequent words of a language get ids by falling frequency; every text is
then a row of ids, with 0 where a word is rare or a piece of text ends. Neighbouring ids are a cell of a table that
is split into tiles, small ones for the commonest ids. Because ids are ranked by frequency, much of what is counted
falls into the few tiles near the corner, which are counted by direct address: one ``numpy.bincount`` over the
whole tile. Tiles with few entries for their cells are counted as sorted coordinates. Cells that reach the bound become the ids of
the next level, ranked by frequency again: two neighbouring pairs overlap in a word, so a frequent pair of pairs is
a phrase of three words, and so on. A phrase can't be frequent if its first or last part is not, so no phrase is
lost.

Counting works on the blocks of ``blocks.py``. A block counts its own tiles; tiles are added up over blocks by a
shuffle on the tile, those with many entries split by their cells. Each block is then written
in the new ids: few are sent to every task, of many each block gets those that it asks for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm import blocks as bl
from oreflow.llm.common import BROADCAST_KEYS, discard, small, stored
from oreflow.llm.numbering import numbered
from oreflow.llm.words import mix

LEAST = 100
LONGEST = 5
INSIDE = 100
APART, BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
#: Ids along a side of the tiles in the corner. The next are as wide, and each further one twice as wide as the last,
#: so a block has few tiles however many words there are.
SIDE = 512
#: Share of a tile's cells that must have an entry for direct address, and cells of such a tile at most.
DENSE_SHARE = 1 / 16
DENSE_CELLS = 4 * SIDE * SIDE
#: Cells in a row of a shuffle at most, and cells that one task adds up for a tile at most (a hot tile's are split).
ROW_CELLS = 1024
GROUP_CELLS = 1 << 20

CHUNK = "grp string, rt int, ct int, block long, cells array<long>, counts array<long>"


def tile_of(ids: np.ndarray) -> np.ndarray:
    return np.searchsorted(SIDE << np.arange(40), ids, "right")


def base_of(tile: np.ndarray) -> np.ndarray:
    """The first id of a tile's side."""
    return np.where(tile > 0, (SIDE >> 1) << tile, 0)


def width_of(tile: np.ndarray) -> np.ndarray:
    return np.where(tile > 0, (SIDE >> 1) << tile, SIDE)


def pair_ids() -> tuple[Column, Column]:
    """The two ids of the column ``cell`` in the tile (rt, ct), as longs."""
    half = F.lit(SIDE >> 1).cast("long")
    first = lambda t: F.when(F.col(t) > 0, F.call_function("shiftleft", half, F.col(t))).otherwise(F.lit(0).cast("long"))
    width = F.when(F.col("ct") > 0, first("ct")).otherwise(F.lit(SIDE).cast("long"))
    inside = F.col("cell") % width
    return first("rt") + ((F.col("cell") - inside) / width).cast("long"), first("ct") + inside


def count_cells(
    tile: np.ndarray, cell: np.ndarray, area: np.ndarray, counts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tile, cell, sum) of each distinct cell, sorted, from its entries.

    Tiles have numbers from 0, ``area`` their cells; ``counts`` are weights of the entries, added exactly below 2^53.
    """
    dense = (np.bincount(tile, minlength=len(area)) >= DENSE_SHARE * area) & (area <= DENSE_CELLS)
    found = []
    for t in np.flatnonzero(dense).tolist():
        own = tile == t
        table = np.bincount(cell[own], None if counts is None else counts[own]).astype(np.int64)
        at = np.flatnonzero(table)
        found.append((np.full(len(at), t), at, table[at]))
    rest = ~dense[tile]
    tile, cell = tile[rest], cell[rest]
    order = np.lexsort((cell, tile))
    tile, cell = tile[order], cell[order]
    new = np.ones(len(cell), bool)
    new[1:] = (cell[1:] != cell[:-1]) | (tile[1:] != tile[:-1])
    begin = np.flatnonzero(new)
    if counts is None:
        sums = np.diff(np.append(begin, len(cell)))
    else:
        sums = np.add.reduceat(counts[rest][order].astype(np.int64), begin) if len(begin) else begin
    found.append((tile[begin], cell[begin], sums))
    tile, cell, sums = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(tile, kind="stable")
    return tile[order], cell[order], sums[order]


def chunk_rows(keys: list[tuple], tile: np.ndarray, cell: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """Counted cells as rows of at most ROW_CELLS cells of one tile; ``keys`` has (grp, rt, ct, block) by tile."""
    new = np.ones(len(tile), bool)
    new[1:] = tile[1:] != tile[:-1]
    first = np.flatnonzero(new)
    inside = np.arange(len(tile)) - np.repeat(first, np.diff(np.append(first, len(tile))))
    begin = np.flatnonzero(inside % ROW_CELLS == 0)
    offsets = pa.array(np.append(begin, len(tile)), pa.int32())
    own = tile[begin].tolist()
    columns = [pa.array([keys[t][k] for t in own], kind) for k, kind in enumerate((pa.string(), pa.int32(), pa.int32(), pa.int64()))]
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (cell, sums)]
    return pa.RecordBatch.from_arrays([*columns, *lists], names=["grp", "rt", "ct", "block", "cells", "counts"])


def pairs_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of neighbours that both have an id, and the ids."""
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    return at, ids[at], ids[at + 1]


def block_tiles(blocks: DataFrame) -> DataFrame:
    """Each block's own counts of neighbouring ids, by tile."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, block, value in zip(*batch.columns):
                _, a, b = pairs_of(bl.numbers_of(value))
                if len(a):
                    rt, ct = tile_of(a).astype(np.int8), tile_of(b).astype(np.int8)
                    tile = rt.astype(np.int16) * 64 + ct
                    corner = np.flatnonzero(np.bincount(tile))
                    number = np.zeros(corner[-1] + 1, np.int32)
                    number[corner] = np.arange(len(corner))
                    tile, base, width = number[tile], base_of(np.arange(54)), width_of(np.arange(54))
                    cell = (a - base[rt]) * width[ct]
                    cell += b - base[ct]
                    area = width[corner // 64] * width[corner % 64]
                    keys = [(group.as_py(), c // 64, c % 64, block.as_py()) for c in corner.tolist()]
                    yield chunk_rows(keys, *count_cells(tile, cell, area))

    return blocks.select("grp", "block", "ids").mapInArrow(rows, CHUNK)


def row_keys(part: pa.RecordBatch) -> tuple[list[tuple], np.ndarray]:
    """Distinct (grp, rt, ct, block) of chunk rows, and the number of each row's."""
    number: dict[tuple, int] = {}
    rows = [number.setdefault(k, len(number)) for k in zip(*(part.column(k).to_pylist() for k in range(4)))]
    return list(number), np.array(rows, np.int64)


def add_up(chunks: DataFrame, least: int, group_cells: int = GROUP_CELLS) -> DataFrame:
    """(grp, a, b, n) of all cells that occur ``least`` times in all blocks together.

    A tile with more than ``group_cells`` entries is dealt by its cells over groups of about as many.
    """
    tile = ["grp", "rt", "ct"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, row = row_keys(batch)
            cells, counts = batch.column("cells"), batch.column("counts")
            size = np.diff(cells.offsets.to_numpy())
            cell, sums = cells.flatten().to_numpy(), counts.flatten().to_numpy()
            groups = np.repeat(batch.column("parts").to_numpy(), size)
            part = (mix(cell.astype(np.uint64)) % groups.astype(np.uint64)).astype(np.int64)
            entry = np.repeat(row, size)
            order = np.lexsort((cell, part, entry))
            pair, number = np.unique(np.stack([entry[order], part[order]], 1), axis=0, return_inverse=True)
            yield chunk_rows([(*keys[k][:3], p) for k, p in pair.tolist()], number.ravel(), cell[order], sums[order])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tile and part; the last one's cells wait for what may follow."""
        held: list[pa.RecordBatch] = []

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            part = pa.concat_batches(held)
            held.clear()
            keys, row = row_keys(part)
            cells, counts = part.column("cells"), part.column("counts")
            entry = np.repeat(row, np.diff(cells.offsets.to_numpy()))
            area = np.array([int(width_of(rt) * width_of(ct)) for _, rt, ct, _ in keys])
            number, cell, sums = count_cells(entry, cells.flatten().to_numpy(), area, counts.flatten().to_numpy())
            last = len(number) if whole else int(np.searchsorted(number, len(keys) - 1))
            if last < len(number):
                held.append(chunk_rows(keys, number[last:], cell[last:], sums[last:]))
            frequent = sums[:last] >= least
            yield chunk_rows(keys, number[:last][frequent], cell[:last][frequent], sums[:last][frequent])

        waiting = 0
        for batch in batches:
            held.append(batch)
            waiting += len(batch.column("cells").flatten())
            if waiting >= group_cells:
                yield from flush(whole=False)
                waiting = 0
        if held:
            yield from flush(whole=True)

    sizes = chunks.groupBy(tile).agg(F.ceil(F.sum(F.size("cells")) / F.lit(group_cells)).alias("parts"))
    large = stored(sizes.where("parts > 1"), "large")
    dealt = chunks.withColumn("block", F.lit(0).cast("long"))
    if not large.isEmpty():
        several = chunks.join(small(large), tile).select(*chunks.columns, "parts").mapInArrow(split, CHUNK)
        dealt = dealt.join(small(large), tile, "left_anti").select(chunks.columns).unionByName(several)
    sums = dealt.repartition(*tile, "block").sortWithinPartitions(*tile, "block").mapInArrow(merge, CHUNK)
    cells = sums.select(*tile, F.explode(F.arrays_zip("cells", "counts")).alias("c")).select(*tile, F.col("c.cells").alias("cell"), F.col("c.counts").alias("n"))
    a, b = pair_ids()
    return cells.select("grp", a.alias("a"), b.alias("b"), "n")


def ranked(counted: DataFrame, *keys: str) -> DataFrame:
    """Stored rows with ``id``: 1 for the group's most frequent, ties by ``keys``."""
    rows = numbered(counted, "grp", [F.col("n").desc(), *(F.col(k) for k in keys)])
    out = rows.withColumn("id", (F.col("place") + 1).cast("int")).drop("place", "places")
    out.stored_at = rows.stored_at
    return out


def new_ids(numbers: np.ndarray, codes: np.ndarray, ids: np.ndarray, pairs: bool) -> bytes:
    """A row of ids in new ones: ``codes``, sorted, are numbers of words or pairs of ids, ``ids`` what they become."""
    if pairs:
        at, a, b = pairs_of(numbers)
        want = a.astype(np.int64) << 32 | b
    else:
        at = np.flatnonzero(numbers >= 0)
        want = numbers[at].astype(np.int64)
    new = np.zeros(len(numbers), np.int32)
    if len(codes):
        place = np.minimum(np.searchsorted(codes, want), len(codes) - 1)
        new[at] = np.where(codes[place] == want, ids[place], 0)
    keep = np.ones(len(new), bool)
    keep[1:] = (new[1:] > 0) | (new[:-1] > 0)  # one 0 tells neighbours apart as well as many
    return bl.packed(new[keep])


CODED = "grp string, block long, ids binary"


def recoded(blocks: DataFrame, keys: DataFrame, asked: DataFrame | None, name: str, few: int = BROADCAST_KEYS) -> DataFrame:
    """Blocks in the ids of the next level. ``keys``, stored, has (grp, word, id) or (grp, code, id).

    At most ``few`` keys are sent to all tasks. Of more, each block gets those it asks for: ``asked`` has the rows
    (grp, block, number, word) or (grp, block, code) of all blocks, which meet the keys and then the blocks in a
    shuffle.
    """
    pairs = "code" in keys.columns
    if keys.limit(few + 1).count() <= few:
        table = keys.toArrow()
        own: dict[str, tuple] = {}
        for group in table.column("grp").unique().to_pylist():
            part = table.filter(pc.equal(table.column("grp"), group))
            values, ids = part.column(1).combine_chunks(), part.column("id").to_numpy()
            if pairs:
                order = np.argsort(values := values.to_numpy())
                values, ids = values[order], ids[order]
            own[group] = values, ids
        shared = blocks.sparkSession.sparkContext.broadcast(own)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for k, group in enumerate(batch.column("grp").to_pylist()):
                    numbers = bl.numbers_of(batch.column("ids")[k])
                    codes, ids = shared.value.get(group, (np.zeros(0, np.int64), np.zeros(0, np.int32)))
                    if not pairs and len(ids):
                        found = pc.index_in(batch.column("words")[k].values, codes).to_numpy(zero_copy_only=False)
                        codes = np.flatnonzero(~np.isnan(found))
                        ids = ids[found[codes].astype(np.int64)]
                    out.append(new_ids(numbers, codes, ids, pairs))
                columns = [batch.column("grp"), batch.column("block"), pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["grp", "block", "ids"])

        columns = ["grp", "block", "ids"] + ["words"] * (not pairs)
        return stored(blocks.select(columns).mapInArrow(rows, CODED), f"blocks-{name}")

    def recode(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(codes := right.column("code").to_numpy())
        codes, ids = codes[order], right.column("id").to_numpy()[order]
        out = [new_ids(bl.numbers_of(v), codes, ids, pairs) for v in left.column("ids")]
        return pa.table([left.column("grp"), left.column("block"), pa.array(out, pa.binary())], names=["grp", "block", "ids"])

    found = asked.join(keys, ["grp", keys.columns[1]])
    code = F.col("code" if pairs else "number").cast("long").alias("code")
    answers = found.select(F.col("block").alias("asker"), code, "id")
    both = blocks.select("grp", "block", "ids").groupBy("block").cogroup(answers.groupBy("asker"))
    return stored(both.applyInArrow(recode, CODED), f"blocks-{name}")


def frequent_phrases(
    docs: DataFrame, group: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST,
    block_bytes: int = bl.BLOCK_BYTES, few: int = BROADCAST_KEYS,
) -> tuple[DataFrame, list[DataFrame]]:
    """(grp, n): words of each group; and, for each length, the phrases that occur ``least`` times.

    The latter have (grp, id, a, b, n, words, last, heads, tails): ids of the first and last part one word shorter,
    the count, the words, the last of them, and the counts of the phrase's first and last 1, 2, ... words.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{group}`").cast("string"), F.lit("und")).alias("grp"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    finish = lambda b: [bl.listed(b["words"]), bl.listed(b["counts"]), bl.raw(b["numbers"])]
    schema = "words array<string>, counts array<long>, ids binary"
    first = stored(bl.encode(texts, schema, finish, APART, BREAKS, block_bytes=block_bytes), "blocks")
    entries = bl.dictionary(first, "counts")
    words = stored(entries.groupBy("grp", "word").agg(F.sum("counts").alias("n")), "words")
    totals = stored(words.groupBy("grp").agg(F.sum("n").alias("n")), "totals")
    none = F.array().cast("array<long>")
    level = ranked(words.where(F.col("n") >= least), "word").select(
        "grp", "id", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "n", F.col("word").alias("words"), F.col("word").alias("last"),
        none.alias("heads"), none.alias("tails"),
    )
    keys = stored(level.select("grp", F.col("words").alias("word"), "id"), "keys")
    blocks = recoded(first, keys, entries, "words", few)
    discard(first)
    levels = [level]
    for length in range(2, longest + 1):
        chunks = stored(block_tiles(blocks), f"tiles-{length}")
        pairs = ranked(add_up(chunks, least), "a", "b")
        levels.append(stored(joined(pairs, levels[-1]), f"phrases-{length}"))
        if length < longest:
            code = F.shiftleft("a", 32).bitwiseOR(F.col("b"))
            keys = stored(pairs.select("grp", code.alias("code"), "id"), "keys")
            asked = chunks.select("grp", "block", "rt", "ct", F.explode("cells").alias("cell"))
            a, b = pair_ids()
            asked = asked.select("grp", "block", F.shiftleft(a, 32).bitwiseOR(b).alias("code"))
            old, blocks = blocks, recoded(blocks, keys, asked, str(length), few)
            discard(old)
        discard(chunks)
        discard(pairs)
    return totals, levels


def joined(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Phrases of pairs of overlapping shorter ones."""
    left = parts.select("grp", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("words").alias("words_a"), F.col("heads").alias("heads_a"))
    right = parts.select("grp", F.col("id").alias("b"), F.col("n").alias("n_b"), "last", F.col("tails").alias("tails_b"))
    return pairs.join(left, ["grp", "a"]).join(right, ["grp", "b"]).select(
        "grp", "id", "a", "b", "n",
        F.concat("words_a", F.lit(" "), "last").alias("words"),
        "last",
        F.concat("heads_a", F.array("n_a")).alias("heads"),
        F.concat("tails_b", F.array("n_b")).alias("tails"),
    )


def lowest_cut(a: str, n: str) -> Column:
    """(score, cut, l, r) of the lowest-scoring cut, the earliest of equals; in decimals, so nothing overflows."""
    wide = lambda x: f"CAST({x} AS DECIMAL(19, 0))"
    head, tail = "heads[j - 1]", "tails[size(tails) - j]"
    score = f"(CAST(1000 AS DECIMAL(4, 0)) * {wide(a)} * {wide(n)}) DIV ({wide(head)} * {wide(tail)})"
    return F.expr(
        f"array_min(transform(sequence(1, size(heads)), j -> named_struct('score', {score}, 'cut', j, 'l', {head}, 'r', {tail})))"
    )


def mine_phrases(
    docs: DataFrame, group: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST,
    inside: int = INSIDE, block_bytes: int = bl.BLOCK_BYTES, few: int = BROADCAST_KEYS,
) -> DataFrame:
    """(group, phrase, words, a, l, r, n, score): phrases of 2 to ``longest`` words that occur ``least`` times.

    Texts are lower-cased (A to Z) and cut into pieces at ``.,;:!?`` and line ends; phrases are contiguous words of
    a piece, overlapping occurrences count. ``a`` is the phrase's count, ``n`` the words of the group, ``l`` and
    ``r`` the counts of its two parts at the lowest-scoring cut, and the score floor(1000 * a * n / (l * r)). A
    phrase inside a longer one that occurs at least ``inside`` percent as often is left out.

    Defined cases. A null or empty text has no words. A null group is ``und``, and one with such texts of its own.
    Repeated rows count as often as they come. A group without frequent phrases, and an empty table, give no rows.
    Other columns are not read. Words are told apart by 64-bit hashes within a block and by their letters beyond.
    """
    totals, levels = frequent_phrases(docs, group, text, least, longest, block_bytes, few)
    kept = None
    for k, level in enumerate(levels[1:], 1):
        phrases = level.withColumn("size", F.lit(k + 1))
        if k + 1 < len(levels):
            longer = levels[k + 1]
            ends = longer.select("grp", F.col("a").alias("id"), "n").unionByName(longer.select("grp", F.col("b").alias("id"), "n"))
            most = ends.groupBy("grp", "id").agg(F.max("n").alias("most"))
            phrases = phrases.join(most, ["grp", "id"], "left").where(f"most IS NULL OR 100 * most < {int(inside)} * n").drop("most")
        kept = phrases if kept is None else kept.unionByName(phrases)
    scored = kept.withColumnRenamed("n", "f").join(small(totals), "grp").withColumn("best", lowest_cut("f", "n"))
    return scored.select(
        F.col("grp").alias(group), F.col("words").alias("phrase"), F.col("size").alias("words"), F.col("f").alias("a"),
        F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"),
    )


def best_phrases(phrases: DataFrame, group: str = "lang", first: int = 2000) -> DataFrame:
    """Each group's ``first`` phrases with their ``rank``: by score, count and the phrase's bytes."""
    order = Window.partitionBy(group).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return phrases.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
