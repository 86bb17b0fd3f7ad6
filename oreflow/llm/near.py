"""Near-duplicate documents: Jaccard join of word n-gram sets by partitioning their universe.

Two sets of sizes x and y with |x ∩ y| / |x ∪ y| >= t differ in at most (1 - t) / (1 + t) * (x + y) shingles. Sets
are put into bands of sizes from 2^k to 2^(k + 1) - 1. Each band cuts the universe of shingle hashes into equal
ranges, its segments, more of them than the band's largest set can differ in. So two similar sets agree fully
in some segment (pigeonhole), and share an index entry made from that segment's subset. Some segments of a band
also index their subsets with one shingle left out: two sets that differ by one shingle there still meet, so such
a segment counts twice. With that a set's segments count for more than the bound, and it need not look up all of
them: once the lengths of the lists are known, a set leaves out its longest lists, as long as its other segments
reach the bound. Empty segments, which all sets of a band share, are left out first. The few sets for which the
rest doesn't reach the bound look up everything.

Entries that meet give candidates, verified by exact set sizes. Entries are not paired with each other within a
list, which may hold a third of all sets: first every set of a list is verified against the list's first, then, in
lists whose sets are still in several components, against the set that meets most others in all its lists, as the
source of many copies does. Only sets of one list that are in different components after that, and that were not
left out, are compared with each other, by maps of their shingles' parity inside the join, the longer the larger the
sets are; so no link between components is lost, and no component takes the square
of its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import discard, small, stored
from oreflow.llm.graph import components
from oreflow.llm.words import Words, mix, signed, slices, windows

WIDTH = 5
PERCENT = 80
#: Bits of the parity map of a set, by which most pairs that are not similar are told before their sets are fetched;
#: sets from LARGE shingles on have a map of LARGE_BITS, which folds to the size of the others.
PARITY_BITS = 1024
LARGE = 512
LARGE_BITS = 8192
#: 64-bit numbers that the map is folded to where it goes along with index entries: all sets' to so many, and once more,
#: less far, from WIDE_FROM shingles on. Maps as short as the first of these say nothing about sets as large.
FOLD = 4
WIDE, WIDE_FROM = 16, 256
WIDEST, WIDEST_FROM = 64, 2048
#: Segments that a band has beyond what the pigeonhole needs, for each of so many and two more: each lets a set leave
#: out one more of its longest lists.
SPARE_ONE_IN = 8
#: Kinds of index entries: a set is only found by FOUND ones, may leave out SPARED ones, looks up ASKED ones. Those of
#: empty segments are looked up by sets that need them only.
FOUND, SPARED, ASKED, EMPTY, EMPTY_ASKED = range(5)
_SEGMENT = np.uint64(0xD1B54A32D192ED03)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of the word n-grams of each text; of the whole sequence if it is shorter."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    grams, begin = windows(hashes, words.first, width)
    for k, n in enumerate(words.counts().tolist()):
        if n >= width:
            yield np.unique(grams[begin[k] : begin[k + 1]])
        elif n:
            whole, _ = windows(hashes[words.first[k] : words.first[k + 1]], np.array([0, n]), n)
            yield mix(whole + np.uint64(n))  # apart from n-grams of full width
        else:
            yield np.zeros(0, np.uint64)


def set_key(grams: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int(signed(mix(mix(grams).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(grams))))[0])


def parity(grams: np.ndarray) -> bytes:
    """Whether an odd number of shingles falls on each bit; two sets differ by at least as many shingles as bits."""
    bits = LARGE_BITS if len(grams) >= LARGE else PARITY_BITS
    at = (mix(grams ^ _SEGMENT) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(bool)).tobytes()


def fold(map: bytes, size: int) -> np.ndarray:
    """A parity map folded to so many 64-bit numbers, few enough to go along with every index entry of a set."""
    return np.bitwise_xor.reduce(np.frombuffer(map, np.int64).reshape(-1, size), axis=0)


def folds(where: DataFrame) -> DataFrame:
    """(set, fold, wide): the maps of each set that go along with its index entries; small sets have no wide one."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, maps = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            short = [fold(m, FOLD) for m in maps]
            wide = [fold(m, WIDEST if n >= WIDEST_FROM else WIDE) if n >= WIDE_FROM else None for n, m in zip(size, maps)]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, kind), pa.array(wide, kind)], names=["set", "fold", "wide"])

    return where.select("set", "size", "parity").mapInArrow(rows, "set long, fold array<long>, wide array<long>")


def folds_match(x: str, y: str, percent: int) -> Column:
    """Whether the folded parity maps of two rows with a size allow that their sets are similar."""
    bits = " + ".join(f"bit_count({x}.fold[{k}] ^ {y}.fold[{k}])" for k in range(FOLD))
    differ = lambda a, b: f"aggregate(zip_with({a}, {b}, (p, q) -> bit_count(p ^ q)), 0, (n, k) -> n + k)"
    # of a wide map and a wider one, this one is folded to the other's length
    less = lambda c: f"transform(sequence(0, {WIDE - 1}), i -> " + " ^ ".join(f"{c}[i + {k}]" for k in range(0, WIDEST, WIDE)) + ")"
    a, b = f"{x}.wide", f"{y}.wide"
    wide = f"case when size({a}) < size({b}) then {differ(a, less(b))} when size({a}) > size({b}) then {differ(less(a), b)} else {differ(a, b)} end"
    bound = f"{100 - percent} * ({x}.size + {y}.size)"
    return F.expr(f"{100 + percent} * ({bits}) <= {bound} and ({a} is null or {b} is null or {100 + percent} * ({wide}) <= {bound})")


def folded(maps: pa.Array, size: int) -> np.ndarray:
    """Parity maps of one length as rows of numbers, of ``size`` bytes after folding."""
    rows = np.frombuffer(b"".join(maps.to_pylist()), np.uint64).reshape(len(maps), -1, size // 8)
    return np.bitwise_xor.reduce(rows, axis=1)


def parity_distance(x: pa.Array, y: pa.Array) -> np.ndarray:
    """Bits in which the parity maps of each pair of sets differ, at the size of the shorter map."""
    m, n = (pc.binary_length(c).to_numpy(zero_copy_only=False) for c in (x, y))
    out = np.zeros(len(x), np.int64)
    for a, b in {*zip(m.tolist(), n.tolist())}:
        at = np.flatnonzero((m == a) & (n == b))
        rows = [folded(c.take(pa.array(at)), min(a, b)) for c in (x, y)]
        out[at] = np.bitwise_count(rows[0] ^ rows[1]).sum(axis=1, dtype=np.int64)
    return out


def differing(small_size: int, percent: int) -> int:
    """Most shingles in which a set of that size and a similar one that is no smaller can differ."""
    return (100 - percent) * (small_size + small_size * 100 // percent) // (100 + percent)


def band_layout(band: int, percent: int) -> tuple[int, int]:
    """Segments of a band, and how many of them also index their one-deletion neighbourhoods."""
    needed = differing((2 << band) - 1, percent) + 1
    return needed + needed // SPARE_ONE_IN + 2, min(needed, needed // 24 + 3)


def segment_sizes(grams: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each shingle, ascending as the shingles are, and the number in each segment."""
    at = (((grams >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)
    return at, np.bincount(at, minlength=segments)


def spare(grams: np.ndarray, percent: int) -> int:
    """By how much a set's segments count for more than the bound; negative if for less."""
    segments, deletions = band_layout(len(grams).bit_length() - 1, percent)
    _, size = segment_sizes(grams, segments)
    return int((size > 0).sum() + (size[:deletions] > 1).sum()) - differing(len(grams), percent) - 1


def entries(grams: np.ndarray, band: int, percent: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of a set in its band and their kinds; ``short`` if it has nothing to spare."""
    segments, deletions = band_layout(band, percent)
    at, size = segment_sizes(grams, segments)
    full = np.flatnonzero(size)
    element = mix(grams ^ _SEGMENT)
    total = np.zeros(segments, np.uint64)
    total[full] = np.add.reduceat(element, (np.cumsum(size) - size)[full])
    tag = mix(np.arange(segments, dtype=np.uint64) + np.uint64((band + 1) << 40))
    deleted = np.flatnonzero((at < deletions) & (size[at] > 1))
    without = mix(total[at[deleted]] - element[deleted] + tag[at[deleted]])
    kind = np.full(segments + len(deleted), ASKED)
    kind[deletions:segments] = ASKED if short else SPARED
    kind[:segments][size == 0] = EMPTY_ASKED if short else EMPTY
    return np.concatenate([mix(total + tag), without]) >> np.uint64(16), kind  # 48 bits: few enough, and as many lists


def text_key(text: str) -> Column:
    """A 64-bit name of a text, by which it is found again whatever ids its rows have."""
    return F.xxhash64(F.col(text), F.octet_length(F.col(text)))


def memberships(docs: DataFrame, id: str, text: str, width: int, percent: int) -> DataFrame:
    """(id, set, size, spare, parity, text_key) per row; no set for documents without words."""
    kind = docs.schema[id].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            keys, sizes, spares, maps = [], [], [], []
            for grams in shingle_sets(part.column(1), width):
                keys.append(set_key(grams) if len(grams) else None)
                sizes.append(len(grams))
                spares.append(spare(grams, percent) if len(grams) else 0)
                maps.append(parity(grams))
            columns = [part.column(0), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64())]
            columns += [pa.array(spares, pa.int64()), pa.array(maps, pa.binary()), part.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=[id, "set", "size", "spare", "parity", "text_key"])

    schema = f"`{id}` {kind}, set long, size long, spare long, parity binary, text_key long"
    return docs.select(F.col(id), F.col(text), text_key(text).alias("text_key")).mapInArrow(rows, schema)


def indexed(docs: DataFrame, text: str, width: int, percent: int) -> DataFrame:
    """(entry, set, size, kind) of every different set; a task enters copies once."""
    names = ["entry", "set", "size", "kind"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches, text, 1 << 20):
            columns: list[list] = [[] for _ in names]
            for grams in shingle_sets(part.column(0), width):
                n = len(grams)
                key = set_key(grams) if n else 0
                if not n or key in seen:
                    continue
                seen.add(key)
                band = n.bit_length() - 1
                found, kind = entries(grams, band, percent, spare(grams, percent) < 0)
                parts = [(found, kind)]
                if -(-n * percent // 100) < 1 << band:  # sets of the band below may find it
                    found, kind = entries(grams, band - 1, percent, False)
                    parts.append((found, np.where(kind == EMPTY, EMPTY, FOUND)))
                for found, kind in parts:
                    for column, value in zip(columns, (found, np.full(len(found), key), np.full(len(found), n), kind)):
                        column.append(value)
            if columns[0]:
                entry, key, size, kind = (np.concatenate(c) for c in columns)
                arrays = [pa.array(signed(entry)), pa.array(key), pa.array(size, pa.int32()), pa.array(kind, pa.int8())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col(text)).mapInArrow(rows, "entry long, set long, size int, kind tinyint")


def looked_up(met: DataFrame, where: DataFrame) -> DataFrame:
    """(entry, set, size, component, fold, wide, least) that each set looks up, of lists that hold others too: the longest are left out.

    A set that has segments to spare leaves out one less than it could, and so shares ``least`` 2 of the entries it
    looks up with any similar set; the others share 1.
    """
    length = met.groupBy("entry").agg(F.count("*").alias("length"))
    longest = Window.partitionBy("set").orderBy(F.desc("length"), "entry")  # of the lists of one set
    spared = met.where(F.col("kind") == SPARED).join(length, "entry").withColumn("rank", F.row_number().over(longest))
    own = where.select("set", "spare", F.when(F.col("spare") > 0, 2).otherwise(1).alias("least")).join(folds(where), "set")
    spared = spared.join(own, "set").where("rank > spare - 1")
    others = met.where(F.col("kind").isin(ASKED, EMPTY_ASKED)).join(own, "set")
    columns = ["entry", "set", "size", "component", "fold", "wide", "least"]
    return spared.select(columns).unionByName(others.select(columns))


def apart(every: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (entry, set, size, kind, component) of the lists whose sets are in several components."""
    every = every.join(parts, "set", "left").withColumn("component", F.coalesce("component", "set"))
    mixed = every.groupBy("entry").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return every.join(mixed.select("entry"), "entry", "left_semi")


def with_hubs(lists: DataFrame) -> DataFrame:
    """Rows of lists with ``head``: the set of the list that meets most others in all its lists."""
    length = lists.groupBy("entry").agg(F.count("*").alias("length"))
    degree = lists.join(length, "entry").groupBy("set").agg(F.sum("length").alias("degree"))
    most = Window.partitionBy("entry").orderBy(F.desc("degree"), "set")
    return lists.join(degree, "set").withColumn("head", F.first(F.struct("set", "size", "component")).over(most))


def _alike(x: Column, y: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def may_be_similar(pairs: DataFrame, where: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of sets, those whose parity maps don't exclude that they are similar."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = parity_distance(batch.column(2), batch.column(3))
            ok = (100 + percent) * bits <= (100 - percent) * batch.column(4).to_numpy()
            yield batch.select([0, 1]).filter(pa.array(ok))

    x = where.select(F.col("set").alias("a"), F.col("size").alias("m"), F.col("parity").alias("x"))
    y = where.select(F.col("set").alias("b"), F.col("size").alias("n"), F.col("parity").alias("y"))
    sized = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", (F.col("m") + F.col("n")).alias("sizes"))
    return sized.mapInArrow(near, "a long, b long")


def similar(pairs: DataFrame, docs: DataFrame, where: DataFrame, id: str, text: str, width: int, percent: int):
    """Of pairs (a, b) of sets, those that are similar; ``where`` has a row's id and text key, size and parity of each set."""
    pairs = stored(may_be_similar(pairs, where, percent), "pairs")
    ends = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct()
    needed = ends.join(where, "set").select("set", F.col("doc").alias("its_doc"), F.col("text_key").alias("its_key"))
    needed = stored(needed, "needed")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            raw = [grams.tobytes() for grams in shingle_sets(part.column(1), width)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(raw, pa.binary())], names=["set", "grams"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    own = docs.select(F.col(id).alias("doc"), F.col(text).alias("text"), text_key(text).alias("key"))
    # by the text; the id, which may be null, only spares fetching all copies of it
    same = F.col("key").eqNullSafe(F.col("its_key")) & F.col("doc").eqNullSafe(F.col("its_doc"))
    texts = own.join(small(needed), same).dropDuplicates(["set"]).select("set", "text")
    grams = stored(texts.mapInArrow(sets, "set long, grams binary"), "sets")
    sided = pairs.join(grams.withColumnsRenamed({"set": "b", "grams": "y"}), "b")
    sided = sided.join(grams.withColumnsRenamed({"set": "a", "grams": "x"}), "a")
    return sided.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT,
    named: bool = False,
) -> DataFrame:
    """(id, n_shingles, component_id) per row: the smallest id reachable by links of similar documents.

    Documents are sets of word n-grams, ASCII letters in lower case; two link when their intersection is at
    least ``percent`` hundredths of their union. Shingles are compared by 64-bit hashes.

    Defined cases. A text with fewer words than ``width`` is one shingle of all its words. Null texts and texts
    without words have no shingles and link with nothing: their component is their own id. Equal texts are always
    linked; repeated rows give repeated result rows. Rows that share an id but not the text are documents of their
    own; ``named`` adds ``text_key`` and ``component``, which tell those apart. A null id stays null as component of a document that links
    with none, and is never the smallest of others. An empty table gives an empty result. Columns other than
    ``id`` and ``text`` are not read.
    """
    members = stored(memberships(docs, id, text, width, percent), "members")
    where = members.where("set is not null").groupBy("set").agg(
        F.min(id).alias("doc"), F.first("size").alias("size"), F.first("spare").alias("spare"), F.first("parity").alias("parity"),
        F.min_by("text_key", F.struct(F.col(id).isNull(), F.col(id), "text_key")).alias("text_key"),  # of the smallest id
    )
    where = stored(where, "sets")
    row = ["set", "size", "kind"]
    listed = Window.partitionBy("entry").orderBy(F.desc("kind"), "set")
    # an empty segment's list matters only if it has a set that looks it up, which then comes first
    met = indexed(docs, text, width, percent).withColumn("head", F.first(F.struct(*row)).over(listed))
    met = stored(met.where(f"set <> head.set and (kind <> {EMPTY} or head.kind = {EMPTY_ASKED})"), "met")
    heads = met.where(_alike(F.col("size"), F.col("head.size"), percent))
    heads = stored(heads.select(F.col("head.set").alias("a"), F.col("set").alias("b")).distinct(), "pairs")
    links = stored(similar(heads, docs, where, id, text, width, percent), "links")
    parts = stored(components(links), "components").withColumnRenamed("node", "set")

    # within a list, sets that are still apart: first against the one that meets most others, then each other
    every = met.select("entry", *row).unionByName(met.select("entry", *(f"head.{c}" for c in row))).distinct()
    lists = stored(apart(every, parts), "lists")
    discard(met)
    hubs = with_hubs(lists)
    hubs = hubs.where((F.col("component") != F.col("head.component")) & _alike(F.col("size"), F.col("head.size"), percent))
    hubs = hubs.select(F.least("set", "head.set").alias("a"), F.greatest("set", "head.set").alias("b")).distinct()
    hubs = hubs.join(heads.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    links = links.unionByName(stored(similar(stored(hubs, "pairs"), docs, where, id, text, width, percent), "links"))
    parts = stored(components(links), "components").withColumnRenamed("node", "set")
    every = stored(apart(lists.select("entry", *row), parts), "lists")
    discard(lists)
    asked = looked_up(every, where)
    later = "x.entry = y.entry and x.component <> y.component and struct(x.size, x.set) < struct(y.size, y.set)"
    mapped = every.join(folds(where), "set")
    rest = asked.alias("x").join(mapped.alias("y"), F.expr(later) & _alike(F.col("x.size"), F.col("y.size"), percent) & folds_match("x", "y", percent))
    rest = rest.groupBy(F.col("x.set").alias("a"), F.col("y.set").alias("b"), "x.least").agg(F.count("*").alias("shared"))
    rest = rest.where("shared >= least").select("a", "b")
    rest = stored(rest, "pairs")
    discard(every)
    more = similar(rest, docs, where, id, text, width, percent)
    parts = stored(components(links.unionByName(more)), "components").withColumnRenamed("node", "set")

    label = where.select("set", "doc").join(parts, "set", "left").withColumn("component", F.coalesce("component", "set"))
    least = label.groupBy("component").agg(F.min("doc").alias("component_id"))
    label = stored(label.join(least, "component").select("set", "component", "component_id"), "labels")
    return members.join(label, "set", "left").select(
        F.col(id),
        F.col("size").alias("n_shingles"),
        F.when(F.col("set").isNull(), F.col(id)).otherwise(F.col("component_id")).alias("component_id"),
        *(["text_key", "component"] if named else []),
    )
