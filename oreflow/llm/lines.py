"""Removal of lines that resemble an earlier line: an exact set-similarity join over the words of lines.

A line is the set of its words in lower case. Words are ordered by rarity, the same way in all lines. Of two
lines with a Jaccard similarity of at least t, the first |x| - ceil(t |x|) + 1 words in that order have one in
common (prefix filter), at places that leave room for enough others (positional filter), and their sizes are
alike (length filter); a 64-bit map of the words excludes most other pairs. What remains is verified on the whole
sets of words, made anew from the texts. Everything is DataFrame expressions.

Rarity is counted over all words, in ``BUCKETS`` hash buckets, so that the table of counts has the same size for any
corpus: a word is as rare as its bucket's count on a scale of powers of the fourth root of two. The order needs to be the same everywhere, not
exact. Equal lines are merged first, and sets too small to resemble another one join nothing. Words that are in the
prefix of one line only drop out after one shuffle. Then every line is verified against the earliest line of each of
its prefix words' lists, which finds most of the lines to remove, copies with a few words changed among them, in one
pass over the lists; only lines that are still there after that are paired with all others of their lists.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import discard, small, stored
from oreflow.llm.numbering import numbered

PERCENT = 80
#: Hash buckets for which word counts are kept; a power of two.
BUCKETS = 1 << 20
#: Steps of the scale of rarity; a word's step is in the bits above its hash.
RANKS = 128
RANK_BITS = 7
#: Parts, by their words, in which lists are made and joined; what one shuffles is deleted before the next.
PARTS = 4
#: Codec of the large tables that are stored on the way, lists of prefix words above all.
CODEC = "zstd"
_WHITE = r"[\x20\x09-\x0D]+"
#: White space other than spaces and line ends; only texts with some are split by a pattern, which takes far longer.
_RARE_WHITE = r"[\x09\x0B-\x0D]"


def word_list(text: Column) -> Column:
    spaced = F.replace(F.lower(text), F.lit("\n"), F.lit(" "))
    split = F.when(text.rlike(_RARE_WHITE), F.split(F.lower(text), _WHITE)).otherwise(F.split(spaced, " "))
    return F.array_remove(split, "")


def keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, text, key): key tells texts with one id apart."""
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("key"))


def text_lines(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, key, number, line)"""
    # outer: else Spark adds a filter that splits each text once more; lines of a null text are dropped below
    return keyed(docs, id, text).select("id", "key", F.posexplode_outer(F.split("text", "\n", -1)).alias("number", "line"))


def rarity(docs: DataFrame, text: str, buckets: int) -> Column:
    """The step of rarity of each bucket of words, in a token's highest bits, as an array that is computed once.

    All words are counted.
    """
    words = docs.select(F.explode_outer(word_list(F.col(text))).alias("word")).where("word is not null")
    counted = words.groupBy(F.xxhash64("word").bitwiseAND(buckets - 1).alias("bucket")).agg(F.count("*").alias("n"))
    spark = docs.sparkSession
    every = spark.range(buckets).withColumnRenamed("id", "bucket").join(counted, "bucket", "left")
    step = F.least(F.lit(RANKS - 1), F.floor(4 * F.log2(F.coalesce("n", F.lit(0)) + 1))).cast("long")
    high = F.shiftleft(step, 63 - RANK_BITS)
    row = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", high.alias("step")))), lambda x: x["step"]).alias("steps"))
    return stored(row, "rarity").scalar()


def tokens(line: Column, steps: Column, buckets: int) -> Column:
    """Distinct words of a line as positive numbers, rarest first: the step of rarity, then 56 bits of the hash."""

    def token(hashed: Column) -> Column:
        step = F.get(steps, hashed.bitwiseAND(buckets - 1).cast("int"))
        # never null: else Spark would sort boxed values
        return F.coalesce(step, F.lit(0).cast("long")).bitwiseOR(F.shiftrightunsigned(hashed, 1 + RANK_BITS))

    hashes = F.transform(word_list(line), lambda word: F.xxhash64(word))
    return F.sort_array(F.array_distinct(F.transform(F.array_distinct(hashes), token)))


def without_prefix(table: DataFrame, *columns: str) -> DataFrame:
    """What is still needed of a stored table, stored; the table, most of which is prefixes and maps, is deleted."""
    less = stored(table.select(*columns), "less", CODEC)
    discard(table)
    return less


def may_match(x: str, y: str, percent: int, placed: bool = True) -> Column:
    """Length and bitmap filter for two sets, and positional filter if they are prefix rows of one word."""
    size = lambda r: f"shiftright({r}at, 32)"
    place = lambda r: f"({r}at & 4294967295)"
    sizes = f"({size(x)} + {size(y)})"
    rules = [
        f"100 * least({size(x)}, {size(y)}) >= {percent} * greatest({size(x)}, {size(y)})",
        f"{100 + percent} * bit_count({x}map ^ {y}map) <= {100 - percent} * {sizes}",
        f"{100 + percent} * least({size(x)} - {place(x)}, {size(y)} - {place(y)}) >= {percent} * {sizes}",
    ]
    return F.expr(" and ".join(rules if placed else rules[:2]))


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, id: str, text: str, percent: int) -> DataFrame:
    """Of pairs (a, b) of places of sets, those that are similar; their words are made from the texts again."""
    ends = pairs.select(F.col("a").alias("place")).unionByName(pairs.select(F.col("b").alias("place"))).distinct()
    # a text is split once for all its lines that are needed
    needed = ends.join(sets.select("place", "id", "key", "number"), "place").groupBy("id", "key")
    needed = stored(needed.agg(F.collect_list(F.struct("number", "place")).alias("wanted")), "needed")
    own = keyed(docs, id, text).alias("own")
    found = own.join(small(needed).alias("n"), F.expr("own.id <=> n.id and own.key = n.key"))
    found = found.select(F.split("own.text", "\n", -1).alias("lines"), F.explode("n.wanted").alias("w"))
    words = F.transform(word_list(F.get("lines", F.col("w.number"))), lambda x: F.xxhash64(x))
    grams = found.select("w.place", F.array_distinct(words).alias("words")).dropDuplicates(["place"])
    grams = stored(grams, "words")
    both = pairs.join(grams.select(F.col("place").alias("a"), F.col("words").alias("x")), "a")
    both = both.join(grams.select(F.col("place").alias("b"), F.col("words").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    similar = 100 * shared >= percent * (F.size("x") + F.size("y") - shared)
    out = stored(both.where(similar).select("a", "b"), "similar")
    discard(needed)
    discard(grams)
    return out


def dedup_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT, buckets: int = BUCKETS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(id, n_lines, removed, kept) per row: numbers of the removed lines (from 0), and the text without them.

    Columns named in ``carry`` come along in a struct of that name.

    A line is removed if an earlier line, removed or not, has a Jaccard similarity of at least ``percent``
    hundredths; earlier by id, then by number in the text. Words are compared by 64-bit hashes; what two lines are
    candidates for depends on 56 bits of them.

    Defined cases. Lines without words match nothing and stay. A null text has no lines and stays null; an empty
    one has one empty line. Rows that agree in id and text are one document: each gets the result of the first.
    In rows that share an id but not the text, equal lines with equal number are all first; similar ones go by the
    hash of their words. A null id comes before all others. An empty table gives an empty result. Columns other
    than ``id`` and ``text`` are not read.
    """
    steps = rarity(docs, text, buckets)
    # told by the line itself: a filter on the tokens would have Spark make them twice
    lines = text_lines(docs, id, text).where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn("steps", steps)
    lines = lines.withColumn("tokens", tokens(F.col("line"), F.col("steps"), buckets)).drop("line", "steps")
    n = F.size("tokens")
    prefix = F.slice("tokens", F.lit(1), n - F.floor((n * percent + 99) / 100).cast("int") + 1)
    # whether an odd number of words falls on each of 64 bits; sets differ by at least as many words as bits
    odd = F.expr("aggregate(tokens, 0L, (b, t) -> b ^ shiftleft(1L, cast(t & 63 as int)))")
    alone = 100 * n < percent * (n + 1)  # no other set is similar to one so small
    own = [F.xxhash64("tokens").alias("set"), n.cast("long").alias("size"), odd.alias("map"), F.when(~alone, prefix).alias("prefix")]
    lines = stored(lines.select("id", "key", "number", *own), "lines", CODEC)
    first = F.min(F.struct("id", "number", "key", "size", "map", "prefix")).alias("s")
    sets = lines.groupBy("set").agg(first, F.count("*").alias("copies")).select("set", "copies", "s.*", F.lit("").alias("all"))
    merged = stored(sets, "sets", CODEC)
    lines = without_prefix(lines, "id", "key", "number", "set")
    sets = numbered(merged, "all", [F.col("id").asc_nulls_first(), F.col("number"), F.col("set")], CODEC)
    discard(merged)

    at = F.shiftleft("size", 32).bitwiseOR(F.col("pos").cast("long")).alias("at")
    words = sets.where("prefix is not null").select("place", "size", "map", F.posexplode("prefix").alias("pos", "word"))
    words = words.select("word", "place", at, "map")
    # the whole list is one frame: its first line and its length are found once a list
    listed = Window.partitionBy("word").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    head = [F.first(c).over(listed).alias(f"head_{c}") for c in ("place", "at", "map")]
    # the head's place, null if it can't be similar; the head has its own
    near = F.when((F.col("place") == F.col("head_place")) | may_match("head_", "", percent), F.col("head_place"))
    lists = []
    for part in range(PARTS):
        met = words.where(F.pmod("word", F.lit(PARTS)) == part).select("*", *head, F.count("*").over(listed).alias("n")).where("n > 1")
        lists.append(stored(met.select("word", "place", "at", "map", near.alias("near_head")), "met", CODEC))
    sets = without_prefix(sets, "place", "id", "key", "number", "set", "copies")
    pairs = reduce(DataFrame.unionByName, lists).where("near_head < place")
    pairs = stored(pairs.select(F.col("near_head").alias("a"), F.col("place").alias("b")).distinct(), "pairs")
    found = verified(pairs, sets, docs, id, text, percent)
    discard(pairs)
    gone = stored(found.select(F.col("b").alias("place")).distinct(), "gone")

    # lines that are still there, against earlier ones of their lists that they have not been compared with
    alike = F.expr("x.word = y.word and x.place < y.place") & may_match("x.", "y.", percent)
    parts = []
    for part in lists:
        met = part.where("near_head is null or near_head < place").select("word", "place", "at", "map")
        still = met.join(small(gone), "place", "left_anti")
        both = met.alias("x").join(still.alias("y"), alike)
        parts.append(stored(both.select(F.col("x.place").alias("a"), F.col("y.place").alias("b")).distinct(), "pairs"))
        discard(part)
    pairs = stored(reduce(DataFrame.unionByName, parts).distinct(), "pairs")
    found = verified(pairs, sets, docs, id, text, percent)
    for table in (*parts, pairs):
        discard(table)
    gone = gone.unionByName(found.select(F.col("b").alias("place"))).distinct().withColumn("near", F.lit(True))

    # a line goes if its set does, or if it isn't the first with its set
    state = sets.select("set", "place", "copies", F.col("id").alias("first_id"), F.col("number").alias("first_number"))
    state = state.join(gone, "place", "left").where("near or copies > 1").drop("place", "copies")
    marked = lines.select("id", "key", "number", "set").join(small(stored(state, "state")), "set")
    marked = marked.where("near is not null or not (id <=> first_id and number = first_number)")
    marked = marked.groupBy("id", "key").agg(F.sort_array(F.collect_set("number")).alias("removed"))
    marked = stored(marked, "removed")
    discard(lines)
    discard(sets)

    along = [F.struct(*(F.col(c) for c in carry)).alias("carry")] if carry else []
    own = docs.select(F.col(id), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("key"), *along).alias("own")
    joined = own.join(marked.alias("m"), F.col(f"own.`{id}`").eqNullSafe(F.col("m.id")) & F.expr("own.key = m.key"), "left")
    split = F.split("text", "\n", -1)
    # runs of lines between removed ones, cut out of the list of lines
    ends = F.concat(F.col("removed"), F.array(F.size("lines")))
    runs = F.transform(
        ends,
        lambda end, k: F.slice(
            "lines",
            F.when(k == 0, 1).otherwise(F.get("removed", k - 1) + 2),
            end - F.when(k == 0, 0).otherwise(F.get("removed", k - 1) + 1),
        ),
    )
    joined = joined.select(f"own.`{id}`", "text", split.alias("lines"), "removed", *["carry"] * bool(carry))
    return joined.select(
        F.col(id),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(runs), "\n")).alias("kept"),
        *["carry"] * bool(carry),
    )
