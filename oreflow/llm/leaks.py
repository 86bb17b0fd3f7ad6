"""Finding benchmark items in documents by the fingerprints of item-sized windows.

Items and windows are weighted sets of word n-grams; an n-gram that few items hold weighs more, and one that no
item holds as much as one of a single item. A window of as
many words as an item gets a 64-bit SimHash. Fingerprints are cut into blocks; of two within ``RADIUS`` bits, some
block differs in at most RADIUS // BLOCKS bits. So the items are indexed under every value so near to each of
their blocks, and a look-up by the window's blocks finds every fingerprint within the radius. Those that are
within it are verified by their exact weighted Jaccard similarity. So are the windows that share one of an item's
heaviest n-grams, enough of them that a similar window can't do without: the radius alone loses some.

Only windows that share n-grams with items of their size are fingerprinted: those that have one at the same place as
the item, and those that have many of them, in whatever order. Windows that would reach over an end of the text are
clipped to it, so that an item of which words are missing there is found too. This is a join of all n-grams of all documents with
those of the items; copies of a text are merged before. Everything is DataFrame expressions.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import small, stored

WIDTH = 5
PERCENT = 80
#: Bits in which fingerprints found by the index may differ, and its blocks; the latter divides 64.
RADIUS = 15
BLOCKS = 8
#: Stretches of a window in which one may begin that holds an item's n-grams in another order, and the hundredths of
#: its size that it must hold of them.
STEPS = 16
LEAST_HELD = 60
#: Largest weight of an n-gram.
MAX_WEIGHT = 8
# White space and punctuation part words.
_BETWEEN = r"""[\x20\x09-\x0D.,;:!?"'()\[\]]+"""


def _words(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(F.lower(text), _BETWEEN), ""), lambda w: F.xxhash64(w))


def _grams(hashes: Column, width: int) -> Column:
    last = F.size(hashes) - width
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(places, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(width))))


def text_grams(texts: DataFrame, width: int) -> DataFrame:
    """The texts with ``grams``, the hash of every word n-gram in order, in place of ``text``."""
    others = [c for c in texts.columns if c != "text"]
    hashed = texts.select(*others, _words(F.col("text")).alias("hashes"))
    return hashed.select(*others, _grams(F.col("hashes"), width).alias("grams"))


def counted(grams: DataFrame, by: list[str], weights: DataFrame, rare: int) -> DataFrame:
    """Weighted sets: ``by``, g, c (how often) and w (weight; ``rare`` if no item has g) of rows (by, grams)."""
    rows = grams.select(*by, F.explode("grams").alias("g")).groupBy(*by, "g").agg(F.count("*").alias("c"))
    return rows.join(small(weights), "g", "left").withColumn("w", F.coalesce("w", F.lit(rare)))


def fingerprints(sets: DataFrame, by: list[str]) -> DataFrame:
    """(by, mass, print): total weight and SimHash of weighted sets; each bit is the vote of the weights."""
    weight = F.col("c") * F.col("w")
    hashed = F.xxhash64("g", F.lit(7))
    # two bits to a sum: in its lower and in its upper half
    votes = [
        F.sum(F.shiftright(hashed, k).bitwiseAND(0x100000001) * weight).alias(f"v{k}") for k in range(32)
    ]
    summed = sets.groupBy(*by).agg(F.sum(weight).alias("mass"), *votes)
    bits = []
    for k in range(32):
        low, high = F.col(f"v{k}").bitwiseAND(0xFFFFFFFF), F.shiftright(f"v{k}", 32)
        for vote, bit in ((low, 1 << k), (high, 1 << (k + 32))):
            bits.append(F.when(2 * vote > F.col("mass"), F.lit(bit - (1 << 64) if bit >> 63 else bit)).otherwise(0))
    return summed.select(*by, "mass", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("print"))


def block(number: int, blocks: int) -> Column:
    bits = 64 // blocks
    return F.shiftrightunsigned("print", number * bits).bitwiseAND((1 << bits) - 1)


def flips(radius: int, blocks: int) -> list[int]:
    """All patterns of so few bits of a block as a block within the radius differs in."""
    bits = 64 // blocks
    return [sum(1 << b for b in c) for k in range(radius // blocks + 1) for c in combinations(range(bits), k)]


def crowded(hits: DataFrame) -> DataFrame:
    """(key, n, first, end) of item-sized windows that hold the n-grams of items in whatever order.

    A window can be moved on to its first n-gram that some item has without losing one. So windows begin at the first
    such n-gram of each stretch of a STEPS-th of their size, where the next STEPS stretches hold at least LEAST_HELD
    hundredths of their size of them, and no fewer than those from the stretches beside it.
    """
    own = hits.select("key", "m", "n", "p").distinct().withColumn("step", F.expr(f"greatest(1, n div {STEPS})"))
    own = own.withColumn("stretch", F.expr("p div step"))
    own = own.groupBy("key", "m", "n", "stretch").agg(F.min("p").alias("first"), F.count("*").alias("c"))
    along = Window.partitionBy("key", "n").orderBy("stretch")
    own = own.withColumn("held", F.sum("c").over(along.rangeBetween(0, STEPS)))
    own = own.withColumns({"before": F.lag("held", 1, 0).over(along), "after": F.lead("held", 1, 0).over(along)})
    own = own.where(100 * F.col("held") >= LEAST_HELD * F.col("n")).where("held > before and held >= after")
    return own.select("key", "n", "first", F.least("m", F.col("first") + F.col("n")).alias("end"))


def leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """(key, item, first_word, n_words, shared, mass) of every matching window; ``key`` is that of the text.

    ``shared`` and ``mass`` are the weights of intersection and union. See ``decontaminate`` for defined cases.
    """
    bench = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).distinct()
    bench = bench.withColumn("key", F.struct("item", F.xxhash64("text").alias("t")))
    bench = stored(text_grams(bench.drop("item"), width).where(F.size("grams") > 0), "items")
    held = bench.select("key", F.explode("grams").alias("g")).distinct().groupBy("g").agg(F.count("*").alias("n"))
    n_items = bench.count()
    weight = 1 + F.floor(F.log2(F.lit(n_items) / F.col("n")))
    rare = min(MAX_WEIGHT, max(1, n_items.bit_length()))  # as much as an n-gram of one item, whatever their number
    weights = stored(held.select("g", F.least(weight, F.lit(MAX_WEIGHT)).cast("int").alias("w")), "weights")
    places = bench.select(F.size("grams").alias("n"), F.posexplode("grams").alias("at", "g")).distinct()
    places = stored(places, "places")

    texts = docs.select(F.col(text).alias("text")).where(F.col(text).isNotNull())
    texts = texts.withColumn("key", F.xxhash64("text", F.octet_length("text")))
    found = text_grams(texts, width).withColumn("m", F.size("grams"))  # below the explosion, which drops the array
    # outer: else Spark adds a filter on the size of the array, which computes it once more, in nested form
    found = found.select("key", "m", F.posexplode_outer("grams").alias("p", "g"))
    hits = found.join(small(places), "g").select("key", "m", "n", "p", (F.col("p") - F.col("at")).alias("from"))
    hits = stored(hits.distinct(), "hits")
    # clipped to the text; where the item would begin before the text, so much at its start as an item has, too
    first, end = F.greatest(F.lit(0), "from"), F.least("m", F.col("from") + F.col("n"))
    ends = F.array_distinct(F.array(end, F.least("m", first + F.col("n"))))
    found = hits.select("key", "n", first.alias("first"), F.explode(ends).alias("end"))
    found = found.unionByName(crowded(hits)).groupBy("key").agg(
        # at most twice as many as the text has words, and as the items that hang over its ends, times sizes of items
        F.collect_set(F.struct("first", (F.col("end") - F.col("first")).alias("size"), "n")).alias("places")
    )
    found = stored(found, "places")
    whole = texts.join(small(found), "key").dropDuplicates(["key"])
    windows = text_grams(whole, width).select("key", "grams", F.explode_outer("places").alias("x"))
    windows = windows.select("key", "x.*", F.slice("grams", F.col("x.first") + 1, F.col("x.size")).alias("grams"))
    name = ["key", "first", "size", "n"]  # n-grams of the window, and of the items it is compared with
    windows = stored(counted(windows, name, weights, rare), "windows")
    sets = stored(counted(bench.withColumn("n", F.size("grams")), ["key", "n"], weights, rare), "sets")

    own = stored(fingerprints(windows, name), "prints")
    bench_prints = stored(fingerprints(sets, ["key", "n"]).withColumnRenamed("key", "item"), "prints")
    index = F.array(
        *(
            F.struct(F.lit(k).alias("k"), block(k, blocks).bitwiseXOR(F.lit(flip)).alias("v"))
            for k in range(blocks)
            for flip in flips(radius, blocks)
        )
    )
    index = bench_prints.select("item", "n", "mass", "print", F.explode(index).alias("b"))
    index = stored(index.select("item", "n", F.col("mass").alias("item_mass"), F.col("print").alias("item_print"), "b.*"), "index")
    looked = F.array(*(F.struct(F.lit(k).alias("k"), block(k, blocks).alias("v")) for k in range(blocks)))
    looked = own.select(*name, "mass", "print", F.explode(looked).alias("b")).select(*name, "mass", "print", "b.*")
    near = looked.join(small(index), ["n", "k", "v"])
    near = near.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
    near = near.select(*name, "item", "mass", "item_mass")
    # those that fingerprints miss: a window without an item's heaviest n-grams, of more than 100 - percent
    # hundredths of its mass, can't reach percent hundredths of it
    heaviest = Window.partitionBy("key").orderBy(F.desc("w"), "g").rowsBetween(Window.unboundedPreceding, -1)
    own_weight = F.col("c") * F.col("w")
    heads = sets.withColumn("before", F.coalesce(F.sum(own_weight).over(heaviest), F.lit(0)))
    heads = heads.withColumn("item_mass", F.sum(own_weight).over(Window.partitionBy("key")))
    heads = heads.where(100 * F.col("before") <= (100 - percent) * F.col("item_mass"))
    heads = stored(heads.select(F.col("key").alias("item"), "n", "g", "item_mass"), "heads")
    sharing = windows.join(small(heads), ["n", "g"]).select(*name, "item", "item_mass").distinct()
    near = near.unionByName(sharing.join(own.select(*name, "mass"), name))
    alike = 100 * F.least("mass", "item_mass") >= percent * F.greatest("mass", "item_mass")
    near = stored(near.where(alike).distinct(), "near")

    both = near.join(windows.drop("w"), name).join(
        sets.select(F.col("key").alias("item"), "g", F.col("c").alias("d"), "w"), ["item", "g"]
    )
    both = both.groupBy(*name, "item", "mass", "item_mass").agg(F.sum(F.col("w") * F.least("c", "d")).alias("shared"))
    union = F.col("mass") + F.col("item_mass") - F.col("shared")
    return both.where(100 * F.col("shared") >= percent * union).select(
        "key",
        F.col("item.item").alias("item"),
        F.col("first").alias("first_word"),
        (F.col("size") + width - 1).alias("n_words"),
        "shared",
        union.alias("mass"),
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **settings: object
) -> DataFrame:
    """(id, item, first_word, n_words, shared, mass): the best window for every row of docs and every item in it.

    The best window has the largest ``shared / mass``, then the first place. Words are in lower case, parted by
    white space and punctuation, and compared by 64-bit hashes.

    Defined cases. Null texts and texts with fewer words than an n-gram have no result rows. Items with fewer words than an
    n-gram, null ones too, match nothing. Equal texts get equal results; repeated rows repeat their result rows.
    An item given twice with the same id counts once; given with several texts, its best counts. Ids may be null.
    Empty tables give an empty result. Other columns are not read.
    """
    found = leaks(docs, items, text, **settings)
    order = F.struct(-F.col("shared") / F.col("mass"), "first_word", "n_words", "shared", "mass")
    best = found.groupBy("key", "item").agg(F.min(order).alias("b"))
    best = stored(best.select("key", "item", "b.first_word", "b.n_words", "b.shared", "b.mass"), "leaks")
    own = docs.select(F.col(id), F.xxhash64(F.col(text), F.octet_length(F.col(text))).alias("key"))
    return own.join(small(best), "key").drop("key")
