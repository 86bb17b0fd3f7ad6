"""Merkle trees over the rows of a table: digests of rows, of their groups and of the whole, with proofs.

Every row is a leaf. The leaves of a group, in order, form a tree in which each run of ``fan`` consecutive nodes
becomes one parent, level by level until one node is left; the groups' roots in order form the tree of the table.
The proof of a leaf is the list of the other nodes of its run on each level; with it anyone can compute the root
from the row alone.

A tree of any size is built in rounds. A round deals the nodes of a tree into blocks of ``fan ** height``
consecutive ones, one shuffle, and climbs ``height`` levels inside the blocks. On a level a node stands at the row
of its first leaf; its siblings are a fixed number of rows before and after it, so lag and lead columns at these
offsets, masked by the node's slot in its run and by the length of the run, supply them, and the row of the first
child hashes the parent. One running window at the end hands each row the siblings of all its ancestors. The
blocks' digests are the nodes of the next round, so there are as many rounds as the logarithm of the largest group
has digits to the base ``fan ** height``.

Digests are lowercase hex; a node hashes its children's digests as text, one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import small, stored
from oreflow.llm.numbering import numbered

FAN = 2
#: Rows of a block at most.
BLOCK = 1024
PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: of each value the UTF-8 byte count, a colon and the value; of a null a dash."""
    texts = [v.cast("string") for v in values]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return digest(*(F.coalesce(s, F.lit("-")) for s in sized))


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda below, s: digest(s["left"], below, s["right"]))


def siblings(path: Column) -> Column:
    """All digests on a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _height(fan: int) -> int:
    height = 1
    while fan ** (height + 1) <= BLOCK:
        height += 1
    return height


def climb(nodes: DataFrame, fan: int) -> DataFrame:
    """(tree, place, places, digest, ...) with ``block``, ``path`` inside the block and, at its first row, ``top``."""
    height = _height(fan)
    out = nodes.withColumn("block", F.expr(f"place div {fan**height}"))
    out = out.withColumn("node", F.col("digest"))
    rows = Window.partitionBy("tree", "block").orderBy("place")
    for level in range(height):
        step = fan**level
        index = F.expr(f"place div {step}")
        count = F.expr(f"(places + {step - 1}) div {step}")
        first = F.col("place") % step == 0
        shape = {"_slot": index % fan, "_open": first & (count > 1), "_run": F.least(F.lit(fan), count - (index - index % fan))}
        lags = {f"_lag{k}": F.lag("node", k * step).over(rows) for k in range(1, fan)}
        leads = {f"_lead{k}": F.lead("node", k * step).over(rows) for k in range(1, fan)}
        none = F.lit("")
        left = [F.when(F.col("_slot") >= k, F.col(f"_lag{k}")).otherwise(none) for k in range(fan - 1, 0, -1)]
        right = [F.when(F.col("_slot") + k < F.col("_run"), F.col(f"_lead{k}")).otherwise(none) for k in range(1, fan)]
        out = out.withColumns(shape).withColumns({**lags, **leads})
        out = out.withColumn(f"_step{level}", F.when(F.col("_open"), F.struct(F.concat(*left).alias("left"), F.concat(*right).alias("right"))))
        parent = F.when(F.col("_open"), digest(F.col("node"), F.col(f"_step{level}.right"))).otherwise(F.col("node"))
        out = out.withColumn("node", F.when(F.col("place") % (step * fan) == 0, parent))
        out = out.drop(*shape, *lags, *leads)
    above = rows.rowsBetween(Window.unboundedPreceding, 0)
    path = F.array(*(F.last(f"_step{k}", ignorenulls=True).over(above) for k in range(height)))
    return out.withColumn("path", path).select(
        *nodes.columns, "block", F.filter("path", lambda s: s.isNotNull()).alias("path"), F.col("node").alias("top")
    )


def grow(nodes: DataFrame, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """The rounds over numbered nodes, from the leaves up, and (tree, root)."""
    most = nodes.agg(F.max("places")).first()[0] or 0
    rounds = []
    while True:
        rounds.append(stored(climb(nodes, fan), f"round-{len(rounds)}"))
        block = fan ** _height(fan)
        nodes = rounds[-1].where("top is not null").select(
            "tree",
            F.col("block").alias("place"),
            F.expr(f"(places + {block - 1}) div {block}").alias("places"),
            F.col("top").alias("digest"),
        )
        most = -(-most // block)
        if most <= 1:
            return rounds, nodes.select("tree", F.col("digest").alias("root"))


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Rows of the lowest round with their whole ``path``; ``tops`` has (tree, path, ...) above each tree's root."""
    extra = [c for c in tops.columns if c not in ("tree", "path")]
    above = tops.withColumn("place", F.lit(0).cast("long"))
    for rows in reversed(rounds):
        upper = above.select("tree", F.col("place").alias("block"), F.col("path").alias("upper"), *extra)
        above = rows.drop("top").join(small(stored(upper, "above")), ["tree", "block"])
        above = above.withColumn("path", F.concat("path", "upper"))
    return above


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    fan: int = FAN,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """(key, group, leaf, subroot, root, path, and the ``carry`` expressions) of every row.

    ``leaf`` is the digest of the row's ``columns``, ``subroot`` that of its group, ``root`` that of the table;
    ``path`` lists from the leaf up, for each level with more than one node, the digests of the other nodes of the
    run to the left and to the right. Leaves of a group ascend by ``key`` (nulls first), those of the same key by
    their digests; groups ascend bytewise, the null group first.

    Defined cases. A null value is hashed as a dash, so it differs from an empty text. A group of one row has its
    leaf as subroot and adds no level; likewise a table of one group. Repeated rows are separate, equal leaves. An
    empty table gives an empty result. Other columns are neither read nor hashed, whatever their names.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    leaves = docs.select(
        tree.alias("tree"),
        F.col(f"`{key}`").alias("leaf_key"),
        leaf_digest([F.col(f"`{c}`") for c in columns]).alias("digest"),
        F.struct(*(c.alias(n) for n, c in (carry or {}).items()), F.lit(0).alias("_")).alias("carried"),
    )
    leaves = numbered(stored(leaves, "leaves"), "tree", [F.col("leaf_key"), F.col("digest")])
    rounds, subroots = grow(leaves, fan)
    subroots = stored(subroots, "subroots")
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("member"), F.col("root").alias("digest"))
    upper, root = grow(numbered(named, "tree", [F.col("member")]), fan)
    root = stored(root.select("tree", F.array().cast(PATH).alias("path"), "root"), "root")
    tops = descend(upper, root).select(F.col("member").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    rows = descend(rounds, tops)
    group_value = F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).cast(docs.schema[group].dataType)
    return rows.select(
        F.col("leaf_key").alias(key),
        group_value.alias(group),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        *(F.col(f"carried.`{n}`").alias(n) for n in carry or {}),
    )
