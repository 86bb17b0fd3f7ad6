"""Boosted trees and forests over number columns and category columns with any number of values.

A category with many values is one column per value to a tree: a node asks "is it this value?". Those columns are
never written out. Rows hold their values' numbers, a pass over the rows adds up what falls on each (node, value),
and Spark picks the best value of each node, so a fit costs rows times columns, not rows times values. Numbers are
cut into at most ``BINS`` bins. Each level of all trees that grow together (boosting: one per class, a forest: all)
takes one pass; only the sums of the bins and the best value of each node reach the driver. Below the root the nodes'
sums are known from the splits above, so bins and best values come of one job.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.session import scratch

BINS = 32
#: Rows up to which bins are cut from a list of all values; beyond, from quantiles of all rows.
LISTED = 10_000
QUANTILE_ERROR = 0.0005
STEP = 0.1
SEED = 42
#: Sums that wait in a task until equal ones are added up.
WAITING = 1 << 18
POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))


@dataclass
class Tree:
    """Nodes by number; ``test`` is the column a node asks for (numbers first, then categories), -1 for a leaf.

    A row goes left if its number is at most ``threshold`` (its bin at most ``cut``), or its category's value has
    the number ``cut``. ``value`` has a leaf's mean, or its share of each class.
    """

    test: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[list[float]] = field(default_factory=list)

    def add(self, value: list[float]) -> int:
        for column, x in zip((self.test, self.cut, self.threshold, self.left, self.right, self.value), (-1, 0, 0.0, -1, -1, value)):
            column.append(x)
        return len(self.test) - 1

    def leaves(self, columns: list[np.ndarray], numbers: int, bins: bool = False) -> np.ndarray:
        """The node each row ends in; number columns hold bins if ``bins``."""
        node = np.zeros(len(columns[0]), np.int64)
        for k, test in enumerate(self.test):  # a node's children come after it
            if test >= 0:
                here = node == k
                x = columns[test]
                left = x <= (self.cut[k] if bins else self.threshold[k]) if test < numbers else x == self.cut[k]
                node[here] = np.where(left[here], self.left[k], self.right[k])
        return node


@dataclass
class TreesModel:
    """Groups of trees: with ``weights`` a weighted sum for each class, without votes of one group."""

    numbers: int
    groups: list[list[Tree]]
    weights: list[float] | None
    classes: int

    def scores(self, columns: list[np.ndarray], bins: bool = False) -> np.ndarray:
        if self.weights is None:
            out = np.zeros((len(columns[0]), self.classes))
            for tree in self.groups[0]:
                out += np.array(tree.value)[tree.leaves(columns, self.numbers, bins)]
            return out
        out = np.zeros((len(columns[0]), len(self.groups)))
        for c, trees in enumerate(self.groups):
            for tree, weight in zip(trees, self.weights):
                out[:, c] += weight * np.array(tree.value)[tree.leaves(columns, self.numbers, bins), 0]
        return out

    def transform(self, indexed: DataFrame, columns: list[str]) -> DataFrame:
        """Rows with ``prediction``; ``columns`` name the filled numbers and the categories' numbers."""

        @F.pandas_udf("double")
        def predict(*values: pd.Series) -> pd.Series:
            arrays = [v.to_numpy() for v in values]
            return pd.Series(self.scores(arrays).argmax(axis=1).astype(float) if len(arrays[0]) else np.zeros(0))

        return indexed.withColumn("prediction", predict(*[F.col(f"`{c}`") for c in columns]))

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps([self.numbers, [[vars(t) for t in g] for g in self.groups], self.weights, self.classes])
        spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreesModel:
        numbers, groups, weights, classes = json.loads(spark.read.text(path).first().value)
        return cls(numbers, [[Tree(**t) for t in g] for g in groups], weights, classes)


@dataclass
class BinnedRows:
    """Rows to fit trees on: ``b0, b1, ...`` the numbers' bins, ``c0, ...`` the categories' numbers, ``y`` the class."""

    rows: DataFrame
    thresholds: list[np.ndarray]
    sizes: list[int]
    classes: int

    @classmethod
    def of(cls, indexed: DataFrame, numbers: list[str], categories: list[str], sizes: list[int], label: str, classes: int) -> BinnedRows:
        """From rows with filled numbers, the categories' numbers (their size for none) and the class's number."""
        picked = [F.col(f"`{c}`").alias(f"n{k}") for k, c in enumerate(numbers)]
        picked += [F.col(f"`{c}`").cast("int").alias(f"c{k}") for k, c in enumerate(categories)]
        rows = indexed.select(*picked, F.col(label).cast("int").alias("y")).persist()
        try:
            return cls._stored(rows, len(numbers), sizes, classes)
        finally:
            rows.unpersist()

    @classmethod
    def _stored(cls, rows: DataFrame, numbers: int, sizes: list[int], classes: int) -> BinnedRows:
        count = rows.count()
        if not count:
            raise ValueError("no rows to fit trees on")
        thresholds = cuts(rows, numbers, count)
        # rows of one value lie together, so that a batch adds up its sums; the number makes a row's weights its own
        widest = sorted(range(len(sizes)), key=lambda k: -sizes[k])
        order = [f"c{k}" for k in widest] + [f"n{k}" for k in range(numbers)] + ["y"]
        binned = [F.lit(0) if not len(t) else sum_of(F.col(f"n{k}"), t) for k, t in enumerate(thresholds)]
        path = scratch(rows.sparkSession, "binned")
        rows.sortWithinPartitions(*order).select(
            *[b.cast("tinyint").alias(f"b{k}") for k, b in enumerate(binned)], *[f"c{k}" for k in range(len(sizes))], "y",
            F.monotonically_increasing_id().alias("place"),
        ).write.parquet(path)
        schema = "".join(f"b{k} TINYINT, " for k in range(numbers)) + "".join(f"c{k} INT, " for k in range(len(sizes)))
        return cls(rows.sparkSession.read.schema(schema + "y INT, place BIGINT").parquet(path), thresholds, sizes, classes)

    @property
    def width(self) -> int:
        return len(self.thresholds) + sum(self.sizes)


def sum_of(number, thresholds: np.ndarray):
    """The bin of a number: how many thresholds lie below it."""
    return F.size(F.filter(F.lit([float(t) for t in thresholds]), lambda t: t < number))


def cuts(rows: DataFrame, numbers: int, count: int) -> list[np.ndarray]:
    """Thresholds that cut the number columns ``n0, ...`` into bins of about the same size."""
    if not numbers:
        return []
    bins = min(BINS, count)
    names = [f"n{k}" for k in range(numbers)]
    if count > LISTED:
        found = rows.approxQuantile(names, [k / bins for k in range(1, bins)], QUANTILE_ERROR)
        return [np.unique(f) for f in found]
    listed = rows.select(*names).toPandas()
    return [list_cuts(listed[c].to_numpy(float), bins) for c in names]


def list_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Middles between neighbouring values where the number of rows so far comes next to an even share."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) <= bins - 1:
        return middles
    stride = len(values) / bins
    out, target, so_far = [], stride, float(counts[0])
    for k in range(1, len(distinct)):
        before, so_far = so_far, so_far + counts[k]
        if abs(before - target) < abs(so_far - target):
            out.append(middles[k - 1])
            target += stride
    return np.array(out)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Numbers from 0 to 1 that follow from 64-bit numbers as if drawn at random."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(salt + 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    return z.astype(np.float64) / 2.0**64


def boosted_targets(model: TreesModel, columns: list[np.ndarray], y: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each class the rows' weights and what a tree is to fit: first the class, then what is left of its log loss."""
    first = not model.groups[0]
    margins = None if first else model.scores(columns, bins=True)
    out = []
    for c in range(len(model.groups)):
        sign = np.where(y == c, 1.0, -1.0)
        target = sign if first else 4 * sign / (1 + np.exp(2 * sign * margins[:, c]))
        out.append((np.ones(len(y)), np.stack([np.ones(len(y)), target, target * target])))
    return out


def bagged_targets(trees: int, classes: int, y: np.ndarray, place: np.ndarray, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each tree how often it draws each row (0 or more times), and that count by class."""
    out = []
    for t in range(trees):
        times = np.searchsorted(POISSON, mixed(place, seed * 1000 + t)).astype(float)
        out.append((times, np.where(np.arange(classes)[:, None] == y, times, 0.0)))
    return out


def variance(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.where(sums[..., 0] > 0.5, sums[..., 0], 1.0)
    return sums[..., 0], np.maximum(sums[..., 2] / n - (sums[..., 1] / n) ** 2, 0.0)


def gini(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = sums.sum(axis=-1)
    return n, 1 - ((sums / np.maximum(n, 1e-300)[..., None]) ** 2).sum(axis=-1)


def gains(left: np.ndarray, total: np.ndarray, impurity) -> np.ndarray:
    """What a split takes off a node's impurity, -1 if one side is empty."""
    (n, all_), (nl, il), (nr, ir) = impurity(total), impurity(left), impurity(total - left)
    n = np.maximum(n, 1e-300)
    return np.where((nl > 0.5) & (nr > 0.5), np.round(all_ - nl / n * il - nr / n * ir, 12), -1.0)


def grow(data: BinnedRows, groups: int, depth: int, gamma: float, stats: int, targets, impurity, value, share: float | None = None, seed: int = SEED, worth=lambda total: 1.0) -> list[Tree]:
    """One tree for each group, level by level.

    ``targets`` gives per group the rows' weights and their ``stats`` numbers that are added up; with ``share`` each
    node only asks for so large a part of all columns, drawn anew. A split must bring ``gamma`` at least: what it takes
    off the node's impurity, times ``worth`` of the node's sums.
    """
    numbers, categories = len(data.thresholds), len(data.sizes)
    starts = np.cumsum([numbers, *data.sizes])[:-1]
    grown = [Tree() for _ in range(groups)]
    active = [[0] for _ in range(groups)]
    known: list[list[np.ndarray]] = []  # sums of the active nodes below the root
    for level in range(depth + 1):
        drawn: dict[tuple[int, int], np.ndarray] = {}
        if share is not None and level < depth:
            for g, nodes in enumerate(active):
                for node in nodes:
                    rng = np.random.default_rng((seed, g, node))
                    mask = np.zeros(data.width, bool)
                    mask[rng.choice(data.width, -(-data.width // round(1 / share)), replace=False)] = True
                    drawn[g, node] = np.packbits(mask, bitorder="little")
        if level == depth or not any(active):
            break
        sums = level_sums(data, grown, active, stats, targets, drawn, starts)
        if level and categories:
            totals = np.zeros((groups, max(map(len, active)), stats))
            for g, own in enumerate(known):
                totals[g, : len(own)] = np.reshape(own, (len(own), stats))
            found_rows = with_best_values(sums, totals, stats, impurity).toArrow()
            of_bins = pc.less(found_rows["v"], 0)
            bins = bin_sums(found_rows.filter(of_bins), totals.shape[:2], numbers, stats)
            best = best_by_node(found_rows.filter(pc.invert(of_bins)), totals.shape[1], stats)
        else:
            sums.persist()
            try:
                bins = bin_sums(sums.where("v < 0").toArrow(), (groups, max(map(len, active))), numbers, stats)
                totals = bins[:, :, 0].sum(axis=2)
                best = {}
                if categories:
                    found_rows = with_best_values(sums.where("v >= 0"), totals, stats, impurity).toArrow()
                    best = best_by_node(found_rows, totals.shape[1], stats)
            finally:
                sums.unpersist()
        following: list[list[int]] = [[] for _ in range(groups)]
        known = [[] for _ in range(groups)]
        for g, nodes in enumerate(active):
            tree = grown[g]
            for slot, node in enumerate(nodes):
                total = totals[g, slot]
                if not tree.test:
                    tree.add(value(total))
                gain, column, cut, left = 0.0, -1, 0, None
                for f in range(numbers):
                    if drawn and not bits_at(drawn[g, node], f):
                        continue
                    lefts = bins[g, slot, f].cumsum(axis=0)[: len(data.thresholds[f])]
                    if len(lefts):
                        found = gains(lefts, total, impurity)
                        k = int(found.argmax())
                        if found[k] > gain:
                            gain, column, cut, left = found[k], f, k, lefts[k]
                if (g, slot) in best and best[g, slot][0] > gain:
                    gain, column, cut, left = best[g, slot]
                if column < 0 or gain * worth(total) < gamma:
                    continue
                tree.test[node], tree.cut[node] = column, cut
                tree.threshold[node] = float(data.thresholds[column][cut]) if column < numbers else 0.0
                sides = [left, total - left]
                tree.left[node], tree.right[node] = (tree.add(value(s)) for s in sides)
                for child, s in zip((tree.left[node], tree.right[node]), sides):
                    if impurity(s)[1] > 2.0**-52:
                        following[g].append(child)
                        known[g].append(s)
        active = following
    return grown


def bits_at(bits: np.ndarray, places):
    """Whether the bits at some places are set."""
    return (bits[places >> 3] >> (places & 7)) & 1 == 1


def level_sums(data: BinnedRows, grown: list[Tree], active: list[list[int]], stats: int, targets, drawn, starts) -> DataFrame:
    """What falls on each bin and each category value of the nodes that may split: (g, slot, f, b, v, s0, s1, ...).

    ``slot`` is the node's place among its tree's, ``f`` the column; ``v`` is -1 for a bin, else the value.
    """
    numbers, categories = len(data.thresholds), len(data.sizes)
    names = data.rows.columns
    out_names = ["g", "slot", "f", "b", "v", *[f"s{k}" for k in range(stats)]]
    schema = pa.schema([*[(c, pa.int32()) for c in out_names[:5]], *[(c, pa.float64()) for c in out_names[5:]]])
    slots = max(map(len, active))

    def table(keys: list[np.ndarray], values: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array(k, pa.int32()) for k in keys] + [pa.array(v, pa.float64()) for v in values.T]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def added(g: int, f: int, codes: list[np.ndarray], values: list[np.ndarray]) -> pa.RecordBatch:
        code, place = np.unique(np.concatenate(codes), return_inverse=True)
        whole = np.concatenate(values, axis=1)
        sums = np.stack([np.bincount(place, v, len(code)) for v in whole], axis=1)
        slot, v = code >> 32, code & 0xFFFFFFFF
        same = np.zeros(len(code), np.int32)
        return table([same + g, slot, same + numbers + f, same, v], sums)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = np.zeros((len(grown), max(numbers, 1), stats, slots * BINS))
        waiting: dict[tuple[int, int], tuple[list, list]] = {}
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy() for k in range(len(names))]
            y, place = columns[-2], columns[-1]
            for g, (times, values) in enumerate(targets(columns, y, place)):
                if not active[g]:
                    continue
                node = grown[g].leaves(columns, numbers, bins=True) if grown[g].test else np.zeros(len(y), np.int64)
                slot_of = np.full(max(len(grown[g].test), 1), -1)
                slot_of[active[g]] = np.arange(len(active[g]))
                slot = slot_of[node]
                at = np.flatnonzero((slot >= 0) & (times > 0))
                slot, own = slot[at], values[:, at]
                for f in range(max(numbers, 1)):
                    code = slot * BINS + (columns[f][at] if numbers else 0)
                    for s in range(stats):
                        bins[g, f, s] += np.bincount(code, own[s], slots * BINS)
                for f in range(categories):
                    v = columns[numbers + f][at].astype(np.int64)
                    keep = v < data_sizes[f]
                    if drawn:
                        for k, node_ in enumerate(active[g]):
                            here = np.flatnonzero((slot == k) & keep)
                            keep[here] = bits_at(drawn[g, node_], starts[f] + v[here])
                    codes, sums = waiting.setdefault((g, f), ([], []))
                    codes.append((slot.astype(np.int64) << 32 | v)[keep])
                    sums.append(own[:, keep])
                    held += len(codes[-1])
            if held >= WAITING:
                for (g, f), (codes, sums) in waiting.items():
                    yield added(g, f, codes, sums)
                waiting, held = {}, 0
        for (g, f), (codes, sums) in waiting.items():
            yield added(g, f, codes, sums)
        by_bin = bins.reshape(len(grown), max(numbers, 1), stats, slots, BINS).transpose(0, 3, 1, 4, 2)
        g, slot, f, b = np.nonzero(by_bin.any(axis=-1))
        yield table([g, slot, f, b, np.full(len(g), -1)], by_bin[g, slot, f, b])

    data_sizes = data.sizes
    ddl = "g int, slot int, f int, b int, v int, " + ", ".join(f"s{k} double" for k in range(stats))
    found = data.rows.mapInArrow(rows, ddl)
    sums = found.groupBy("g", "slot", "f", "b", "v").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(stats)])
    return sums.coalesce(2 * data.rows.sparkSession.sparkContext.defaultParallelism)


def bin_sums(rows: pa.Table, nodes: tuple[int, int], numbers: int, stats: int) -> np.ndarray:
    """The sums of the bins by group, slot, column and bin."""
    bins = np.zeros((*nodes, max(numbers, 1), BINS, stats))
    for r in rows.to_batches():
        g, slot, f, b = (r.column(c).to_numpy() for c in ("g", "slot", "f", "b"))
        bins[g, slot, f, b] = np.stack([r.column(f"s{k}").to_numpy() for k in range(stats)], axis=1)
    return bins


def with_best_values(sums: DataFrame, totals: np.ndarray, stats: int, impurity) -> DataFrame:
    """The bins, and of each task's category values the one with most gain for each node; ``gain`` is 0 for bins."""
    slots = totals.shape[1]
    schema = sums.schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            of_bins = pc.less(batch.column("v"), 0)
            bins, batch = batch.filter(of_bins), batch.filter(pc.invert(of_bins))
            if bins.num_rows:
                yield pa.RecordBatch.from_arrays([*bins.columns, pa.array(np.zeros(bins.num_rows))], names=[*names, "gain"])
            if not batch.num_rows:
                continue
            g, slot = batch.column("g").to_numpy(), batch.column("slot").to_numpy()
            left = np.stack([batch.column(f"s{k}").to_numpy() for k in range(stats)], axis=1)
            gain = gains(left, totals[g, slot], impurity)
            part = pa.Table.from_batches([batch]).append_column("gain", pa.array(gain, pa.float64()))
            kept = first_best(part if kept is None else pa.concat_tables([kept, part]), slots)
        if kept is not None:
            yield from kept.to_batches()

    names = [f.name for f in schema.fields]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields) + ", gain double"
    return sums.mapInArrow(rows, ddl)


def best_by_node(parts: pa.Table, slots: int, stats: int) -> dict[tuple[int, int], tuple]:
    """For each group and slot the gain, column, value and sums of the best of the tasks' category values."""
    out = {}
    for r in first_best(parts, slots).to_pylist():
        out[r["g"], r["slot"]] = (r["gain"], r["f"], r["v"], np.array([r[f"s{k}"] for k in range(stats)]))
    return out


def first_best(rows: pa.Table, slots: int) -> pa.Table:
    """The row of each node with the largest gain, of equal ones the first column and value."""
    node = rows.column("g").to_numpy().astype(np.int64) * slots + rows.column("slot").to_numpy()
    order = np.lexsort((rows.column("v").to_numpy(), rows.column("f").to_numpy(), -rows.column("gain").to_numpy(), node))
    first = np.ones(len(order), bool)
    first[1:] = node[order][1:] != node[order][:-1]
    return rows.take(pa.array(order[first]))


@dataclass(frozen=True)
class BoostedTrees:
    """Boosted trees, one model per class.

    ``gamma`` is the least that a split must take off the loss, half the squared error added up over the node's rows, as
    in gradient boosting libraries: the more rows, the smaller the differences that count.
    """

    n_estimators: int
    max_depth: int
    gamma: float

    def fit(self, data: BinnedRows) -> TreesModel:
        model = TreesModel(len(data.thresholds), [[] for _ in range(data.classes)], [], data.classes)
        for _ in range(self.n_estimators):
            targets = lambda columns, y, place: boosted_targets(model, columns, y)
            mean = lambda s: [float(s[1] / max(s[0], 1))]
            trees = grow(data, data.classes, self.max_depth, self.gamma, 3, targets, variance, mean, worth=lambda s: s[0] / 2)
            for own, tree in zip(model.groups, trees):
                own.append(tree)
            model.weights.append(STEP if model.weights else 1.0)
        return model


@dataclass(frozen=True)
class Forest:
    """Trees on rows drawn with replacement, whose nodes each ask for a third of all columns."""

    n_estimators: int
    max_depth: int
    gamma: float
    seed: int = SEED

    def fit(self, data: BinnedRows) -> TreesModel:
        n, classes, seed = self.n_estimators, data.classes, self.seed
        targets = lambda columns, y, place: bagged_targets(n, classes, y, place, seed)
        shares = lambda s: [float(x) for x in s / max(s.sum(), 1e-300)]
        trees = grow(data, n, self.max_depth, self.gamma, classes, targets, gini, shares, share=1 / 3, seed=seed)
        return TreesModel(len(data.thresholds), [trees], None, classes)
