"""Extremely randomised trees: one drawn threshold for each node and drawn column.

A node draws ``columns`` of all columns by a hash, and in each of them one threshold between
the node's own smallest and largest value. Of these splits the one that lowers the Gini
impurity most is taken; of equal ones, that of the first column. A row goes left if its value
is at most the threshold. A node of one label, or whose drawn columns are all constant, is a
leaf. Every tree sees all rows.

All trees grow together, a level at a time, in two jobs: the first finds the ranges of columns in
every open node, the second counts rows and positives left of the thresholds, which also gives the
sizes of both sides. The root, the same in all trees, has all its columns measured once; a node
further down those it draws first that vary in the root, and only if too few of them vary within
the node all the others. Both jobs add up whole numbers or take extremes, so the trees do not depend
on partitions or on tasks that ran twice; draws are hashes of seed, tree, node and column.

Scale: rows are written once and stay where they are. A task sends at most a row per tree, open
node and column, and the driver holds the same number, bounded by the settings alone.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from caseloom.session import cut_lineage

# Tasks get these functions by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROOT = 1
# A node measures so many times the columns it tries, before it measures all.
SPARE = 2
RANGES = "tree int, node long, col int, low double, high double"
COUNTS = "tree int, node long, col int, n long, ones long"


def drawn(seed: int, tree: int, node: int, col: int, what: str) -> float:
    """A number in [0, 1) that belongs to a column of a node of a tree."""
    text = f"{tree}|{node}|{col}|{what}|{seed}"
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2.0**32


@dataclass(frozen=True)
class Cut:
    """A split: ``gain`` is the rows of the node times its impurity, less that of both sides."""

    col: int
    threshold: float
    gain: float


@dataclass
class Node:
    n: int
    ones: int
    cut: Cut | None = None


def impurity(n: int, ones: int) -> float:
    """Rows times the Gini impurity."""
    return 2.0 * ones * (n - ones) / n if n else 0.0


@dataclass
class RandomTrees:
    """Trees as nodes by number: the root is 1, the sides of node i are 2i and 2i + 1."""

    columns: tuple[str, ...]
    trees: list[dict[int, Node]] = field(default_factory=list)

    @property
    def splits(self) -> int:
        return sum(node.cut is not None for tree in self.trees for node in tree.values())

    def importances(self) -> list[float]:
        """The share of each column in the gains of a tree, as a mean over trees with a split."""
        shares = []
        for tree in self.trees:
            gains = np.zeros(len(self.columns))
            for node in tree.values():
                if node.cut:
                    gains[node.cut.col] += node.cut.gain
            if gains.sum() > 0:
                shares.append(gains / gains.sum())
        return list(np.mean(shares, axis=0)) if shares else [0.0] * len(self.columns)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """A row per node; leaves have no feature, threshold and gain."""
        rows = [
            (t, i, *((self.columns[node.cut.col], node.cut.threshold, node.cut.gain) if node.cut else (None,) * 3), node.n, node.ones)
            for t, tree in enumerate(self.trees)
            for i, node in sorted(tree.items())
        ]
        return spark.createDataFrame(
            rows, "tree int, node long, feature string, threshold double, gain double, rows long, ones long"
        )

    def transform(self, df: DataFrame) -> DataFrame:
        """``prediction``, the mean share of ones in the leaves of a row, next to its columns."""
        shares = [{i: node.ones / node.n for i, node in tree.items() if node.n} for tree in self.trees]
        shared = df.sparkSession.sparkContext.broadcast((self.columns, plain(self.trees), shares))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            columns, trees, shares = shared.value
            for batch in batches:
                points = values(batch, columns)
                total = np.zeros(len(batch))
                for cuts, share in zip(trees, shares):
                    for i, here in reach(cuts, points):
                        total[here] += share.get(i, 0.0)
                yield batch.assign(prediction=total / max(1, len(trees)))

        return df.mapInPandas(score, f"{kinds}, prediction double")


#: The splits of a tree by node, as a column's place and a threshold.
Cuts = dict[int, tuple[int, float]]


def plain(trees: Sequence[dict[int, Node]]) -> list[Cuts]:
    """The splits of trees without types of this module, which broadcasts name and do not carry."""
    return [{i: (node.cut.col, node.cut.threshold) for i, node in tree.items() if node.cut} for tree in trees]


def values(batch: pd.DataFrame, columns: Sequence[str]) -> np.ndarray:
    """The columns as rows of an array, so that the values of one lie together."""
    points = np.ascontiguousarray(batch[list(columns)].to_numpy(dtype=np.float64).T)
    if np.isnan(points).any():
        raise ValueError("a row has a missing value")
    return points


def reach(cuts: Cuts, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The nodes without a split that rows come to, each with its rows."""
    level = [(ROOT, np.arange(points.shape[1]))]
    while level:
        below = []
        for i, here in level:
            if i not in cuts:
                yield i, here
                continue
            col, value = cuts[i]
            right = points[col][here] > value
            sides = (2 * i, here[~right]), (2 * i + 1, here[right])
            below += [(side, rows) for side, rows in sides if len(rows)]
        level = below


def _ranges(
    rows: DataFrame, cols: Sequence[str], trees: list[Cuts], wanted: list[dict[int, list[int]]]
) -> dict[tuple[int, int], dict[int, tuple[float, float]]]:
    """Smallest and largest value of the columns wanted of each node, by tree and node."""
    shared = rows.sparkSession.sparkContext.broadcast((trees, wanted))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees, wanted = shared.value
        places = {(t, i): np.array(asked) for t, nodes in enumerate(wanted) for i, asked in nodes.items()}
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            points = values(batch, cols)
            for t, cuts in enumerate(trees):
                if not wanted[t]:
                    continue
                for i, here in reach(cuts, points):
                    if i not in wanted[t] or not len(here):
                        continue
                    part = points[places[t, i][:, None], here]
                    low, high = part.min(axis=1), part.max(axis=1)
                    old = found.get((t, i))
                    found[t, i] = (np.minimum(old[0], low), np.maximum(old[1], high)) if old else (low, high)
        for (t, i), (low, high) in found.items():
            yield pd.DataFrame({"tree": t, "node": i, "col": places[t, i], "low": low, "high": high})

    extremes = (
        rows.select(*cols)
        .mapInPandas(measure, RANGES)
        .groupBy("tree", "node", "col")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .toPandas()
    )
    told: dict[tuple[int, int], dict[int, tuple[float, float]]] = {}
    for r in extremes.itertuples():
        told.setdefault((r.tree, r.node), {})[r.col] = (r.low, r.high)
    return told


def _counts(
    rows: DataFrame, cols: Sequence[str], label: str, trees: list[Cuts], tried: list[dict[int, list[tuple[int, float]]]]
) -> dict[tuple[int, int, int], tuple[int, int]]:
    """Rows and ones left of the thresholds tried in each open node."""
    shared = rows.sparkSession.sparkContext.broadcast((trees, tried))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees, tried = shared.value
        found: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            points, ones = values(batch, cols), batch[label].to_numpy(dtype=np.int64)
            for t, cuts in enumerate(trees):
                if not tried[t]:
                    continue
                for i, here in reach(cuts, points):
                    if i not in tried[t]:
                        continue
                    one = ones[here]
                    for col, threshold in tried[t][i]:
                        left = points[col][here] <= threshold
                        part = np.array([left.sum(), one[left].sum()])
                        found[t, i, col] = found.get((t, i, col), 0) + part
        if found:
            yield pd.DataFrame([(*at, *part) for at, part in found.items()], columns=["tree", "node", "col", "n", "ones"])

    counted = (
        rows.mapInPandas(count, COUNTS)
        .groupBy("tree", "node", "col")
        .agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
        .toPandas()
    )
    return {(r.tree, r.node, r.col): (int(r.n), int(r.ones)) for r in counted.itertuples()}


def fit(
    df: DataFrame, cols: Sequence[str], label: str, trees: int = 100, depth: int = 5, columns: int | None = None, seed: int = 42
) -> RandomTrees:
    """Trees on a label of 0 and 1. Rows without a label take no part; a missing value is an error.

    ``columns`` is how many a node draws, the root of their number by default.
    """
    number = columns or max(1, math.isqrt(len(cols)))
    wanted = [F.col(c).cast("double").alias(c) for c in cols]
    rows = cut_lineage(df.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias(label), *wanted))
    size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(label), F.lit(0))).first()
    # The root is measured even where it stays a leaf, so that a missing value is noticed.
    root = _ranges(rows, cols, [{}], [{ROOT: list(range(len(cols)))}]).get((0, ROOT), {})
    varied = {c for c, (low, high) in root.items() if low < high}
    model = RandomTrees(tuple(cols), [{ROOT: Node(int(size[0]), int(size[1]))} for _ in range(trees)])
    open_nodes = [(t, ROOT) for t in range(trees)]
    for level in range(depth):
        open_nodes = [(t, i) for t, i in open_nodes if model.trees[t][i].ones not in (0, model.trees[t][i].n)]
        if not open_nodes or not varied:
            break
        orders = {
            (t, i): sorted(varied, key=lambda c: (drawn(seed, t, i, c, "column"), c)) for t, i in open_nodes
        }
        splits = plain(model.trees)
        if level:
            ranges = _ranges(rows, cols, splits, _by_tree(trees, {at: o[: SPARE * number] for at, o in orders.items()}))
            short = {
                at: order[SPARE * number :]
                for at, order in orders.items()
                if len(order) > SPARE * number and sum(low < high for low, high in ranges[at].values()) < number
            }
            if short:
                for at, more in _ranges(rows, cols, splits, _by_tree(trees, short)).items():
                    ranges[at] |= more
        else:
            ranges = dict.fromkeys(open_nodes, root)
        tried = {}
        for (t, i), order in orders.items():
            measured = ranges[t, i]
            taken = [c for c in order if c in measured and measured[c][0] < measured[c][1]][:number]
            if taken:
                tried[t, i] = [(c, threshold(*measured[c], drawn(seed, t, i, c, "threshold"))) for c in sorted(taken)]
        if not tried:
            break
        counts = _counts(rows, cols, label, splits, _by_tree(trees, tried))
        open_nodes = []
        for (t, i), choices in tried.items():
            tree = model.trees[t]
            node = tree[i]
            node.cut = best(node, [(c, x, counts[t, i, c]) for c, x in choices])
            n, ones = counts[t, i, node.cut.col]
            tree[2 * i], tree[2 * i + 1] = Node(n, ones), Node(node.n - n, node.ones - ones)
            open_nodes += [(t, 2 * i), (t, 2 * i + 1)]
    return model


def _by_tree(trees: int, nodes: dict) -> list[dict]:
    """What is asked of nodes, a dictionary for each tree."""
    parts: list[dict] = [{} for _ in range(trees)]
    for (t, i), asked in nodes.items():
        parts[t][i] = asked
    return parts


def threshold(low: float, high: float, share: float) -> float:
    """A value from ``low`` on and below ``high``, so that both sides have rows."""
    value = float(low + share * (high - low))
    return float(low) if value >= high else value


def best(node: Node, choices: list) -> Cut:
    """The split with the largest gain, the first column of equal ones."""
    chosen = None
    for col, value, (n, ones) in choices:
        gain = impurity(node.n, node.ones) - impurity(n, ones) - impurity(node.n - n, node.ones - ones)
        if chosen is None or gain > chosen.gain:
            chosen = Cut(col, value, gain)
    return chosen
