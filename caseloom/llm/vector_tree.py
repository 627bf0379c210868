"""Nearest neighbours by cosine, through a hierarchical k-means tree.

Method: a tree of ``BRANCH`` means a node, over vectors scaled to length one. A query walks it
best bin first: a priority queue holds nodes by the distance of their mean, the nearest is
taken out, a leaf is visited, any other node puts its children in. How many leaves a query
visits is calibrated: for a bounded draw of queries the true neighbours are found by one scan
of all rows, and visits are widened until ``recall`` of those neighbours lie in visited
leaves. Every row of a visited leaf is compared; scores are taken anew, in double precision,
from the vectors as given.

Bounds: the tree is fitted in one task on a hash draw of about ``SAMPLE`` distinct vectors (fewer
where they are long, ``SAMPLE_VALUES``), so it has at most ``SAMPLE`` leaves and that is all
that is broadcast, with ``CALIBRATION`` queries for the scan. All rows are indexed.

Scale: equal vectors are folded first and keep their ``k + 1`` smallest ids, which hold the
best ``k`` of every query among them; queries are searched once for each distinct vector, so a
vector that a third of all rows have is one row. Neighbouring leaves lie together in groups of
about ``BLOCK_VALUES`` numbers, a larger leaf is dealt out to several groups. A query is sent
once to each group with a leaf it visits, however many they are, and the queries of a group are
cut into shares of that size, too; each group and share is a row of its own with a key of its
own, so a busy leaf is spread over all tasks. It hands on ``k + 1`` rows a query at most.

Defined cases: vectors that are null, zero, or hold a null or a number that is not finite,
and rows without an id, take no part; of vectors of several lengths only those of the most
frequent one do (of equally frequent ones the shortest); equal rows are one row; an id with
several vectors is several rows, none of them a neighbour of another; equal scores are in the
order of ids; a table of one vector, or none, gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from caseloom.llm.arrow import map_batches
from caseloom.session import cut_lineage

BRANCH = 16
#: Distinct vectors that the tree is fitted on, and the numbers they may hold in all.
SAMPLE = 16_384
SAMPLE_VALUES = 1 << 22
#: A node of so many drawn vectors is not divided.
LEAF = 48
ROUNDS = 8
CALIBRATION = 256
RECALL = 0.95
BLOCK_VALUES = 1 << 17
SEED = 42


class Tree(NamedTuple):
    """Nodes in rows: their mean, their children and, for leaves, their number (else -1)."""

    means: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray


def unit(vectors: np.ndarray) -> np.ndarray:
    """The vectors at length one; they are scaled before squares could leave the range."""
    top = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = np.ldexp(vectors, -np.frexp(top)[1])
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, the same whatever stands beside a row."""
    a, b = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (left, right))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _divide(points: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Means of the points, and the nearest mean of each."""
    means = points[random.choice(len(points), min(BRANCH, len(points)), replace=False)]
    near = np.zeros(len(points), dtype=np.int64)
    for _ in range(ROUNDS):
        near = (points @ means.T).argmax(axis=1)
        sums = np.zeros_like(means)
        np.add.at(sums, near, points)
        sizes = np.sqrt((sums * sums).sum(axis=1))
        used = sizes > 1e-9
        means = sums[used] / sizes[used, None]
    near = (points @ means.T).argmax(axis=1)
    used, near = np.unique(near, return_inverse=True)
    return means[used], near


def grow(points: np.ndarray, leaf_size: int = LEAF) -> Tree:
    """The tree over vectors of length one; nodes of at most ``leaf_size`` are leaves."""
    random = np.random.default_rng(SEED)
    means, first, count, leaf, leaves = [np.zeros(points.shape[1])], [0], [0], [-1], 0
    waiting = [(0, points)]
    while waiting:
        node, own = waiting.pop()
        middles, near = _divide(own, random) if len(own) > leaf_size else (own[:0], None)
        if len(middles) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        first[node], count[node] = len(means), len(middles)
        for i, mean in enumerate(middles):
            means.append(mean)
            first.append(0)
            count.append(0)
            leaf.append(-1)
            waiting.append((first[node] + i, own[near == i]))
    whole = lambda values: np.array(values, dtype=np.int32)
    return Tree(np.array(means), whole(first), whole(count), whole(leaf))


def place(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The leaf of each point: from the root on the child with the nearest mean."""
    node = np.zeros(len(points), dtype=np.int64)
    going = np.flatnonzero(tree.count[node] > 0)
    while len(going):
        for parent in np.unique(node[going]).tolist():
            here = going[node[going] == parent]
            begin = tree.first[parent]
            means = tree.means[begin : begin + tree.count[parent]]
            node[here] = begin + (points[here] @ means.T).argmax(axis=1)
        going = going[tree.count[node[going]] > 0]
    return tree.leaf[node]


def visits(tree: Tree, point: np.ndarray) -> Iterator[int]:
    """All leaves, best bin first."""
    queue = [(0.0, 0)]
    while queue:
        _, node = heapq.heappop(queue)
        if tree.leaf[node] >= 0:
            yield int(tree.leaf[node])
            continue
        begin, size = int(tree.first[node]), int(tree.count[node])
        away = -(tree.means[begin : begin + size] @ point)
        for i, distance in enumerate(away.tolist()):
            heapq.heappush(queue, (distance, begin + i))


def widen(tree: Tree, points: np.ndarray, truth: list[list[int]], recall: float) -> int:
    """The fewest leaf visits a query with which so large a share of ``truth`` is seen.

    ``truth`` has, for each point, the leaves of its true neighbours.
    """
    wanted = recall * sum(map(len, truth))
    walks = [visits(tree, p) for p in points]
    leaves, seen, done = int(tree.leaf.max()) + 1, 0, 0
    while done < leaves and seen < wanted:
        done += 1
        for walk, own in zip(walks, truth):
            seen += own.count(next(walk))
    return max(1, done)


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column as rows of numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64, copy=False)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vec`` (doubles) of the rows that take part, and no others."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    infinite = F.lit(float("inf"))
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    rows = rows.where(F.col("id").isNotNull() & whole & F.exists("vec", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("vec") == (lengths["size"] if lengths else 0))


def fold(rows: DataFrame, keep: int) -> DataFrame:
    """``key``, ``vec`` and ``ids``: each distinct vector with the ``keep`` smallest of its ids."""
    order = Window.partitionBy("vec").orderBy("id")
    first = rows.dropDuplicates(["id", "vec"]).withColumn("at", F.row_number().over(order)).where(F.col("at") <= keep)
    folded = first.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return cut_lineage(folded.withColumn("key", F.monotonically_increasing_id()))


def fit(folded: DataFrame, count: int, size: int, leaf_size: int = LEAF) -> Tree:
    """The tree, fitted in one task on a draw of the distinct vectors."""
    wanted = max(1, min(SAMPLE, SAMPLE_VALUES // size))
    share = -(-count // wanted)
    draw = F.xxhash64("vec", F.lit(SEED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(_matrix(b.column(0)), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if found:
            order = np.argsort(np.concatenate([f[1] for f in found]), kind="stable")
            tree = grow(unit(np.concatenate([f[0] for f in found])[order]), leaf_size)
            parts = [pa.array([part.tobytes()], pa.binary()) for part in tree]
            yield pa.RecordBatch.from_arrays(parts, list(Tree._fields))

    some = folded.select("vec", draw.alias("draw")).where(F.pmod("draw", F.lit(share)) == 0)
    row = map_batches(some.repartition(1), run, "means binary, first binary, count binary, leaf binary").first()
    if row is None:  # nothing was drawn from a short table
        return Tree(np.zeros((1, size)), *np.zeros((2, 1), dtype=np.int32), np.zeros(1, dtype=np.int32))
    first, count, leaf = (np.frombuffer(row[name], dtype=np.int32) for name in Tree._fields[1:])
    return Tree(np.frombuffer(row["means"]).reshape(-1, size), first, count, leaf)


def placed(folded: DataFrame, tree: Tree) -> DataFrame:
    """Every distinct vector with its ``leaf``."""
    shared = folded.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = place(shared.value, unit(_matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["key", "vec", "ids", "leaf"])

    kind = dict(folded.dtypes)["ids"]
    schema = f"key long, vec array<double>, ids {kind}, leaf int"
    return cut_lineage(map_batches(folded.select("key", "vec", "ids"), run, schema))


def true_leaves(index: DataFrame, points: np.ndarray, keys: list[int], k: int) -> list[list[int]]:
    """The leaves of the ``k`` nearest other vectors of some points, by a scan of all rows."""
    shared = index.sparkSession.sparkContext.broadcast((points, np.array(keys)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, own = shared.value
        score = np.zeros((len(points), 0))
        leaf = np.zeros((len(points), 0), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            new = points @ unit(_matrix(batch.column(1))).T
            new[own[:, None] == batch.column(0).to_numpy()[None, :]] = -np.inf
            leaves = np.broadcast_to(batch.column(2).to_numpy(), new.shape)
            score, leaf = np.hstack([score, new]), np.hstack([leaf, leaves])
            best = np.argsort(-score, axis=1, kind="stable")[:, :k]
            score, leaf = np.take_along_axis(score, best, 1), np.take_along_axis(leaf, best, 1)
        point, at = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays(
            [pa.array(point), pa.array(score[point, at]), pa.array(leaf[point, at])], ["point", "score", "leaf"]
        )

    found = map_batches(index.select("key", "vec", "leaf"), run, "point long, score double, leaf long")
    order = Window.partitionBy("point").orderBy(F.desc("score"), "leaf")
    best = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
    truth: list[list[int]] = [[] for _ in keys]
    for row in best.select("point", "leaf").collect():
        truth[row["point"]].append(row["leaf"])
    return truth


def calibrate(index: DataFrame, queries: DataFrame, tree: Tree, k: int, recall: float) -> int:
    """Leaf visits that find ``recall`` of the true neighbours of a draw of the queries."""
    share = -(-queries.count() // CALIBRATION)
    some = queries.where(F.pmod(F.xxhash64("vec", F.lit(SEED + 1)), F.lit(max(1, share))) == 0)
    rows = some.select("key", "vec").collect()
    if not rows:
        rows = queries.select("key", "vec").limit(CALIBRATION).collect()
    points = unit(np.array([r["vec"] for r in rows]))
    return widen(tree, points, true_leaves(index, points, [r["key"] for r in rows], k), recall)


def layout(index: DataFrame, leaves: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each leaf its first group, and over how many groups it is dealt out."""
    most = max(1, BLOCK_VALUES // size)
    counts = np.zeros(leaves, dtype=np.int64)
    for row in index.groupBy("leaf").agg(F.count("*").alias("n")).collect():  # the tree bounds the leaves
        counts[row["leaf"]] = row["n"]
    first, parts, group, held = np.zeros(leaves, np.int64), np.ones(leaves, np.int64), 0, 0
    for leaf, count in enumerate(counts.tolist()):
        if held and held + count > most:
            group, held = group + 1, 0
        first[leaf], parts[leaf] = group, max(1, -(-count // most))
        if parts[leaf] > 1:
            group += int(parts[leaf])
        else:
            held += count
    return first, parts


def walked(queries: DataFrame, tree: Tree, leaves: int, first: np.ndarray, parts: np.ndarray) -> DataFrame:
    """``key``, ``vec``, ``group`` and ``seen``: each query once for every group with leaves it visits."""
    shared = queries.sparkSession.sparkContext.broadcast((tree, first, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, first, parts = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                at, groups, seen = [], [], []
                for i, point in enumerate(unit(_matrix(some.column(1)))):
                    by_group: dict[int, list[int]] = {}
                    for leaf, _ in zip(visits(tree, point), range(leaves)):
                        for group in range(int(first[leaf]), int(first[leaf] + parts[leaf])):
                            by_group.setdefault(group, []).append(leaf)
                    at += [i] * len(by_group)
                    groups += by_group
                    seen += by_group.values()
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).take(pa.array(at)), some.column(1).take(pa.array(at)),
                        pa.array(groups, pa.int64()), pa.array(seen, pa.list_(pa.int32())),
                    ],
                    ["key", "vec", "group", "seen"],
                )

    return map_batches(queries.select("key", "vec"), run, "key long, vec array<double>, group long, seen array<int>")


def _nearest(k: int, kind: str):
    """Of every share of a group's queries, the best ``k`` rows of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, asked, seen, base, ids, leaf = (batch.column(c)[i].values for c in range(6))
                asked, base = _matrix(asked), _matrix(base)
                leaves, local = np.unique(leaf.to_numpy(), return_inverse=True)
                # which of the group's leaves each query visits; an empty leaf has no row here
                wanted = seen.flatten().to_numpy()
                place = np.minimum(np.searchsorted(leaves, wanted), len(leaves) - 1)
                query = np.repeat(np.arange(len(asked)), np.diff(seen.offsets.to_numpy()))
                visited = np.zeros((len(asked), len(leaves)), dtype=bool)
                visited[query, place] = leaves[place] == wanted
                rough = unit(asked) @ unit(base).T
                rough[~visited[:, local]] = -np.inf
                kth = np.full(len(asked), -np.inf)
                if rough.shape[1] > k:
                    kth = np.partition(rough, rough.shape[1] - k, axis=1)[:, -k] - 1e-9
                query, row = np.nonzero((rough >= kth[:, None]) & (rough > -np.inf))
                if not len(query):
                    continue
                score = cosine(asked[query], base[row])
                sizes = np.diff(ids.offsets.to_numpy())
                begin = np.cumsum(sizes) - sizes
                each = sizes[row]
                at = np.repeat(begin[row] - np.cumsum(each) + each, each) + np.arange(each.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(np.repeat(query, each))),
                        ids.flatten().take(pa.array(at)),
                        pa.array(np.repeat(score, each)),
                    ],
                    ["key", "id", "score"],
                )

    return run, f"key long, id {kind}, score double"


def search_groups(
    index: DataFrame, asked: DataFrame, first: np.ndarray, parts: np.ndarray, size: int, k: int
) -> DataFrame:
    """``key``, ``id`` and ``score``: the best ``k`` rows of every query in the leaves it visits."""
    most = max(1, BLOCK_VALUES // size)
    spark = index.sparkSession
    # one row per leaf and one per group: the tree bounds the former, the blocks the latter
    places = spark.createDataFrame(
        list(zip(range(len(first)), first.tolist(), parts.tolist())), "leaf int, first long, parts long"
    )
    shares = asked.groupBy("group").agg(F.ceil(F.count("*") / most).cast("int").alias("shares"))
    group = F.col("first") + F.pmod(F.xxhash64("key"), "parts")
    base = (
        index.join(F.broadcast(places), "leaf")
        .groupBy(group.alias("group"))
        .agg(*[F.collect_list(c).alias(n) for c, n in (("vec", "base"), ("ids", "ids"), ("leaf", "leaf"))])
        .join(shares, "group")
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        .drop("shares")
    )
    wanted = (
        asked.join(shares, "group")
        .groupBy("group", F.pmod(F.xxhash64("key"), "shares").alias("share"))
        .agg(*[F.collect_list(c).alias(n) for c, n in (("key", "keys"), ("vec", "asked"), ("seen", "seen"))])
    )
    pairs = wanted.join(base, ["group", "share"]).select("keys", "asked", "seen", "base", "ids", "leaf")
    kind = dict(index.dtypes)["ids"].removeprefix("array<").removesuffix(">")
    found = map_batches(pairs, *_nearest(k, kind))
    order = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    return found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    recall: float = RECALL, leaf_size: int = LEAF,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id`` and ``score``: the ``k`` nearest found of each query.

    ``is_query`` is a condition on the column ``id``; the other rows are searched, too.
    """
    rows = cut_lineage(usable(vectors, id_col, vector_col))
    kind = dict(rows.dtypes)["id"]
    one = rows.select("vec").first()
    if one is None:
        return vectors.sparkSession.createDataFrame([], f"query_id {kind}, rank int, id {kind}, score double")
    size = len(one["vec"])
    folded = fold(rows, k + 1)
    tree = fit(folded, folded.count(), size, leaf_size)
    index = placed(folded, tree)
    queries = rows.where(is_query).select("id", "vec").distinct()
    named = cut_lineage(queries.join(index.select("vec", "key"), "vec").select("id", "key"))
    points = cut_lineage(index.join(named.select("key").distinct(), "key", "left_semi"))
    leaves = calibrate(index, points, tree, k, recall)
    first, parts = layout(index, int(tree.leaf.max()) + 1, size)
    asked = cut_lineage(walked(points, tree, leaves, first, parts))
    best = search_groups(index, asked, first, parts, size, k + 1)
    lists = best.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("away"), "id", "score"))).alias("found")
    )
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (
        named.withColumnRenamed("id", "query_id")
        .join(lists, "key")
        .select("query_id", F.posexplode(others).alias("at", "f"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("f.id").alias("id"), F.col("f.score").alias("score"))
    )
