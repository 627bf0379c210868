"""Nearest neighbours through the tree against a comparison of all rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import vector_tree
from caseloom.llm.queries import LLM_QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_query, k):
    """Neighbours of every query by definition; rows that take no part are left out."""
    whole = [
        (i, np.array(v, dtype=np.float64))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    lengths = [len(v) for _, v in whole]
    size = min(set(lengths), key=lambda n: (-lengths.count(n), n)) if lengths else 0
    whole = list({(i, v.tobytes()): (i, v) for i, v in whole if len(v) == size}.values())
    found = {}
    for q, v in whole:
        if is_query(q):
            scores = [(-float(v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w))), i) for i, w in whole if i != q]
            found[q] = [(i, -s) for s, i in sorted(scores, key=lambda x: (round(x[0], 12), x[1]))[:k]]
    return found


def lists(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        own = found.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["id"], r["score"]))
    return found


def recall(found, truth):
    hit = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in own}) for q, own in truth.items())
    return hit / max(1, sum(map(len, truth.values())))


def sound(found, rows, k):
    """Scores are exact and in order, ties by id, no row its own neighbour."""
    vectors = {i: np.array(v, dtype=np.float64) for i, v in rows if i is not None and v}
    for q, own in found.items():
        assert len(own) <= k and q not in [i for i, _ in own]
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        for i, score in own:
            v, w = vectors[q], vectors[i]
            assert score == pytest.approx(v @ w / math.sqrt((v @ v) * (w @ w)), abs=1e-12)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_recall_on_given_vectors(spark, folder):
    path = f"/root/testdata/{folder}"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    found = lists(LLM_QUERIES["op12_nearest_neighbours"](spark, path).withColumnRenamed("vec_id", "id"))
    truth = brute(rows, lambda i: i % 50 == 0, 5)
    assert set(found) == set(truth) and all(len(f) == 5 for f in found.values())
    assert recall(found, truth) >= 0.9
    sound(found, rows, 5)


def test_full_recall_is_brute_force(spark):
    random = np.random.default_rng(5)
    points = random.normal(size=(700, 6)).round(3)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(1000 + i, points[3].tolist()) for i in range(40)]  # more copies than neighbours asked for
    rows += [(2000 + i, (2 * points[4]).tolist()) for i in range(3)]  # parallel, not equal
    rows += rows[:30]  # repeated rows
    df = spark.createDataFrame([(i, p, 0) for i, p in rows], "vec_id long, embedding array<double>, label int")
    found = lists(vector_tree.nearest(df.repartition(5), F.col("id") % 7 == 0, 4, recall=1.0))
    truth = brute(rows, lambda i: i % 7 == 0, 4)
    assert set(found) == set(truth)
    assert recall(found, truth) >= 0.99
    sound(found, rows, 4)
    copies = [1000 + i for i in range(40)]
    for q in (1001, 1008, 1036):  # copies of one vector: the smallest ids but the query's own
        if q % 7 == 0:
            assert [i for i, _ in found[q]] == [i for i in [3, *copies] if i != q][:4]


def test_awkward_rows(spark):
    rows = [
        (0, None), (50, [0.0, 0.0]), (100, [1.0, None]), (150, [float("nan"), 1.0]), (200, [float("inf"), 1.0]),
        (250, []), (300, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (350, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [2.0, 1.0]),
        (3, [-1.0, 0.0]), (400, [1e-30, 1e-30]), (4, [1e30, 1e30]), (350, [1.0, 0.0]), (450, [-0.0, 1.0]), (5, [0.0, 1.0]),
    ]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    df = df.select(F.lit(1).alias("id"), F.lit("x").alias("key"), "vec_id", F.lit(0).alias("VEC"), "embedding", F.lit(9).alias("leaf"))
    found = lists(vector_tree.nearest(df, F.col("id") % 50 == 0, 5, recall=1.0))
    truth = brute(rows, lambda i: i % 50 == 0, 5)
    assert set(found) == set(truth) == {350, 400, 450}
    for q in truth:  # 4 and 400 point the same way, but for rounding
        near = [sorted((round(-s, 12), i) for i, s in own) for own in (found[q], truth[q])]
        assert near[0] == near[1]


def test_small_tables(spark):
    for rows in ([], [(0, [1.0, 2.0], 1)], [(0, None, 1)]):
        assert vector_tree.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0).count() == 0
    pair = spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1)], SCHEMA)
    assert lists(vector_tree.nearest(pair, F.col("id") % 50 == 0)) == {0: [(1, pytest.approx(1.0))]}
    # all rows alike
    same = spark.createDataFrame([(i, [3.0, 4.0], 1) for i in range(500)], SCHEMA)
    found = lists(vector_tree.nearest(same, F.col("id") % 50 == 0))
    assert len(found) == 10 and all([i for i, _ in own] == [i for i in range(6) if i != q][:5] for q, own in found.items())
    # ids of another type
    text = spark.createDataFrame([(chr(97 + i), [float(i), 1.0], 1) for i in range(9)], "vec_id string, embedding array<float>, label int")
    assert [i for i, _ in lists(vector_tree.nearest(text, F.col("id") == "a", 2))["a"]] == ["b", "c"]


def test_the_tree(spark):
    random = np.random.default_rng(1)
    points = vector_tree.unit(random.normal(size=(3000, 12)))
    tree = vector_tree.grow(points)
    leaves = vector_tree.place(tree, points)
    assert set(leaves.tolist()) == set(range(tree.leaf.max() + 1))
    for p, leaf in zip(points[:50], leaves):
        order = list(vector_tree.visits(tree, p))
        assert order[0] == leaf and sorted(order) == list(range(tree.leaf.max() + 1))
    # visits widen with the recall asked for
    truth = [[int(leaves[j]) for j in np.argsort(-(points @ p))[1:6]] for p in points[:60]]
    few, many, every = (vector_tree.widen(tree, points[:60], truth, r) for r in (0.3, 0.9, 1.0))
    assert 1 <= few < many < every <= tree.leaf.max() + 1
    seen = [set(x for x, _ in zip(vector_tree.visits(tree, p), range(many))) for p in points[:60]]
    assert sum(leaf in s for s, own in zip(seen, truth) for leaf in own) >= 0.9 * 300


def test_blocks_of_a_busy_leaf_are_spread(spark, monkeypatch):
    monkeypatch.setattr(vector_tree, "BLOCK_VALUES", 64)
    random = np.random.default_rng(8)
    rows = [(i, random.normal(size=4).round(4).tolist()) for i in range(900)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    found = lists(vector_tree.nearest(df, F.col("id") % 3 == 0, 5, leaf_size=10_000))  # one leaf
    truth = brute(rows, lambda i: i % 3 == 0, 5)
    assert {q: [i for i, _ in own] for q, own in found.items()} == {q: [i for i, _ in own] for q, own in truth.items()}
