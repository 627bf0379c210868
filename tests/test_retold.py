"""Scores retold from saved tree nodes, all rows of a batch at a time."""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
import pytest

from caseloom.checks import learning


def saved(rng: np.random.Generator, depth: int, width: int) -> pd.DataFrame:
    """Nodes of one tree as Spark ML saves them, in no order; leaves have no split."""
    rows, number = [], [0]

    def grow(level: int) -> int:
        i, number[0] = number[0], number[0] + 1
        leaf = level == depth or level > 0 and rng.random() < 0.2
        left, right = (-1, -1) if leaf else (grow(level + 1), grow(level + 1))
        cut = {"featureIndex": -1, "leftCategoriesOrThreshold": []} if leaf else {
            "featureIndex": int(rng.integers(width)), "leftCategoriesOrThreshold": [float(rng.integers(10))]
        }
        stats = rng.integers(1, 50, 2).astype(float).tolist()
        rows.append((i, float(rng.normal()), stats, left, right, cut))
        return i

    grow(0)
    names = ["id", "prediction", "impurityStats", "leftChild", "rightChild", "split"]
    return pd.DataFrame(rows, columns=names).sample(frac=1.0, random_state=1)


def told(nodes: pd.DataFrame, point: np.ndarray, forest: bool) -> float:
    nodes = nodes.set_index("id")
    node = nodes.loc[0]
    while node["leftChild"] >= 0:
        low = point[node["split"]["featureIndex"]] <= node["split"]["leftCategoriesOrThreshold"][0]
        node = nodes.loc[node["leftChild"] if low else node["rightChild"]]
    return node["impurityStats"][1] / sum(node["impurityStats"]) if forest else node["prediction"]


@pytest.mark.parametrize("forest", [True, False])
@pytest.mark.parametrize("depth", [0, 1, 5])
def test_a_batch_walks_as_its_rows_do(forest, depth):
    rng = np.random.default_rng(depth)
    nodes = saved(rng, depth, 4)
    points = rng.integers(0, 10, (60, 4)).astype(float)
    points[::7, 1] = np.nan
    walked = learning._walked(learning._node_values(nodes, forest), points)
    assert walked.tolist() == [told(nodes, p, forest) for p in points]


def test_many_rows_do_not_walk_one_by_one():
    rng = np.random.default_rng(3)
    tree = learning._node_values(saved(rng, 5, 4), True)
    points = rng.integers(0, 10, (200_000, 4)).astype(float)
    begun = time.process_time()
    assert len(learning._walked(tree, points)) == 200_000
    assert time.process_time() - begun < 5  # row by row: about a minute
