"""Trees with drawn thresholds, against trees grown row by row."""

from __future__ import annotations

import pickle
import random

import numpy as np
import pytest

from caseloom.checks.all import QUERIES, SQL
from caseloom.operators import models, random_trees
from conftest import SMALL
from harness import connect, differences

COLS = ["a", "b", "c", "same"]


def some_rows(n=300):
    rng = random.Random(9)
    rows = []
    for _ in range(n):
        a, b, c = rng.uniform(0, 1), float(rng.randint(0, 3)), rng.gauss(0, 5)
        rows.append((int(a + b / 3 + rng.gauss(0, 0.1) > 1), a, b, c, 7.0))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "y int, a double, b double, c double, same double")


def by_hand(rows, tree, node, depth, number, seed):
    """(node, column, threshold) of a tree grown by recursion."""
    ones = sum(r[0] for r in rows)
    bad = lambda part: 2 * sum(r[0] for r in part) * sum(1 - r[0] for r in part) / len(part)
    if not depth or ones in (0, len(rows)):
        return []
    order = sorted(range(len(COLS)), key=lambda c: random_trees.drawn(seed, tree, node, c, "column"))
    varied = [c for c in order if len({r[c + 1] for r in rows}) > 1][:number]
    tried = []
    for c in sorted(varied):
        low, high = min(r[c + 1] for r in rows), max(r[c + 1] for r in rows)
        cut = low + random_trees.drawn(seed, tree, node, c, "threshold") * (high - low)
        left, right = [r for r in rows if r[c + 1] <= cut], [r for r in rows if r[c + 1] > cut]
        tried.append((bad(rows) - bad(left) - bad(right), -c, cut, left, right))
    if not tried:
        return []
    _, c, cut, left, right = max(tried, key=lambda t: t[:2])
    return (
        [(node, COLS[-c], cut)]
        + by_hand(left, tree, 2 * node, depth - 1, number, seed)
        + by_hand(right, tree, 2 * node + 1, depth - 1, number, seed)
    )


def test_same_trees_as_by_hand(spark):
    rows = some_rows()
    model = random_trees.fit(frame(spark, rows).repartition(5), COLS, "y", trees=6, depth=4, columns=2, seed=3)
    for t, tree in enumerate(model.trees):
        found = sorted((i, COLS[n.cut.col], n.cut.threshold) for i, n in tree.items() if n.cut)
        assert found == sorted(by_hand(rows, t, 1, 4, 2, 3))


def test_same_trees_whatever_the_partitions(spark):
    df = frame(spark, some_rows())
    one = models.extra_trees(df.coalesce(1), COLS, "y", trees=5)
    assert one == models.extra_trees(df.repartition(11), COLS, "y", trees=5)
    assert one != models.extra_trees(df, COLS, "y", trees=5, seed=1)


def test_scores_and_importances(spark):
    df = frame(spark, some_rows())
    model = models.extra_trees(df, COLS, "y", trees=30)
    scored = models.with_scores(model, df).collect()
    right = np.mean([(r.p_positive >= 0.5) == r.y for r in scored])
    assert right > 0.85 and all(0 <= r.p_positive <= 1 for r in scored)
    ranking = models.rank_importance(model, COLS, df).orderBy("rank").collect()
    assert {r.feature for r in ranking[:2]} == {"a", "b"}
    assert (ranking[-1].feature, ranking[-1].importance) == ("same", 0.0)
    assert sum(r.importance for r in ranking) == pytest.approx(1)


def test_nothing_to_split(spark):
    for rows in ([], [(1, 0.0, 0.0, 0.0, 7.0)] * 5, [(i % 2, 1.0, 1.0, 1.0, 7.0) for i in range(6)], [(None, 1.0, 2.0, 3.0, 7.0)]):
        df = frame(spark, rows)
        model = models.extra_trees(df, COLS, "y", trees=3)
        assert model.splits == 0 and model.importances() == [0.0] * 4
        told = {r.prediction for r in model.transform(df).collect()}
        assert told <= {0.0, 0.5, 1.0} and len(told) <= 1


def test_a_missing_value_is_an_error(spark):
    df = frame(spark, [(1, None, 0.0, 0.0, 7.0), (0, 1.0, 0.0, 0.0, 7.0)])
    with pytest.raises(Exception, match="missing value"):
        models.extra_trees(df, COLS, "y", trees=1)


def test_a_threshold_lies_below_the_largest_value():
    assert random_trees.threshold(1.0, np.nextafter(1.0, 2), 0.9999) == 1.0
    assert random_trees.threshold(0.0, 10.0, 0.25) == 2.5


@pytest.mark.parametrize("name", ["threshold", "impurity"])
def test_other_thresholds_or_gains_are_noticed(spark, monkeypatch, name):
    other = {"threshold": lambda low, high, share: float(low + (high - low) / 2), "impurity": lambda n, ones: float(min(ones, n - ones))}
    monkeypatch.setattr(random_trees, name, other[name])
    query = "extra_trees_first_levels"
    assert differences(QUERIES[query](spark, SMALL), connect(SMALL), SQL[query])


def test_nodes_measure_the_columns_they_draw(spark, monkeypatch):
    """A node measures few of many columns; all of them only where those do not vary enough."""
    rng = random.Random(4)
    names = [f"c{i}" for i in range(16)]
    rows = []
    for _ in range(400):
        kind = rng.randrange(8)
        flags = [float(kind == i % 8) for i in range(15)]
        rows.append((int(kind in (1, 2) or rng.random() < 0.2), *flags, rng.random()))
    df = spark.createDataFrame(rows, "y int, " + ", ".join(f"{c} double" for c in names)).repartition(3)
    asked, measure = [], random_trees._ranges

    def spied(rows, cols, trees, wanted):
        asked.append(sum(len(places) for nodes in wanted for places in nodes.values()))
        return measure(rows, cols, trees, wanted)

    monkeypatch.setattr(random_trees, "_ranges", spied)
    grow = lambda: models.extra_trees(df, names, "y", trees=4, depth=4, columns=3)
    monkeypatch.setattr(random_trees, "SPARE", 16)
    whole, all_asked = grow(), asked.copy()
    asked.clear()
    monkeypatch.setattr(random_trees, "SPARE", 1)
    assert grow() == whole and len(asked) > len(all_asked)
    asked.clear()
    monkeypatch.setattr(random_trees, "SPARE", 2)
    assert grow() == whole and sum(asked) < sum(all_asked)
    assert all_asked[0] == 16


def test_tasks_get_splits_without_types_of_the_package(spark):
    model = models.extra_trees(frame(spark, some_rows()), COLS, "y", trees=2)
    assert model.splits and b"caseloom" not in pickle.dumps(random_trees.plain(model.trees))
