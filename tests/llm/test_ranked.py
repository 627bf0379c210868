"""Ranked search against the formula, and the reads of the NRA method."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

import brute
from caseloom.llm import ranked
from test_llm import PROSE, ROWS, SCHEMA, bag, docs, nothing  # noqa: F401

ITEMS = [
    (1, PROSE), (2, "the the fox"), (3, "no such thing anywhere"), (4, None), (5, ""), (6, "a b c"), (None, "word two"),
    (7, "漢字 é"), (8, "X" * 70_000), (2, "the the fox"), (9, "fox"), (9, "dog"), (10, "... !!!"),
]
ITEM_SCHEMA = "item_id long, text string"


def best(rows, items, k=20):
    """Result rows by the formula; documents of equal id are in any order."""
    texts = [(i, brute.WORD.findall(brute.small(t or ""))) for i, t in rows]
    texts = [(i, Counter(w), len(w)) for i, w in texts if w]
    big_n, big_l = len(texts), sum(n for _, _, n in texts)
    df = Counter(t for _, tf, _ in texts for t in tf)
    found = []
    for name, text in set(items):
        asked = Counter(brute.WORD.findall(brute.small(text or "")))
        scores = []
        for i, tf, n in texts:
            m = 100 - 25 + (25 * n * big_n) // big_l
            score = sum(
                r * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 12 * m))
                for t, r in asked.items() if t in tf
            )
            if score:
                scores.append((-score, i is None, i or 0, i))
        found += [(name, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k])]
    return found


@pytest.mark.parametrize("segment", [1, 60, 2_000_000])
@pytest.mark.parametrize("k", [1, 3, 20])
def test_against_the_formula(spark, docs, segment, k):  # noqa: F811
    items = spark.createDataFrame(ITEMS, ITEM_SCHEMA)
    got = ranked.search(docs, items, k, segment_tokens=segment, block_bytes=100 if segment == 60 else 1 << 20)
    assert bag(tuple(r) for r in got.collect()) == bag(best(ROWS, ITEMS, k))


def test_random_texts_with_ties(spark):
    random.seed(11)
    words = [f"w{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(30)]
    rows = [(i, " ".join(random.choices(words, weights, k=random.randint(1, 12)))) for i in range(2000)]
    rows += [(5000 + i, rows[i % 5][1]) for i in range(700)]  # groups of copies
    items = [(i, " ".join(random.choices(words, weights, k=random.randint(1, 25)))) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = ranked.search(df, spark.createDataFrame(items, ITEM_SCHEMA), segment_tokens=1500)
    assert bag(tuple(r) for r in got.collect()) == bag(best(rows, items))


def test_empty_tables(spark, docs, nothing):  # noqa: F811
    items = spark.createDataFrame(ITEMS, ITEM_SCHEMA)
    none = spark.createDataFrame([], ITEM_SCHEMA)
    assert ranked.search(nothing, items).count() == ranked.search(docs, none).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ")], SCHEMA)
    assert ranked.search(blank, items).count() == 0
    assert ranked.search(docs, items).dtypes == [("item_id", "bigint"), ("rank", "int"), ("id", "bigint"), ("score", "bigint")]


def lists_of(random, count, sizes):
    made = []
    for size in sizes:
        found = np.sort(random.choice(count, size, replace=False))
        impact = np.maximum(1, (1000 * random.pareto(1.0, size)).astype(np.int64))
        order = np.argsort(-impact, kind="stable")
        made.append((found[order], impact[order]))
    return made


@pytest.mark.parametrize("seed", range(12))
def test_reads_until_everything_is_settled(seed):
    random = np.random.default_rng(seed)
    count = 3000
    lists = lists_of(random, count, random.integers(1, count, size=random.integers(1, 8)))
    total = np.zeros(count, dtype=np.int64)
    for found, impact in lists:
        total[found] += impact
    order = np.lexsort((np.arange(count), -total))
    for k, threshold in ((1, 0), (20, 0), (20, int(total[order[10]])), (count, 0)):
        want = [d for d in order.tolist() if total[d] >= max(1, threshold)][:k]
        found, score, _ = ranked.nra(lists, count, k, threshold, first=8)
        assert found.tolist() == want and score.tolist() == total[want].tolist()


def test_stops_before_the_ends_of_the_lists():
    count = 100_000
    impact = np.concatenate(([10**9] * 20, np.arange(count - 20, 0, -1)))
    lists = [(np.arange(count), impact), (np.concatenate((np.arange(20)[::-1], np.arange(20, count))), impact)]
    found, score, reads = ranked.nra(lists, count, 20)
    assert found.tolist() == list(range(20)) and set(score.tolist()) == {2 * 10**9}
    assert reads <= 2 * ranked.FIRST_READ
