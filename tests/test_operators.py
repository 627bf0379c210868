"""Properties and equivalences of the operators, on small tables made for the purpose."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from caseloom.operators import aggregates as ag
from caseloom.operators import merge, metrics, models, neighbors, prep, quantiles, ranking, resample
from caseloom.checks.aggregates import panel_by_joins
from caseloom.operators.aggregates import Measure


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# --- Aggregates and merges --------------------------------------------------


def test_consistent_label(spark):
    rows = [
        ("one", "X"), ("same", "X"), ("same", "X"), ("two", "X"), ("two", "Y"),
        ("none", None), ("gap", None), ("gap", "X"), (None, "X"),
    ]
    df = spark.createDataFrame(rows, "id string, v string")
    assert pairs(ag.consistent_label(df, "id", "v"), "id", "v") == [
        ("gap", "X"), ("one", "X"), ("same", "X")
    ]
    both = ag.consistent_label(df, "id", "v", keep_null_rows=True).collect()
    assert sorted((r.id, r.v or "") for r in both) == [
        ("gap", ""), ("gap", "X"), ("one", "X"), ("same", "X")
    ]


def test_panel_equals_joins(spark):
    rng = random.Random(1)
    rows = [
        (rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", "z"]),
         rng.choice([None, rng.uniform(0, 200)]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "id string, m string, v double")
    specs = [Measure("x", "X"), Measure("y", "Y", ("min", "mean"), high=100), Measure("q", "Q")]
    wide = ag.panel(df, "id", "m", "v", specs)
    chain = panel_by_joins(df, "id", "m", "v", specs).select(*wide.columns)
    assert sorted(map(repr, wide.collect())) == sorted(map(repr, chain.collect()))


def test_merges(spark):
    a = spark.createDataFrame([("p", 1), ("q", 2)], "id string, a int")
    b = spark.createDataFrame([("q", "x"), ("r", None), (None, "z")], "id string, b string")
    assert pairs(merge.merge_outer([a, b], "id"), "id", "a", "b") == [
        ("p", 1, None), ("q", 2, "x"), ("r", None, None)
    ]
    assert pairs(merge.merge_inner([a, b], "id"), "id", "a", "b") == [("q", 2, "x")]
    twice = a.unionByName(a)
    with pytest.raises(Exception, match="more than one row in a source"):
        merge.merge_outer([twice, b], "id").collect()
    with pytest.raises(ValueError, match="two tables"):
        merge.merge_outer([a, a], "id")


def test_vocabulary_ties_and_weights(spark):
    rows = [("b", 1), ("a", 1), ("c", None), ("c", None), ("c", 1), ("d", 1), ("d", 1)]
    df = spark.createDataFrame(rows, "w string, id int")
    assert ag.vocab_values(ag.top_k_vocab(df, "w", 3)) == ["c", "d", "a"]
    assert ag.vocab_values(ag.top_k_vocab(df, "w", 3, "id")) == ["d", "a", "b"]
    assert ag.vocab_values(ag.top_k_vocab(df, "w", 3, exclude=F.col("w") == "c")) == ["d", "a", "b"]
    with pytest.raises(ValueError, match="more than 2"):
        ag.vocab_values(ag.top_k_vocab(df, "w", 3), most=2)


def test_dedup_ratio_with_a_crowd_of_copies(spark):
    df = spark.range(900).select((F.col("id") % 3).alias("a"), F.lit(None).cast("int").alias("b"))
    row = ag.dedup_ratio(df).first()
    assert (row.rows, row.distinct_rows) == (900, 3)


# --- Quantiles --------------------------------------------------------------


@pytest.mark.parametrize("short", [quantiles.SHORT, 0])
def test_quantiles_on_both_paths(spark, short):
    rng = np.random.default_rng(3)
    spread = rng.normal(size=3000)
    crowd = np.where(rng.random(3000) < 0.4, 7.0, rng.integers(0, 50, 3000))
    rare = [float(v) if i % 300 == 0 else None for i, v in enumerate(spread)]
    wild = np.where(rng.random(3000) < 0.5, 1, -1) * 10.0 ** rng.integers(-300, 300, 3000)
    rows = [
        (float(a), float(b), c, None, math.nan, float(w))
        for a, b, c, w in zip(spread, crowd, rare, wild)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(5)
    levels = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.exact_quantiles(df, ["a", "b", "c", "d", "e", "f"], levels, short)
    for name, values in (("a", spread), ("b", crowd), ("c", [v for v in rare if v is not None])):
        assert got[name] == pytest.approx(list(np.quantile(values, levels)), abs=1e-12)
    assert got["d"] == got["e"] == [None] * 5
    assert got["f"] == pytest.approx(list(np.quantile(wild, levels)), rel=1e-12)


def test_doubles_in_the_order_of_their_bits():
    values = np.array([-np.inf, -1e300, -1.5, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.0 + 2**-52, 1e300, np.inf])
    coded = quantiles.sortable(values)
    assert (np.diff(coded.astype(object)) > 0).all()
    assert [quantiles.from_sortable(int(c)) for c in coded] == values.tolist()
    assert quantiles.sortable(np.array([-0.0])) == quantiles.sortable(np.array([0.0]))


def test_counts_of_a_pass_are_bounded(spark):
    """Whatever the rows: no column and rank has more than 65,536 counts, shared digits fewer."""
    df = spark.range(200_000).select((F.col("id") * 0.37 + 1000).alias("x"), (F.col("id") % 3).cast("double").alias("z"))
    first = quantiles.digit_counts(df, {0: {0}, 1: {0}}, 0)
    sizes = {r["column"]: (r["rows"], r["n"]) for r in first.groupBy("column").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()}
    assert sizes[1] == (3, 200_000) and sizes[0][1] == 200_000 and sizes[0][0] <= 1 << 16
    whole = df.toPandas()
    got = quantiles.exact_quantiles(df, ["x", "z"], [0.1, 0.5, 0.99])
    assert got["x"] == pytest.approx(list(whole["x"].quantile([0.1, 0.5, 0.99])), rel=1e-12)
    assert got["z"] == [0.0, 1.0, 2.0]


def test_ranks_are_found_in_few_passes(spark, monkeypatch):
    """The first pass finds crowded values, the second, over the other columns alone, the rest."""
    n = 120_000
    df = spark.range(n).select(
        (F.col("id") % 3).cast("double").alias("few"), (F.col("id") * 0.37 - 1000).alias("spread"),
        (F.col("id") % 90).cast("double").alias("whole"), F.when(F.col("id") < 5, -F.col("id") / 3).alias("rare"),
        F.lit(None).cast("double").alias("none"),
    )
    passes, count = [], quantiles.digit_counts

    def spied(numbers, known, *rest):
        passes.append(sorted(known))
        return count(numbers, known, *rest)

    monkeypatch.setattr(quantiles, "digit_counts", spied)
    levels = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = quantiles.exact_quantiles(df, df.columns, levels)
    assert passes == [[0, 1, 2, 3, 4], [1, 2]]
    whole = df.toPandas()
    for name in ("few", "spread", "whole", "rare"):
        assert got[name] == pytest.approx(list(whole[name].quantile(levels)), rel=1e-12)
    assert got["none"] == [None] * 5


def test_copies_of_a_hot_row_are_spread(spark, monkeypatch):
    monkeypatch.setattr(prep, "COPY_RUN", 50)
    df = spark.createDataFrame([(1, 4003), (2, 0), (3, 1), (4, 50), (5, 51)], "k bigint, _copies int")
    made = prep.with_copies(df, "k", "n").withColumn("task", F.spark_partition_id()).cache()
    for k, n in ((1, 4003), (3, 1), (4, 50), (5, 51)):
        assert sorted(r["n"] for r in made.where(F.col("k") == k).collect()) == list(range(1, n + 1))
    assert made.where("k = 2").count() == 0
    tasks = [r["count"] for r in made.where("k = 1").groupBy("task").count().collect()]
    assert len(tasks) >= 6 and max(tasks) < 0.4 * 4003


# --- Order, sampling, splits ------------------------------------------------


def test_split_and_folds_ignore_partitioning(spark):
    df = spark.range(2000).select(
        F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("y")
    )
    shuffled = df.repartition(13, "y")
    for make in (
        lambda d: prep.hash_split(d, "k", 0.33, 42).select("k", "held_out"),
        lambda d: prep.stratified_folds(d, "k", "y", 10, 37).select("k", "fold"),
        lambda d: prep.downsample(d, "k", "y", 5).select("k", "y"),
    ):
        assert sorted(make(df).collect()) == sorted(make(shuffled).collect())
    folds = prep.stratified_folds(df, "k", "y", 10, 37).groupBy("y", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r.y == label]
        assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1
    share = prep.hash_split(df, "k", 0.33, 42).agg(F.avg("held_out")).first()[0]
    assert abs(share - 0.33) < 0.05
    train, held = prep.split(df, "k", 0.33, 42)
    assert train.count() + held.count() == 2000
    assert train.join(held, "k").count() == 0


@pytest.mark.parametrize("n", [0, 1, 17, 1999, 2000, 5000])
def test_random_sample_is_exact(spark, n):
    drawn = ranking.random_sample(spark.range(2000), "id", n, 3)
    assert drawn.select("id").distinct().count() == min(n, 2000)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("n", [0, 1, 60, 499, 500, 900])
def test_top_rows_equals_sort(spark, descending, n):
    """A third of the rows share one value, and the cut often falls among them."""
    value = F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") % 11 * 1.5)
    df = spark.range(500).select(F.col("id").alias("k"), value.alias("v"))
    got = ranking.top_rows(df, "v", "k", n, descending).collect()
    want = sorted((r.v for r in df.collect()), reverse=descending)[:n]
    assert sorted((r.v for r in got), reverse=descending) == want
    assert len({r.k for r in got}) == len(want)
    again = ranking.top_rows(df.repartition(5), "v", "k", n, descending).collect()
    assert sorted(again) == sorted(got)


def test_oversample_evens_the_classes(spark):
    df = spark.range(101).select(
        F.col("id").alias("k"), (F.col("id") < 7).cast("int").alias("y")
    )
    grown = prep.oversample_random(df, "k", "y", 1)
    assert prep.class_counts(grown, "y") == (94, 94)
    copies = [r["count"] for r in grown.where("y = 1").groupBy("k").count().collect()]
    assert max(copies) - min(copies) <= 1


def test_impute_and_scale(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 5.0, None), (2, None, 5.0, None), (3, 4.0, 5.0, None), (4, math.nan, 5.0, None)],
        "k int, a double, b double, c double",
    )
    filled = prep.median_impute(df, ["a", "c"]).orderBy("k").collect()
    assert [r.a for r in filled] == [1.0, 2.5, 4.0, 2.5]
    assert all(r.c is None for r in filled)
    assert all(r.b == 0.0 for r in prep.standardise(df, ["b"]).collect())


def test_enriched_test_set_leaves_training_rows_out(spark):
    df = spark.range(400).select(
        F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y")
    )
    train, held = prep.split(prep.downsample(df, "k", "y", 1), "k", 0.3, 2)
    test = prep.enrich_test(held, df, train, "k", "y", 100, 4)
    assert test.count() == held.count() + 100
    assert test.join(train, "k").count() == 0
    assert test.select("k").distinct().count() == test.count()


# --- Metrics ----------------------------------------------------------------


def brute_auc(labels, scores):
    wins = [
        (p > n) + 0.5 * (p == n)
        for p, y in zip(scores, labels) if y for n, z in zip(scores, labels) if not z
    ]
    return sum(wins) / len(wins)


def brute_ap(labels, scores):
    total, last = 0.0, 0.0
    for cut in sorted(set(scores), reverse=True):
        shown = [y for y, s in zip(labels, scores) if s >= cut]
        recall = sum(shown) / sum(labels)
        total += (recall - last) * sum(shown) / len(shown)
        last = recall
    return total


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=4, max_size=40))
def test_metrics_against_brute_force(spark, rows):
    labels, scores = [r[0] for r in rows], [float(r[1]) for r in rows]
    if len(set(labels)) < 2:
        return
    df = spark.createDataFrame(list(zip(labels, scores)), "y int, s double")
    assert metrics.roc_auc(df, "y", "s").first().auc == pytest.approx(brute_auc(labels, scores))
    got = metrics.average_precision(df, "y", "s").first().average_precision
    assert got == pytest.approx(brute_ap(labels, scores))


def test_metric_identities(spark):
    df = spark.range(400).select(
        (F.col("id") % 3 == 0).cast("int").alias("y"),
        (F.xxhash64("id") % 50 / 50.0).alias("s"),
        F.lit(0.5).alias("flat"),
    )
    auc = metrics.roc_auc(df, "y", "s").first().auc
    raised = df.withColumn("s", F.exp("s") * 3 + 1)
    assert metrics.roc_auc(raised, "y", "s").first().auc == pytest.approx(auc)
    turned = df.withColumn("s", -F.col("s"))
    assert metrics.roc_auc(turned, "y", "s").first().auc == pytest.approx(1 - auc)
    assert metrics.roc_auc(df, "y", "flat").first().auc == 0.5
    one_class = df.withColumn("y", F.lit(1))
    assert metrics.roc_auc(one_class, "y", "s").first().auc is None


def test_spearman_of_constant_is_nan(spark):
    df = spark.range(50).select("id", (F.col("id") * 2.0).alias("a"), F.lit(1.0).alias("b"))
    rho = {(r.a, r.b): r.rho for r in metrics.spearman(df, ["a", "b"]).collect()}
    assert rho["a", "a"] == pytest.approx(1.0)
    assert math.isnan(rho["a", "b"])


@pytest.mark.parametrize("few_values", [0, 40, 10_000])
def test_spearman_whichever_way_ranks_are_found(spark, few_values):
    rng = np.random.default_rng(6)
    a = rng.normal(size=600)
    table = {"a": a, "b": a + rng.normal(size=600), "c": rng.integers(0, 9, 600), "d": np.where(a > 0, 1.0, -a)}
    frame = pd.DataFrame(table)
    df = spark.createDataFrame(frame).repartition(5)
    rho = {(r.a, r.b): r.rho for r in metrics.spearman(df, list(table), few_values).collect()}
    wanted = frame.rank().corr()
    assert all(rho[x, y] == pytest.approx(wanted.loc[x, y], abs=1e-12) for x in table for y in table)


def test_ranks_of_many_columns_move_together(spark):
    df = spark.range(500).select(*[(F.hash("id", F.lit(i)) * 1.0).alias(f"c{i}") for i in range(7)])
    plan = metrics.rank_rows(df, df.columns, 10)._jdf.queryExecution().optimizedPlan().toString()
    # one join of values with ranks and one grouping by row, not one of either for each column
    assert plan.count("Join ") == 1 and plan.count("Aggregate [row") == 1


# --- Neighbours -------------------------------------------------------------


def cloud(spark, n=160, copies=60, text=False, seed=5):
    """Points in four dimensions; a third of the rows are one and the same point."""
    rng = np.random.default_rng(seed)
    # Quarters square and add up exactly, so equal distances are equal numbers.
    points = ((rng.normal(size=(n, 4)) * 4).round() / 4).tolist() + [[0.5, 0.5, 0.5, 0.5]] * copies
    rows = [
        (f"P{i:04d}" if text else i, int(rng.random() < 0.25), [float(v) for v in p])
        for i, p in enumerate(points)
    ]
    return rows, spark.createDataFrame(
        rows, f"k {'string' if text else 'bigint'}, y int, p array<double>"
    )


def brute_knn(rows, k, farthest=False):
    out = []
    for key, _, p in rows:
        ranked = sorted(
            ((-1 if farthest else 1) * math.dist(p, q), other)
            for other, _, q in rows if other != key
        )
        out += [(key, other, i + 1) for i, (_, other) in enumerate(ranked[:k])]
    return sorted(out)


@pytest.mark.parametrize("text", [False, True])
@pytest.mark.parametrize("farthest", [False, True])
@pytest.mark.parametrize("limit", [neighbors.BROADCAST_VALUES, 0])
def test_knn_against_brute_force(spark, monkeypatch, text, farthest, limit):
    monkeypatch.setattr(neighbors, "CELL_ROWS", 25)
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 40)
    rows, df = cloud(spark, text=text)
    hits = neighbors.knn(df, df, 4, "k", "p", "y", farthest, limit)
    assert pairs(hits, "k", "neighbor", "rank") == brute_knn(rows, 4, farthest)
    place = {key: p for key, _, p in rows}
    label = {key: y for key, y, _ in rows}
    for r in hits.collect():
        assert r.distance == math.dist(place[r.k], place[r.neighbor])
        assert r.neighbor_label == label[r.neighbor]


@pytest.mark.parametrize("text", [False, True])
@pytest.mark.parametrize("farthest", [False, True])
def test_few_queries_scan_the_base_where_it_lies(spark, text, farthest):
    rows, df = cloud(spark, text=text)
    few = df.orderBy("k").limit(12)
    hits = neighbors.knn(few, df.repartition(5), 4, "k", "p", "y", farthest, 100)
    wanted = {r.k for r in few.collect()}
    assert pairs(hits, "k", "neighbor", "rank") == [r for r in brute_knn(rows, 4, farthest) if r[0] in wanted]
    base = df.where("k is not null")
    plan = neighbors.knn(few, base, 4, "k", "p", "y", farthest, 100)._jdf.queryExecution().executedPlan().toString()
    # What is shuffled comes out of the scan: the best of each task.
    assert plan.count("MapInPandas") == 1 and plan.rindex("Exchange") < plan.index("MapInPandas")


def test_cell_search_sends_few_rows_in_low_widths(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "CELL_ROWS", 10)
    points = [(i, [float(i % 40), float(i // 40)]) for i in range(1600)]
    df = spark.createDataFrame(points, "k bigint, p array<double>")
    assert neighbors.knn(df, df, 4, "k", "p", broadcast_values=0).count() == 6400
    rows = neighbors._rows(df, "k", "p", None)
    sent = neighbors.cell_traffic(rows, rows, 5, False, 1600)
    # Sending every row to every cell would be 256,000 rows.
    assert sent["cells"] == 160 and 1600 <= sent["base_rows"] < 30_000


@pytest.mark.parametrize("text", [False, True])
@pytest.mark.parametrize("farthest", [False, True])
def test_search_by_bounds_against_brute_force(spark, monkeypatch, text, farthest):
    monkeypatch.setattr(neighbors, "NARROW", 0)
    monkeypatch.setattr(neighbors, "CELL_ROWS", 40)
    rows, df = cloud(spark, text=text)
    hits = neighbors.knn(df, df, 4, "k", "p", "y", farthest, broadcast_values=0)
    assert pairs(hits, "k", "neighbor", "rank") == brute_knn(rows, 4, farthest)


def test_bounds_leave_few_rows_to_read(spark):
    wide = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = neighbors._rows(wide, "vec_id", "embedding", "label").cache()
    count = rows.count()
    read = neighbors.bounded_candidates(rows, rows, 6, False, count, count, 64).count()
    assert 6 * count <= read <= 0.05 * count * count
    by_bounds = neighbors.knn(wide, wide, 5, "vec_id", "embedding", "label", broadcast_values=1000)
    whole = neighbors.knn(wide, wide, 5, "vec_id", "embedding", "label")
    assert pairs(by_bounds, "vec_id", "neighbor", "rank", "distance") == pairs(whole, "vec_id", "neighbor", "rank", "distance")


SHAPES = {
    "cloud": lambda rng, n, d: rng.standard_normal((n, d)),
    "grid": lambda rng, n, d: rng.integers(0, 3, (n, d)).astype(float),
    "far off": lambda rng, n, d: 1e9 + rng.standard_normal((n, d)),
    "tight clusters": lambda rng, n, d: rng.integers(0, 4, (n, 1)) * 1e6 + 1e-3 * rng.standard_normal((n, d)),
    "tiny": lambda rng, n, d: 1e-25 * rng.standard_normal((n, d)),
    "huge": lambda rng, n, d: 1e30 * rng.standard_normal((n, d)),
    "all equal": lambda rng, n, d: np.ones((n, d)),
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("farthest", [False, True])
def test_best_over_blocks_against_all_pairs(shape, farthest):
    rng = np.random.default_rng(3)
    for d in (1, 64):
        base = SHAPES[shape](rng, 500, d)
        asked = np.vstack([SHAPES[shape](rng, 300, d), base[:40]])
        best = neighbors.Best(asked, 4, farthest)
        for start in range(0, 500, 90):
            best.add(base[start : start + 90])
        wanted = []
        for i, x in enumerate(asked):
            gap = base - x
            distance = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            order = np.lexsort((np.arange(500), -distance if farthest else distance))[:4]
            wanted += [(i, int(j), distance[j]) for j in order]
        assert list(zip(*(a.tolist() for a in best.found()))) == wanted


def test_a_search_by_bounds_hands_on_no_more_than_the_best(spark):
    wide = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = neighbors._rows(wide, "vec_id", "embedding", "label").cache()
    count = rows.count()
    assert neighbors.bounded_candidates(rows, rows, 6, False, count, count, 64).count() == 6 * count


def test_search_by_bounds_keeps_labels_that_are_missing(spark):
    rng = random.Random(5)
    rows = [(i, None if i % 3 else 1, [rng.gauss(0, 1) for _ in range(20)]) for i in range(60)]
    df = spark.createDataFrame(rows, "k bigint, y int, p array<double>")
    hits = neighbors.knn(df, df, 4, "k", "p", "y", broadcast_values=0)
    assert pairs(hits, "k", "neighbor", "rank") == brute_knn(rows, 4)
    assert all(r.neighbor_label == (None if r.neighbor % 3 else 1) for r in hits.collect())


def test_cells_that_need_the_whole_base_are_sent_no_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "CELL_ROWS", 10)
    monkeypatch.setattr(neighbors, "BLOCK_VALUES", 300)
    rng = random.Random(1)
    rows = [(i, i % 2, [rng.gauss(0, 1) for _ in range(20)]) for i in range(200)]
    df = spark.createDataFrame(rows, "k bigint, y int, p array<double>")
    for farthest in (False, True):
        hits = neighbors.knn(df, df, 4, "k", "p", "y", farthest, broadcast_values=0, narrow=20)
        assert pairs(hits, "k", "neighbor", "rank") == brute_knn(rows, 4, farthest)
    taken = neighbors._rows(df, "k", "p", "y")
    assert neighbors.cell_traffic(taken, taken, 5, False, 200)["base_rows"] > neighbors.MOST_COPIES * 200
    plan = neighbors._cell_search(taken, taken, 5, False, 200, 200, 20)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan


@pytest.mark.parametrize("kind", ["double", "decimal(6,2)", "date", "string", "binary"])
@pytest.mark.parametrize("limit", [neighbors.BROADCAST_VALUES, 0, 5])
def test_ids_keep_their_type(spark, kind, limit):
    id_of = F.date_add(F.lit("2020-01-01").cast("date"), F.col("k") * 10) if kind == "date" else F.col("k") + 0.25
    id_of = id_of.cast("string").cast(kind) if kind == "binary" else id_of.cast(kind)
    places = [(0, 0.0), (1, 0.1), (2, 1.0), (3, 1.05), (4, 5.0)]
    df = spark.createDataFrame([(k, 0, [x, 0.0]) for k, x in places], "k int, y int, p array<double>")
    named = df.withColumn("id", id_of)
    names = {r.k: r.id for r in named.collect()}
    found = {r.id: r.neighbor for r in neighbors.knn(named, named, 1, "id", "p", "y", broadcast_values=limit).collect()}
    assert found == {names[a]: names[b] for a, b in {0: 1, 1: 0, 2: 3, 3: 2, 4: 3}.items()}


@pytest.mark.parametrize("limit", [neighbors.BROADCAST_VALUES, 0])
def test_rows_without_a_point_take_no_part(spark, limit):
    rows = [(1, 0, [0.0, 1.0]), (2, 1, [0.0, 2.0]), (3, 0, None), (4, 1, [1.0, None]), (5, 1, [float("nan"), 1.0]),
            (6, 0, [float("inf"), 1.0]), (None, 1, [0.0, 1.1])]
    df = spark.createDataFrame(rows, "k int, y int, p array<double>")
    hits = neighbors.knn(df, df, 3, "k", "p", "y", broadcast_values=limit)
    assert sorted((r.k, r.neighbor) for r in hits.collect()) == [(1, 2), (2, 1)]
    ragged = df.unionByName(spark.createDataFrame([(9, 1, [1.0])], df.schema))
    with pytest.raises(ValueError, match="from 1 to 2"):
        neighbors.knn(df, ragged, 1, "k", "p", "y", broadcast_values=limit)


def test_samplers_with_ids_of_other_types(spark):
    rows, df = cloud(spark, n=60, copies=5)
    for kind in ("decimal(9,1)", "string"):
        own = df.withColumn("k", (F.col("k") + (0.5 if kind != "string" else 0)).cast(kind))
        names = dict(zip([r.k for r in df.orderBy("k").collect()], [r.k for r in own.withColumn("_o", F.col("k").cast("double")).orderBy("_o").collect()]))
        for sampler in (resample.edited_nn, resample.drop_tomek_links):
            wanted = sorted(str(names[r.k]) for r in sampler(df, "k", "y", "p").collect())
            assert sorted(str(r.k) for r in sampler(own, "k", "y", "p").collect()) == wanted
        grown = resample.smote(own, "k", "y", "p")
        assert grown.count() == resample.smote(df, "k", "y", "p").count()


def test_repeated_editing_searches_fewer_rows_each_round(spark):
    _, df = cloud(spark, n=240, copies=10)
    df = df.withColumn("y", (F.col("k") % 11 == 0).cast("int")).cache()
    searched = []
    kept = pairs(resample.repeated_edited_nn(df, "k", "y", "p", searched=searched), "k")
    now, labels = df, None
    while True:  # every round from the start
        edited = resample.edited_nn(now, "k", "y", "p").cache()
        left = edited.where("y = 0").count()
        if left == now.where("y = 0").count() or left < now.where("y = 1").count():
            break
        now = edited
    assert kept == pairs(now, "k")
    assert len(searched) >= 2 and searched[0] == df.where("y = 0").count()
    assert all(b < a for a, b in zip(searched, searched[1:]))


def test_tomek_links_by_all_pairs(spark):
    rows, df = cloud(spark, n=90, copies=20)
    nearest = {a: b for a, b, _ in brute_knn(rows, 1)}
    label = {k: y for k, y, _ in rows}
    links = sorted((c, r) for r, c in nearest.items() if label[r] == 1 and label[c] == 0 and nearest[c] == r)
    assert pairs(resample.tomek_links(df, "k", "y", "p"), "common", "rare") == links


def test_knn_with_fewer_rows_than_asked(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "k bigint, p array<double>")
    assert pairs(neighbors.knn(df, df, 5, "k", "p"), "k", "neighbor") == [(1, 2), (2, 1)]
    assert neighbors.knn(df, df.limit(0), 5, "k", "p").count() == 0


# --- Samplers ---------------------------------------------------------------


@pytest.fixture(scope="module")
def rare(spark):
    rows, df = cloud(spark, n=150, copies=10)
    return rows, df.cache()


def on_a_segment(point, rows):
    for a in rows:
        for b in rows:
            ab = np.subtract(b, a)
            ap = np.subtract(point, a)
            length = float(ab @ ab)
            t = float(ap @ ab) / length if length else 0.0
            if -1e-9 <= t <= 1 + 1e-9 and np.linalg.norm(ap - t * ab) < 1e-7:
                return True
    return False


@pytest.mark.parametrize("text", [False, True])
def test_smote_points_lie_between_rare_rows(spark, text):
    rows, df = cloud(spark, n=80, copies=5, text=text)
    grown = resample.smote(df, "k", "y", "p")
    zeros, ones = prep.class_counts(grown, "y")
    assert zeros == ones
    assert grown.select("k").distinct().count() == zeros + ones
    old = {str(r[0]) for r in rows}
    base = [p for _, y, p in rows if y]
    fresh = [r for r in grown.collect() if r.k not in old]
    assert fresh and all(r.y == 1 and on_a_segment(r.p, base) for r in fresh)


@pytest.mark.parametrize("name", ["adasyn", "borderline_smote", "kmeans_smote"])
def test_oversamplers_only_add_rare_rows(spark, rare, name):
    rows, df = rare
    grown = resample.SAMPLERS[name](df, "k", "y", "p").collect()
    assert len({r.k for r in grown}) == len(grown)
    kept = {(r.k, r.y) for r in grown}
    assert {(str(k), y) for k, y, _ in rows} <= kept
    base = [p for _, y, p in rows if y]
    old = {str(k) for k, _, _ in rows}
    fresh = [r for r in grown if r.k not in old]
    assert all(r.y == 1 and on_a_segment(r.p, base) for r in fresh)


@pytest.mark.parametrize("name", ["smote", "random_over"])
def test_made_ids_are_unique_for_any_key(spark, name):
    ids = [-1, -2, 2**62, -(2**62), 0, 1, 2**20, -(2**20) - 2]
    rows = [(i, int(n < 2), [float(n), 1.0]) for n, i in enumerate(ids)]
    rows += [(10_000 + n, 0, [float(n), 2.0]) for n in range(30)]
    kinds = "k long, y int, p array<double>"
    grown = resample.SAMPLERS[name](spark.createDataFrame(rows, kinds), "k", "y", "p")
    keys = [r.k for r in grown.collect()]
    assert len(keys) == len(set(keys)) == 72 and {str(i) for i in ids} <= set(keys)
    rows = [("a~1", 1, [0.0]), ("a", 1, [1.0]), *[(f"c{i}", 0, [2.0]) for i in range(5)]]
    clash = spark.createDataFrame(rows, kinds.replace("long", "string"))
    with pytest.raises(ValueError, match="tilde"):
        resample.SAMPLERS[name](clash, "k", "y", "p")


@pytest.mark.parametrize(
    "name",
    ["random_under", "near_miss_1", "near_miss_2", "near_miss_3", "edited_nn",
     "repeated_edited_nn", "condensed_nn", "condensed_nn_in_order", "one_sided_selection", "neighbourhood_cleaning",
     "instance_hardness"],
)
def test_undersamplers_keep_every_rare_row(spark, rare, name):
    rows, df = rare
    kept = resample.SAMPLERS[name](df, "k", "y", "p").collect()
    keys = {r.k for r in kept}
    assert len(keys) == len(kept) and keys <= {k for k, _, _ in rows}
    if name != "one_sided_selection":
        assert {k for k, y, _ in rows if y} <= keys


def test_condensed_store_judges_every_common_row(spark, rare):
    rows, df = rare
    store = resample.condensed_nn(df, "k", "y", "p").cache()
    rest = df.join(store.select("k"), "k", "left_anti")
    wrong = neighbors.knn(rest, store, 1, "k", "p", "y").where("neighbor_label = 1")
    assert wrong.count() == 0


def one_at_a_time(rows, first):
    """Ids of the store when common rows are judged by id, one after the other."""
    store = [(k, y, p) for k, y, p in rows if y or k == first]
    for k, y, p in sorted(rows):
        if not y and k != first:
            if min(store, key=lambda s: (math.dist(p, s[2]), s[0]))[1]:
                store.append((k, y, p))
    return {k for k, _, _ in store}


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("block", [1, 7, 5000])
def test_condensed_in_order_as_one_at_a_time(spark, kind, block):
    rng = random.Random(block)
    rows = [(i, int(rng.random() < 0.3), [float(rng.randint(0, 6)), float(rng.randint(0, 6))]) for i in range(90)]
    if kind == "string":
        rows = [(f"r{k}", y, p) for k, y, p in rows]
    df = spark.createDataFrame(rows, f"k {kind}, y int, p array<double>")
    # copies, ties of distance, and common rows at the places of rare ones
    found = {r.k for r in resample.condensed_nn_in_order(df, "k", "y", "p", block=block).collect()}
    first = ranking.random_sample(df.where("y = 0"), "k", 1, resample.SEED).first().k
    assert found == one_at_a_time(rows, first)


def test_condensed_in_order_without_a_class(spark):
    kinds = "k long, y int, p array<double>"
    for rows in ([], [(1, 1, [0.0])], [(1, 0, [0.0]), (2, 0, [1.0])]):
        kept = resample.condensed_nn_in_order(spark.createDataFrame(rows, kinds), "k", "y", "p").count()
        assert kept == min(len(rows), 1)


def ring(n=240):
    """Rare rows in the middle, common ones all around: no line parts them."""
    rng = random.Random(4)
    rows = []
    for i in range(n):
        rare, turn = i % 4 == 0, rng.uniform(0, 2 * math.pi)
        radius = rng.uniform(0, 1.1) if rare else rng.uniform(0.9, 3)
        rows.append((i, int(rare), [radius * math.cos(turn), radius * math.sin(turn)]))
    return rows


def test_svm_smote_steps(spark):
    rows = ring()
    df = spark.createDataFrame(rows, "k long, y int, p array<double>")
    grown = resample.svm_smote(df, "k", "y", "p", end="end").collect()
    points, labels = {str(k): p for k, _, p in rows}, {str(k): y for k, y, _ in rows}
    fresh = [r for r in grown if "~" in r.k]
    assert len(fresh) == 120 and len(grown) == 360
    signs = set()
    for r in fresh:
        seed = r.k.split("~")[0]
        a, b = points[seed], points[r.end]
        others = sorted((math.dist(a, p), int(k)) for k, p in points.items() if k != seed)[:10]
        common = sum(1 - labels[str(k)] for _, k in others)
        t = ((r.p[0] - a[0]) * (b[0] - a[0]) + (r.p[1] - a[1]) * (b[1] - a[1])) / math.dist(a, b) ** 2
        assert math.dist(r.p, [x + t * (y - x) for x, y in zip(a, b)]) < 1e-9
        assert labels[seed] == labels[r.end] == 1 and common < 10
        assert -1e-9 <= t <= 1 if common >= 5 else -0.5 <= t <= 1e-9
        signs.add(common >= 5)
    assert signs == {True, False}


def test_a_radial_separator_sees_what_a_line_cannot(spark):
    rows = ring()
    df = spark.createDataFrame(rows, "k long, y int, p array<double>")
    curved, straight = (
        {r.k for r in resample.support_rows(df, "k", "y", "p", kernel).collect()}
        for kernel in (resample.RADIAL, resample.LINEAR)
    )
    # a line leaves every rare row inside its margin, the circle only the outer ones
    assert len(straight) == 60 and curved < straight
    out = lambda ks: np.mean([math.hypot(*p) for k, _, p in rows if k in ks])
    assert out(curved) > out(straight - curved)
    with pytest.raises(ValueError, match="radial or linear"):
        resample.support_rows(df, "k", "y", "p", "cubic")


def test_radial_features_give_the_kernel(spark):
    rows = ring(40)
    df = spark.createDataFrame(rows, "k long, y int, p array<double>")
    points = np.array([p for _, _, p in rows])
    g = 1 / (2 * points.var())
    exact = np.exp(-g * ((points[:, None] - points[None]) ** 2).sum(axis=2))
    found = resample.radial_features(df, "k", "p", "_v", landmarks=40).orderBy("k").collect()
    placed = np.array([r["_v"].toArray() for r in found])
    assert np.abs(placed @ placed.T - exact).max() < 1e-6


def test_repeated_editing_stops_when_stable(spark, rare):
    _, df = rare
    done = resample.repeated_edited_nn(df, "k", "y", "p")
    left, ones = prep.class_counts(done, "y")
    again, _ = prep.class_counts(resample.edited_nn(done, "k", "y", "p"), "y")
    assert again == left or again < ones


def test_instance_hardness_size(spark, rare):
    _, df = rare
    zeros, ones = prep.class_counts(resample.instance_hardness(df, "k", "y", "p"), "y")
    assert ones <= zeros <= ones + 12  # copies of one point tie at the threshold


# --- Models -----------------------------------------------------------------


def test_forced_features_come_last(spark):
    ranking_rows = [(f"f{i}", 1.0 / (i + 1), i + 1) for i in range(30)]
    df = spark.createDataFrame(ranking_rows, "feature string, importance double, rank int")
    chosen = models.top_with_forced(df, 20, ["f3", "late"]).orderBy("rank").collect()
    assert [r.feature for r in chosen] == [f"f{i}" for i in range(20)] + ["late"]


def test_balanced_weights(spark):
    df = spark.range(100).select((F.col("id") < 10).cast("int").alias("y"))
    totals = models.balanced_weights(df, "y").groupBy("y").agg(F.sum("weight").alias("w"))
    assert [round(r.w, 9) for r in totals.collect()] == [50.0, 50.0]
