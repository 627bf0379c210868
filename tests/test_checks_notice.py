"""Checks of results that SQL states as counts turn red when the operator is broken."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caseloom.checks import flows, learning
from caseloom.checks.all import QUERIES, SQL
from caseloom.operators import aggregates, models, resample
from caseloom.plans import train
from conftest import SMALL
from harness import connect, differences


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def red(spark, con, name):
    return differences(QUERIES[name](spark, SMALL), con, SQL[name])


def test_condensed_store_stopped_early(spark, con, monkeypatch):
    whole = resample.condensed_nn
    monkeypatch.setattr(resample, "condensed_nn", lambda *a: whole(*a, rounds=0))
    assert red(spark, con, "condensed_nearest_neighbours")


@pytest.mark.parametrize("name", ["svm_smote", "kmeans_smote"])
def test_rows_made_beside_the_line(spark, con, monkeypatch, name):
    true = resample._draw
    monkeypatch.setattr(
        resample, "_draw", lambda k, c, s, what: F.lit(1.5) if what == "step" else true(k, c, s, what)
    )
    assert red(spark, con, name)


@pytest.mark.parametrize("name", ["svm_smote", "kmeans_smote"])
def test_rows_made_towards_another_row(spark, con, monkeypatch, name):
    true = resample.between

    def swapped(*a):
        return true(*a).withColumn("end", F.substring_index("vec_id", "~", 1))

    monkeypatch.setattr(resample, "between", swapped)
    assert red(spark, con, name)


def test_lines_of_many_rare_rows(spark, monkeypatch):
    rare = spark.range(20_002).select(
        F.col("id").alias("vec_id"), F.lit(1).alias("y"), F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("embedding")
    )
    monkeypatch.setattr(learning, "_vectors", lambda *_: rare)

    def sampler(df, key, label, point, end):
        """A row between each row and the next; behind the last there is none."""
        made = df.select(
            F.concat(F.col(key).cast("string"), F.lit("~1")).alias(key),
            label,
            F.array(F.col(key) + 0.25, F.lit(1.0)).alias(point),
            (F.col(key) + 1).cast("string").alias(end),
        )
        own = df.select(F.col(key).cast("string").alias(key), label, F.col(point).cast("array<double>").alias(point))
        return own.unionByName(made, allowMissingColumns=True)

    assert [tuple(r) for r in learning._on_lines(spark, SMALL, sampler).collect()] == [(0, 40_004, 20_002, 1)]


def test_whole_grid_is_searched(spark, monkeypatch):
    searched = []

    def search(df, key, cols, label, grid, folds, seed):
        searched.append((grid, folds))
        return spark.createDataFrame(
            [(i, f, 0.5, 0.5) for i in range(len(grid)) for f in range(folds)],
            "setting long, fold long, auc double, accuracy double",
        )

    matrix = spark.createDataFrame([("a", 1, 0.5)], "key string, y int, x double")
    monkeypatch.setattr(learning, "_matrix", lambda *_: (matrix, ["x"]))
    monkeypatch.setattr(models.boosting, "grid_search", search)
    tried = {(r["objective"], r["depth"], r["rate"]) for r in QUERIES["grid_search"](spark, SMALL).collect()}
    assert tried == {(o, d, s) for o in ("squared", "logistic") for d in (3, 6, 10) for s in (0.1, 0.5, 1.0)}
    (grid, folds), = searched
    assert folds == 5 and {s.rounds for s in grid} == {50}


def test_splits_off(spark, con, monkeypatch):
    monkeypatch.setattr(models.boosting, "soft", lambda total, l1: total)
    assert red(spark, con, "booster_first_levels")


def test_gaps_on_the_wrong_side(spark, con, monkeypatch):
    true = models.with_scores
    monkeypatch.setattr(models, "with_scores", lambda m, df: true(m, df.na.fill(0.0)))
    assert red(spark, con, "booster_scores_with_gaps")


def test_hard_rows_kept(spark, con, monkeypatch):
    whole = resample.instance_hardness

    def worst(df, *columns):
        kept = whole(df, *columns)
        return kept.where("y = 1").unionByName(
            df.select(*kept.columns).where("y = 0").orderBy("vec_id").limit(kept.where("y = 0").count())
        )

    monkeypatch.setattr(resample, "instance_hardness", worst)
    assert red(spark, con, "instance_hardness")


@pytest.mark.parametrize("name", ["random_forest_scores", "boosted_trees_scores"])
def test_scores_off(spark, con, monkeypatch, name):
    true = models.with_scores
    monkeypatch.setattr(
        models, "with_scores", lambda m, df: true(m, df).withColumn("p_positive", F.col("p_positive") * 0.9 + 0.01)
    )
    assert red(spark, con, name)


def test_logistic_not_at_rest(spark, con, monkeypatch):
    true = models.with_scores
    monkeypatch.setattr(
        models, "with_scores", lambda m, df: true(m, df).withColumn("p_positive", F.sqrt("p_positive"))
    )
    assert red(spark, con, "logistic_regression_scores")


def test_importance_out_of_order(spark, con, monkeypatch):
    true = models.rank_importance
    monkeypatch.setattr(
        models, "rank_importance", lambda *a: true(*a).withColumn("importance", F.col("rank").cast("double"))
    )
    assert red(spark, con, "extra_trees_importance")


def test_approximate_count_far_off(spark, con, monkeypatch):
    true = aggregates.distinct_count

    def far(df, cols, approximate=False):
        found = true(df, cols, approximate)
        return found.withColumn("n", F.col("n") * 2) if approximate else found

    monkeypatch.setattr(aggregates, "distinct_count", far)
    assert red(spark, con, "distinct_count_approximate")


def test_forced_features_left_out(spark, con, monkeypatch):
    monkeypatch.setattr(train, "top_with_forced", lambda ranking, k, forced: models.top_with_forced(ranking, k, []))
    assert red(spark, con, "select_features")


def test_stage_of_another_batch(spark, con, monkeypatch):
    monkeypatch.setattr(train, "fingerprint", lambda *a: "one")
    monkeypatch.setattr(train, "prepare", lambda s, t, d, v, path, m: real(s, t, d, v, path.rsplit("/", 1)[0] + "/m" + str("target" in t), m))
    assert red(spark, con, "train_save_load_score")


real = train.prepare


def test_metrics_of_other_rows(spark, con, monkeypatch):
    true = train.evaluate
    monkeypatch.setattr(train, "evaluate", lambda scored: true(scored.where("p_positive < 0.5 or patientid < 'P5'")))
    assert red(spark, con, "train_and_evaluate")


def test_modules_are_those_the_queries_use():
    assert learning.resample is resample and flows.tr is train
