"""What the samplers of a study's fold begin with alike, and the models of rows sent as Arrow batches."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.operators import logistic, resample

ALIKE = ("edited_nn", "repeated_edited_nn", "neighbourhood_cleaning", "smote", "smote_enn", "smote_tomek")
COLUMNS = ("k", "y", "p")


@pytest.fixture(scope="module")
def df(spark):
    random = np.random.default_rng(8)
    rows = [(f"r{i}", int(i % 5 == 0), (random.normal(size=3) + (i % 5 == 0)).tolist()) for i in range(160)]
    rows += [("gap", 0, None), ("of no class", None, [0.1, 0.2, 0.3])]
    return spark.createDataFrame(rows, "k string, y int, p array<double>").cache()


def told(rows) -> list:
    return sorted((r.k, r.y, tuple(r.p) if r.p else ()) for r in rows.collect())


def begun(df, names=ALIKE):
    return resample.Begun(df, *COLUMNS, {name: resample.SAMPLERS[name] for name in names})


@pytest.mark.parametrize("name", ALIKE)
def test_shared_beginnings_change_no_sampler(df, name):
    sampler = resample.SAMPLERS[name]
    assert told(begun(df).sampled(name, sampler)) == told(sampler(df, *COLUMNS))


def test_rows_that_come_twice_change_no_sampler(df):
    twice, both = df.unionByName(df.where("k < 'r3'")), begun(df.unionByName(df.where("k < 'r3'")))
    assert both.among() is None
    for name in ALIKE[2:]:
        assert told(both.sampled(name, resample.SAMPLERS[name])) == told(resample.SAMPLERS[name](twice, *COLUMNS))


def test_a_fold_is_searched_once_for_all(df, monkeypatch):
    searched, true = [], resample.knn

    def search(queries, base, k, *rest, **more):
        searched.append((queries.count(), base.count(), k))
        return true(queries, base, k, *rest, **more)

    monkeypatch.setattr(resample, "knn", search)
    study = resample.resampling_study(df.dropna(), *COLUMNS, ALIKE, folds=2, models=("logistic",)).collect()
    assert len(study) == 12
    train = df.dropna().count() // 2
    # per fold: common rows among all, rare rows among all, grown rows among themselves
    assert sum(base > train + 20 and k == 3 for _, base, k in searched) == 2
    assert sum(q > 40 and base <= train + 20 and k == 3 for q, base, k in searched) <= 4
    assert not any(k == 1 for *_, k in searched)


def test_samplers_of_another_name_or_kind_are_called_as_they_are(df):
    called = []

    def own(rows, key, label, point):
        called.append(rows.count())
        return resample.SAMPLERS["none"](rows, key, label, point)

    study = resample.resampling_study(df.dropna(), *COLUMNS, {"smote": own, "edited_nn": own}, folds=2, models=("logistic",))
    assert study.count() == 4 and len(called) == 4


def test_a_point_of_another_width_is_an_error(spark):
    rows = spark.createDataFrame([(0, 1, [1.0, 2.0]), (0, 0, [1.0]), (0, 0, [0.0, 1.0])], "m int, y int, p array<double>")
    with pytest.raises(Exception, match="coordinates"):
        logistic.fit_many(rows, "m", "y", "p")


def test_models_do_not_depend_on_what_lies_next_to_their_rows(df):
    rows = df.where("y is not null and p is not null").withColumn("m", F.explode(F.array(F.lit(3), F.lit(5))))
    both = logistic.fit_many(rows.orderBy("k"), "m", "y", "p")
    alone = logistic.fit_many(rows.where("m = 5"), "m", "y", "p")
    assert set(both) == {3, 5}
    for m in both:
        assert both[m].weights == pytest.approx(alone[5].weights, abs=1e-9) and both[m].slope < 1e-8
