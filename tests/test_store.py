"""Generations of fitted things: lists come back as they were, half a training run is not seen."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caseloom.checks import flows as fl
from caseloom.checks.fixtures import view
from caseloom.operators import aggregates as ag
from caseloom.plans import features as ft
from caseloom.plans import train as tr
from caseloom.sources import store as generations
from caseloom.sources import tables as io

ODD = ("SBP ", " SBP", "SBP", "Gluc\nose", "\r\n", "", "  ", "a,b\t\"c\"", "é ", "Sbp")


def test_lists_come_back_as_they_were(spark, tmp_path):
    vocab = ft.Vocabularies(ODD, ODD[::-1], (), ("Diabetes", "Diabetes ", "diabetes"))
    generation = generations.begin(str(tmp_path))
    ft.save_vocabularies(spark, vocab, generation)
    assert ft.load_vocabularies(spark, generation) == vocab
    with pytest.raises(ValueError, match="more than 3 values"):
        ft.load_vocabularies(spark, generation, 3)


def test_line_lists_refuse_what_they_cannot_hold(spark, tmp_path):
    for odd in ("x ", "x\ny", "", None, "x\t", "x\r"):
        rows = spark.createDataFrame([("a", 0), (odd, 1)], "value string, rank int")
        with pytest.raises(ValueError, match="cannot be lines"):
            io.write_vocab(rows, str(tmp_path / "list"))
    long = spark.range(30).select(F.col("id").cast("string").alias("value"), F.col("id").alias("rank"))
    with pytest.raises(ValueError, match="at most 20"):
        io.write_vocab(long, str(tmp_path / "list"), most=20)
    io.write_vocab(long, str(tmp_path / "list"))
    assert ag.vocab_values(io.read_vocab(spark, str(tmp_path / "list"))) == [str(i) for i in range(30)]


def test_only_whole_generations_are_seen(spark, tmp_path):
    store = str(tmp_path)
    with pytest.raises(ValueError, match="nothing was published"):
        generations.latest(spark, store)
    first, second = generations.begin(store), generations.begin(store)
    generations.save_numbers(spark, first, "medians", {"x": 0.1 + 0.2})
    generations.publish(spark, first, {"n": 1})
    generations.save_numbers(spark, second, "medians", {"x": 2.0})
    assert generations.latest(spark, store) == (first, {"n": 1})
    # a publication that was not finished
    (tmp_path / "published" / "7").mkdir()
    assert generations.latest(spark, store)[0] == first
    generations.publish(spark, second, {"n": 2})
    assert generations.latest(spark, store) == (second, {"n": 2})
    assert generations.load_numbers(spark, first, "medians") == {"x": 0.1 + 0.2}


class Ended(Exception):
    pass


def ends(monkeypatch, module, name):
    def end(*_, **__):
        raise Ended

    monkeypatch.setattr(module, name, end)


def odd_tables(spark, small, labelled=True):
    """The derived tables with test names that differ in blanks and line breaks alone."""
    tables = fl.tables(spark, small, labelled)
    name = F.col("test_name")
    odd = F.when(name == "click", "click ").when(name == "view", "click").when(name == "error", "cli\nck").otherwise(name)
    return tables | {"labs": tables["labs"].withColumn("test_name", odd)}


STEPS = [
    (tr, "fit_master_categories"), (generations, "save_numbers"), (tr.Booster, "save"), (tr, "with_scores"),
    (generations, "publish"),
]


def test_training_that_ends_early_leaves_the_old_generation(spark, small, tmp_path, monkeypatch):
    store, words = str(tmp_path / "store"), view(spark, small, "drug_dictionary")
    tables = odd_tables(spark, small)
    tr.train_on(spark, tables, words, store, measures=fl.LAB_MEASURES, top_features=8)
    new = odd_tables(spark, small, labelled=False)

    def scores(to):
        found = tr.score_on(spark, new, words, store, str(tmp_path / to), fl.LAB_MEASURES)
        return sorted(tuple(r) for r in found.collect())

    before = scores("before")
    published = generations.latest(spark, store)
    for i, (module, name) in enumerate(STEPS):
        with monkeypatch.context() as patch:
            ends(patch, module, name)
            with pytest.raises(Ended):
                tr.train_on(spark, tables, words, store, fl.VOCAB, fl.LAB_MEASURES, top_features=3)
        assert generations.latest(spark, store) == published, name
    assert scores("after") == before
    with pytest.raises(ValueError, match="other measures"):
        tr.score_on(spark, new, words, store, str(tmp_path / "x"), fl.LAB_MEASURES[:1])

    # what training counted is what scoring counts, blank for blank
    generation, facts = published
    vocab = ft.load_vocabularies(spark, generation)
    assert {"click ", "click", "cli\nck"} <= set(vocab.rate_tests)
    cells = {}
    for name, rows in (("train", tables), ("score", new)):
        rows = {n: t for n, t in rows.items() if n != "target"}
        fitted = vocab if name == "score" else ft.fit_vocabularies(rows, words)
        table = tr.prepare(spark, rows, words, fitted, f"{store}/{name}_cells", fl.LAB_MEASURES)
        cells[name] = sorted(map(repr, table.collect()))
        assert len(cells[name]) > 10
    assert cells["train"] == cells["score"]


def test_gaps_may_stay_gaps(spark, small, tmp_path):
    store, words = str(tmp_path / "store"), view(spark, small, "drug_dictionary")
    tables = fl.tables(spark, small)
    parameters = {"top_features": 6, "test_share": 0.5, "unused_share": 0.0}
    tr.train_on(spark, tables, words, store, fl.VOCAB, fl.LAB_MEASURES, fill=False, **parameters)
    generation, facts = generations.latest(spark, store)
    names = generations.load_lists(spark, generation, "features")["features"]
    assert facts["fill"] is False and len(names) in (6, 7, 8)
    new = fl.tables(spark, small, labelled=False)
    scored = tr.score_on(spark, new, words, store, str(tmp_path / "out"), fl.LAB_MEASURES)
    assert scored.count() == new["demo"].count() and scored.where("p_positive is null").count() == 0
