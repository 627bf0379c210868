"""Train, save, load and score; readers and writers; the shape of the plans."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from caseloom.checks import flows as fl
from caseloom.checks.fixtures import VIEWS, view
from caseloom.operators import aggregates as ag
from caseloom.plans import features as ft
from caseloom.plans import train as tr
from caseloom.sources import tables as io

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def raw(spark, small, tmp_path_factory):
    """The derived tables as a folder of parquet files, and the dictionary as TSV."""
    folder = tmp_path_factory.mktemp("raw")
    for name in VIEWS:
        if name != "drug_dictionary":
            view(spark, small, name).write.parquet(f"{folder}/{name}.parquet")
    io.write_tsv(view(spark, small, "drug_dictionary"), f"{folder}/dictionary.tsv")
    return str(folder)


def test_train_then_score(spark, raw, tmp_path):
    store = str(tmp_path / "store")
    words = f"{raw}/dictionary.tsv"
    measured = tr.run(spark, "train", raw, words, store).collect()
    assert len(measured) == 1 and 0.0 <= measured[0].auc <= 1.0
    assert measured[0].positives + measured[0].negatives > 0

    names = ag.vocab_values(io.read_vocab(spark, f"{store}/top_features"))
    assert names[-2:] == list(tr.FORCED) or set(tr.FORCED) <= set(names)
    assert len(names) == len(set(names))

    scored = tr.run(spark, "test", raw, words, store, str(tmp_path / "out"))
    demo = io.read_table(spark, raw, "demo")
    assert scored.count() == demo.count()
    bad = scored.where(
        ~F.col("p_positive").between(0, 1)
        | (F.abs(F.col("prediction") + F.col("p_positive") - 1) > 1e-12)
    )
    assert bad.count() == 0
    lines = spark.read.csv(str(tmp_path / "out" / "predictions.csv"), header=True)
    assert lines.columns == ["patientid", "prediction"] and lines.count() == scored.count()

    # A second scoring finds the master in place and gives the same answers.
    again = tr.run(spark, "test", raw, words, store, str(tmp_path / "again"))
    assert sorted(again.collect()) == sorted(scored.collect())
    with pytest.raises(ValueError, match="train or test"):
        tr.run(spark, "tune", raw, words, store)


def test_stages_follow_their_inputs(spark, raw, tmp_path):
    words = io.read_tsv(spark, f"{raw}/dictionary.tsv", io.DICTIONARY_SCHEMA)
    store = str(tmp_path / "store")
    whole = read(spark, raw)
    first = tr.prepare(spark, whole, words, fl.VOCAB, store, fl.LAB_MEASURES)
    two = {n: df.where(F.col("patientid").isin("P1", "P2")) for n, df in whole.items()}
    second = tr.prepare(spark, two, words, fl.VOCAB, store, fl.LAB_MEASURES)
    assert {r.patientid for r in second.select("patientid").collect()} <= {"P1", "P2"}
    again = tr.prepare(spark, read(spark, raw), words, fl.VOCAB, store, fl.LAB_MEASURES)
    assert again.inputFiles() == first.inputFiles() != second.inputFiles()
    other = ft.Vocabularies(("BMI",), *list(vars(fl.VOCAB).values())[1:])
    third = tr.prepare(spark, whole, words, other, store, fl.LAB_MEASURES)
    assert third.inputFiles() != first.inputFiles()
    local = spark.createDataFrame(words.collect(), io.DICTIONARY_SCHEMA)
    marks = {io.fingerprint(spark, {"w": local}) for _ in range(2)}
    assert len(marks) == 2


def test_changed_files_change_the_fingerprint(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    before = io.fingerprint(spark, {"t": spark.read.parquet(path)}, 1)
    assert before == io.fingerprint(spark, {"t": spark.read.parquet(path)}, 1)
    assert before != io.fingerprint(spark, {"t": spark.read.parquet(path)}, 2)
    assert before != io.fingerprint(spark, {"t": spark.read.parquet(path).where("id > 1")}, 1)
    spark.range(4).write.mode("overwrite").parquet(path)
    assert before != io.fingerprint(spark, {"t": spark.read.parquet(path)}, 1)


def test_line_list_is_trimmed_and_ordered(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("zebra  \nant\t\nmoth\r\n")
    assert ag.vocab_values(io.read_vocab(spark, str(path))) == ["zebra", "ant", "moth"]


def test_categories_with_the_same_letters(spark, small):
    wide = ft.medication_features(
        view(spark, small, "medication"), view(spark, small, "drug_dictionary"),
        ("Diabetes", "diabetes"),
    )
    assert wide.columns == ["patientid", "Drug_count_Diabetes", "Drug_count_diabetes__2"]


def test_missing_category_in_scoring_is_zero(spark):
    diagnoses = spark.createDataFrame(
        [("p", 1, "I10", "ICD10"), ("q", 2, None, "ICD10"), ("r", 2, "250", "ICD9"),
         (None, 2, "A10", "ICD10")],
        io.SCHEMAS["diagnoses"],
    )
    rows = {r.patientid: r for r in ft.diagnosis_features(diagnoses).collect()}
    assert set(rows) == {"p", "q"}
    assert rows["p"].ICD10_status_I == 1 and rows["p"].ICD10_status_A == 0
    assert rows["q"].ICD10_status_N == 1


def test_fill_names_recovers_dropped_rows(spark, small):
    immunization = view(spark, small, "immunization")
    plain = ft.known_immunizations(immunization)
    filled = ft.known_immunizations(immunization, fill_names=True)
    assert filled.count() > plain.count()
    assert filled.where(F.col("mapped_name").isNull()).count() == 0


def test_reserved_dates_in_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    demo = spark.createDataFrame(
        [("p", "1950"), ("q", None)], "patientid string, birth_yr string"
    ).selectExpr(
        "patientid", "birth_yr", "'F' gender", "'x' race", "'y' ethnicity",
        "timestamp'2021-06-01 00:00:00' index_month_year",
    )
    row = ft.demographics(demo).orderBy("patientid").first()
    assert (row.index_month_year_from_begin, row.after_long_covid_start, row.age) == (517, 0, 71)


# --- Plans ------------------------------------------------------------------


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def read(spark, raw):
    return {n: io.read_table(spark, raw, n) for n in io.SCHEMAS}


def test_master_moves_each_source_once(spark, raw, no_broadcast):
    tables = read(spark, raw)
    words = io.read_tsv(spark, f"{raw}/dictionary.tsv", io.DICTIONARY_SCHEMA)
    text = plan(ft.master(tables, words, fl.VOCAB, measures=fl.LAB_MEASURES))
    # Diagnoses 1, dictionary 1, medication dedup and pivot 2, labs dedup and features 2,
    # observations dedup and features 2, demo 1, immunization 1. The merge adds none.
    assert text.count("Exchange hashpartitioning") == 10
    # One scan for each of the six tables, and one for the dictionary.
    assert text.count("FileScan parquet") == 6 and text.count("FileScan csv") == 1
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_label_join_leaves_the_master_in_place(spark, raw, no_broadcast):
    from caseloom.operators.rows import inner_on

    tables = read(spark, raw)
    words = io.read_tsv(spark, f"{raw}/dictionary.tsv", io.DICTIONARY_SCHEMA)
    wide = ft.master(tables, words, fl.VOCAB, measures=fl.LAB_MEASURES)
    text = plan(inner_on(wide, tables["target"], "patientid"))
    assert text.count("Exchange hashpartitioning") == 11


def test_an_entity_leaves_few_partial_totals(spark):
    """However many parts a table is dealt into; copies and nulls still meet."""
    from caseloom.operators.rows import SPREAD, dedup_by

    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    rows = [(f"P{i % 3}" if i % 3 else None, i // 6, str(i % 5) if i % 5 else None) for i in range(900)]
    events = spark.createDataFrame(rows + rows[::2], "patientid string, day int, code string").repartition(8)
    words = spark.createDataFrame([("d", "x")], io.DICTIONARY_SCHEMA)
    tables = {n: spark.createDataFrame([], io.SCHEMAS[n]) for n in ("medication", "labs", "observations")}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        once = dedup_by(events, "patientid")
        assert once.columns == events.columns
        assert sorted(map(str, once.collect())) == sorted(map(str, events.distinct().collect()))
        places = once.select("patientid", F.spark_partition_id().alias("at")).distinct().groupBy("patientid").count()
        assert {r["count"] for r in places.collect()} <= set(range(1, SPREAD + 1)) and places.count() == 3
        for part in (
            ft.medication_part(tables["medication"], words, ("x",)),
            ft.medication_features(tables["medication"], words, ("x",)),
            ft.lab_part(tables["labs"], ("t",), ("t",)),
            ft.lab_features(tables["labs"], ("t",), ("t",)),
            ft.lab_panel(tables["labs"], ("t",)),
            ft.lab_rates(tables["labs"], ("t",)),
            ft.observation_part(tables["observations"], ("t",)),
        ):
            # told from the plan before it is optimised, since the tables are empty
            text = part._jdf.queryExecution().analyzed().toString()
            assert len(re.findall(r"RepartitionByExpression \[patientid#\d+, _part#\d+", text)) == 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("short", [True, False])
def test_a_doubled_dictionary_line_counts_twice(spark, monkeypatch, short):
    from caseloom.operators import rows as rw

    monkeypatch.setattr(rw, "is_short", lambda df, most=0: short)
    events = spark.createDataFrame(
        [("p", 1, "d", "n"), ("p", 1, "d", "n"), ("p", 2, "d", "n"), ("q", 1, "e", "n")],
        io.SCHEMAS["medication"],
    )
    words = spark.createDataFrame([("d", "x"), ("d", "x"), ("e", None)], io.DICTIONARY_SCHEMA)
    assert [tuple(r) for r in ft.medication_features(events, words, ("x",)).collect()] == [("p", 4)]
    wide = {r["patientid"]: r for r in ft.medication_part(events, words, ("x",)).collect()}
    assert wide["p"].Drug_count_x == 4 and (wide["p"]._from_med, wide["p"]._to_med) == (1, 2)
    assert wide["q"].Drug_count_x is None and wide["q"]._in_med == 0


def test_joins_of_large_tables_are_dealt_into_more_parts(spark, small, monkeypatch):
    from caseloom.checks import fixtures

    names = ("diagnoses", "medication")
    assert fixtures.join_parts(spark, small) == 0
    few = {n: sorted(map(str, view(spark, small, n).collect())) for n in names}
    monkeypatch.setattr(fixtures, "JOINED_BYTES", 4_000)
    parts = fixtures.join_parts(spark, small)
    assert parts > int(spark.conf.get("spark.sql.shuffle.partitions"))
    for n in names:
        dealt = view(spark, small, n)
        assert f", {parts}), REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, dealt.collect())) == few[n]


def test_many_lines_of_a_drug_ride_as_one_count(spark):
    events = spark.createDataFrame([("p", 1, "d", "n"), ("p", 2, "d", "n")], io.SCHEMAS["medication"])
    events = events.unionByName(spark.createDataFrame([("q", 1, "e", "n")], events.schema))
    lines = [("d", "x")] * 500 + [("d", "y")] * 3 + [("d", None), ("e", "w")]
    words = spark.createDataFrame(lines, io.DICTIONARY_SCHEMA)
    # what a row carries through the dedup
    listed = ft.drug_lines(words, ("x", "y", "z")).collect()
    assert {r["Drug"]: len(r["_categories"]) for r in listed} == {"d": 2, "e": 1}
    counts = [("p", 1000, 6, 0), ("q", 0, 0, 0)]
    assert sorted(map(tuple, ft.medication_features(events, words, ("x", "y", "z")).collect())) == counts
    part = ft.medication_part(events, words, ("x", "y", "z"))
    assert sorted(map(tuple, part.select("patientid", *[f"Drug_count_{c}" for c in "xyz"]).collect())) == counts
    assert {r._in_med for r in part.collect()} == {1}


def test_flags_and_categories_travel_as_numbers(spark):
    """A row sets one bit and a drug's categories are whole numbers, however many there are."""
    chapters = [chr(0x100 + i) for i in range(130)]
    rows = [(f"P{i % 7}", i % 5, chapters[i * 11 % 130] + "1" if i % 4 else "?", "ICD10" if i % 3 else "ICD9") for i in range(60)]
    rows += [("none", 1, "x", "ICD9"), ("unknown", None, None, "ICD10")]
    schema = "patientid string, days_to_covid_diag int, diagnosis_cd string, diagnosis_cd_type string"
    part = ft.diagnosis_part(spark.createDataFrame(rows, schema), chapters)
    assert part._jdf.queryExecution().executedPlan().toString().count("partial_") == 6
    found = {r.patientid: r.asDict() for r in part.collect()}
    for key in {r[0] for r in rows}:
        seen = {(code or "None")[0] for k, _, code, kind in rows if k == key and kind == "ICD10"}
        flags = [found[key][f"ICD10_status_{c}"] for c in ft.slugs(chapters)]
        assert flags == ([int(c in seen) for c in chapters] if seen else [None] * 130)
    assert [found[k]["_in_dia"] for k in ("none", "unknown")] == [0, 1]

    drugs = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "z"), ("c", None)], "Drug string, Category string")
    taken = [("P1", 1, "a", "1"), ("P1", 1, "a", "1"), ("P1", 2, "a", "1"), ("P2", 3, "b", "2"), ("P3", 4, "c", "3")]
    medication = spark.createDataFrame(taken, "patientid string, days_to_covid_diag int, drug_name string, ndc string")
    for values, counts in ((("x", "y"), [("P1", 4, 2), ("P2", 0, 0), ("P3", None, None)]), ((), [("P1",), ("P2",), ("P3",)])):
        part = ft.medication_part(medication, drugs, values)
        told = part.select("patientid", *[f"Drug_count_{v}" for v in values]).collect()
        assert sorted(tuple(r) for r in told) == counts


def test_chapters_are_fitted(spark, small):
    tables = fl.tables(spark, small)
    odd = spark.createDataFrame(
        [("p", 1, "7A", "ICD10"), ("p", 1, "a1", "ICD10"), ("p", 1, "A1", "ICD10"), ("p", 1, "Z9", "ICD9")],
        io.SCHEMAS["diagnoses"],
    )
    vocab = ft.fit_vocabularies({**tables, "diagnoses": odd}, view(spark, small, "drug_dictionary"))
    assert vocab.chapters == ("7", "A", "a")
    row = ft.diagnosis_features(odd, vocab.chapters).first()
    assert len(row) == 4 and set(row[1:]) == {1}
    with pytest.raises(ValueError, match="more than 2 values"):
        ft.fit_vocabularies(
            {**tables, "diagnoses": odd}, view(spark, small, "drug_dictionary"), most_categories=2
        )


def test_fractions_in_day_columns_are_refused(spark, tmp_path):
    for day, good in ((2.0, True), (float("nan"), True), (None, True), (2.5, False)):
        path = tmp_path / str(day)
        rows = [("p", day, "A1", "ICD10", 7)]
        kinds = "patientid string, days_to_covid_diag double, diagnosis_cd string, diagnosis_cd_type string, extra int"
        spark.createDataFrame(rows, kinds).write.parquet(f"{path}/diagnoses.parquet")
        read = io.read_table(spark, str(path), "diagnoses")
        assert read.schema.simpleString() == spark.createDataFrame([], io.SCHEMAS["diagnoses"]).schema.simpleString()
        if good:
            assert read.first()["days_to_covid_diag"] == (2 if day == 2.0 else None)
        else:
            with pytest.raises(Exception, match="not a whole number"):
                read.collect()


def test_copies_are_limited_before_the_shuffle(spark, small):
    from caseloom.operators.neighbors import _first_copies, _rows

    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    text = plan(_first_copies(_rows(vectors, "vec_id", "embedding", "label"), 4))
    assert text.index("WindowGroupLimit") < text.index("Exchange")
    assert text.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark, raw):
    tables = read(spark, raw)
    text = plan(ft.diagnosis_features(tables["diagnoses"]))
    assert "EqualTo(diagnosis_cd_type,ICD10)" in text
    assert "ReadSchema: struct<patientid:string,diagnosis_cd:string,diagnosis_cd_type:string>" in text
    text = plan(ft.lab_panel(tables["labs"], ("click", "view"), fl.LAB_MEASURES))
    assert "In(test_name, [click,view])" in text
    text = plan(ft.total_span(tables))
    assert "ReadSchema: struct<patientid:string,days_to_covid_diag:int>" in text


@pytest.mark.parametrize(
    "name",
    [
        "diagnosis_features", "lab_features_one_pass", "merge_outer", "overall_span",
        "source_coverage", "roc_auc", "stratified_folds", "tomek_links", "near_miss_3",
    ],
)
def test_no_pairwise_joins(spark, small, no_broadcast, name):
    from caseloom.checks.all import QUERIES

    text = plan(QUERIES[name](spark, small))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_lineage_is_cut_in_shared_storage():
    source = "\n".join(p.read_text() for p in (ROOT / "caseloom").rglob("*.py"))
    assert "localCheckpoint" not in source and "crossJoin" not in source
    assert ".rdd" not in source
