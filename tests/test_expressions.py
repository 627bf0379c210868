"""Edge tables for the scalar expressions and rule tables."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from caseloom.functions import rules, scalars
from caseloom.operators import columns


def evaluate(spark, schema, rows, expression):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_to_number(spark):
    cases = {
        "12": 12.0, " 12 ": 12.0, "1e3": 1000.0, "-4.5": -4.5, "+2": 2.0, ".5": 0.5, "5.": 5.0,
        "inf": math.inf, "-Infinity": -math.inf,
        "nan": None, "1.0d": None, "1.0f": None, "<5": None, "1,000": None, "": None,
        "0x10": None, "1_000": None, "n/a": None, None: None,
    }
    got = evaluate(spark, "s string", [(c,) for c in cases], scalars.to_number("s"))
    assert dict(zip(cases, got)) == cases


RANGES = [
    # result, range, verdict
    ("3", None, None),
    ("3", "-", None),
    ("unknown", "1-5", None),
    ("unknown", "unknown", None),
    ("negative", "negative", 0),
    ("negative", "positive", 1),
    (None, "negative", 1),
    (None, "1-5", None),
    ("high", "1-5", None),
    ("3", "1-5", 0),
    ("1", "1-5", 0),
    ("5", "1-5", 0),
    ("0.5", "1-5", 1),
    ("6", "1-5", 1),
    ("10.5", "10.5-60", 0),
    ("7", ">=7", 0),
    ("6", ">=7", 1),
    ("7", "<=7", 0),
    ("8", "<=7", 1),
    ("6", "<7", 0),
    ("7", "<7", 1),
    ("8", ">7", 0),
    ("7", ">7", 1),
    ("high", "<7", None),
    (None, "<7", None),
    ("high", "about 7", 1),
    ("7", "=7", 1),
    ("2", "1-2-3", 1),
    ("high", "1-2-3", 1),
    ("3", "1..5-9", None),
    ("0", "1-3..5", 1),
    ("4", "1-3..5", None),
    # signs are lost: the dash is a separator
    ("0", "-1-1", 1),
]


def test_range_flag(spark):
    got = evaluate(
        spark, "r string, n string", [c[:2] for c in RANGES], scalars.range_flag("r", "n")
    )
    assert [(r, n, x) for (r, n, _), x in zip(RANGES, got)] == RANGES


def test_range_flag_in_stages(spark):
    df = spark.createDataFrame(
        [(i, *c[:2]) for i, c in enumerate(RANGES)], "i int, r string, n string"
    )
    staged = scalars.with_range_flag(df, "r", "n", "x")
    assert staged.columns == ["i", "r", "n", "x"]
    assert [r.x for r in staged.orderBy("i").collect()] == [c[2] for c in RANGES]


def test_clean_year(spark):
    years = [("1950",), ("Unknown",), ("1932 and Earlier",), (None,), ("Undisclosed",)]
    got = evaluate(spark, "s string", years, scalars.clean_year("s"))
    assert got == [1950, 1968, 1932, 1968, 1968]


def test_labels_and_keys(spark):
    got = evaluate(
        spark, "a string, b string", [("BMI", None), ("HT", "cm"), (None, "x")],
        scalars.label_with_unit("a", "b"),
    )
    assert got == ["BMI(None)", "HT(cm)", "None(x)"]
    got = evaluate(
        spark, "a string, b string", [("I10", "ICD10"), (None, "ICD9")], scalars.concat_key("a", "b")
    )
    assert got == ["I10_ICD10", None]
    got = evaluate(spark, "a string", [("I10",), (None,)], scalars.code_chapter("a"))
    assert got == ["I", "N"]


@pytest.mark.parametrize(
    ("description", "name"),
    [
        ("COVID-19 JANSSEN", rules.JANSSEN_NAME),
        ("SARS-COV-2 JNJ", rules.JANSSEN_NAME),
        ("COVID AD26", rules.JANSSEN_NAME),
        ("COVID-19 PFIZER", rules.MRNA_NAME),
        ("COVID-19 VACCINE, 100 MCG/0.5ML DOSE", rules.MRNA_NAME),
        ("COV-19 MRNA-1273", rules.MRNA_NAME),
        ("COVID, 30 MCG/0.3 ML DOSE", rules.MRNA_NAME),
        ("COVID NOVAVAX", rules.MRNA_NAME),
        ("COVID-19 RS-CHADOX1", rules.ASTRA_NAME),
        ("COVID-19 SINOVAC", rules.NON_US_NAME),
        ("COVID-19 NOS", rules.UNSPECIFIED_NAME),
        ("INFLUENZA, SEASONAL", "Flu Vaccine Unspecified"),
        ("FLU SHOT", "Flu Vaccine Unspecified"),
        ("HEP B ADULT", "Hepatitis B Vaccine Unspecified"),
        ("PNEUMOCOCCAL 13", "Pneumococcal Vaccine - Unspecified"),
        ("RABIES IM", "Rabies Vaccine, Unspecified"),
        ("ZOSTER LIVE", "Zoster Vaccine, Unspecified"),
        ("YELLOW FEVER", "yellow fever vaccine live/PF"),
        ("TYPHOID ORAL", "typhoid vacc,live,attenuated"),
        ("RHO (D) IG", rules.RHO_NAME),
        ("RHO D IG", rules.RHO_NAME),
        ("TDAP", rules.TDAP_NAME),
        ("BCG", "BCG"),
    ],
)
def test_vaccine_name(spark, description, name):
    assert evaluate(spark, "d string", [(description,)], rules.vaccine_name("d")) == [name]


def test_annotate_brand(spark):
    texts = [("X 100 MCG/0.5 ML",), ("X MRNA 1273",), ("X 30 MCG/0.3ML",), ("X",), (None,)]
    got = evaluate(spark, "d string", texts, rules.annotate_brand("d"))
    assert got == [
        "X 100 MCG/0.5 ML (MODERNA)", "X MRNA 1273 (MODERNA)", "X 30 MCG/0.3ML(PFIZER)", "X", None,
    ]


def test_brand_and_flu(spark):
    pairs = [
        (rules.JANSSEN_NAME, "X"),
        (rules.ASTRA_NAME, "X"),
        (rules.NON_US_NAME, None),
        (rules.UNSPECIFIED_NAME, "X"),
        (rules.MRNA_NAME, "MODERNA"),
        (rules.MRNA_NAME, "PFIZER"),
        (rules.MRNA_NAME, "NOVAVAX"),
        (rules.MRNA_NAME, "JANSSEN"),
        (rules.MRNA_NAME, "X"),
        ("COVID-19 other", "X"),
        ("Tdap", "X"),
    ]
    got = evaluate(spark, "n string, d string", pairs, rules.covid_brand("n", "d"))
    assert got == [
        "JNJ", "AstraZeneca", "Non-US", "Unspecified", "MODERNA", "PFIZER", "NOVAVAX", "JNJ",
        "Unspecified", "Unspecified", None,
    ]
    names = [
        ("Influenza Live Vaccine",), ("Influenza Inactivated Vaccine",), ("flu vaccine x",),
        ("Haemophilus influenzae b vaccine",), ("Tdap",), (None,),
    ]
    kinds = ["Live", "Inactivated", "Unspecified", "Unspecified", None, None]
    assert evaluate(spark, "n string", names, rules.flu_kind("n")) == kinds
    kinds[3] = None
    assert evaluate(spark, "n string", names, rules.flu_kind("n", strict=True)) == kinds


@pytest.mark.parametrize(
    ("code", "system", "title"),
    [
        ("A001", "ICD10", "Certain infectious"),
        ("D49", "ICD10", "Neoplasms"),
        ("D500", "ICD10", "Diseases of the blood"),
        ("H61", "ICD10", "Diseases of the ear"),
        ("O9A1", "ICD10", "Pregnancy"),
        ("T88", "ICD10", "Injury"),
        ("139", "ICD9", "Infectious"),
        ("2500", "ICD9", "Endocrine"),
        ("V010", "ICD9", "Supplementary Classification Of Factors"),
        ("E8490", "ICD9", "Supplementary Classification Of External"),
    ],
)
def test_code_range_chapter(spark, code, system, title):
    got = evaluate(spark, "c string", [(code,)], rules.code_range_chapter("c", system))
    assert got[0].startswith(title)


def test_slugs_are_unique_without_case():
    values = ["Diabetes", "diabetes", "Chloride (Cl)", "Glucose.random", "Glucose random", "?"]
    assert scalars.slugs(values) == [
        "Diabetes", "diabetes__2", "Chloride_Cl", "Glucose_random", "Glucose_random__2", "blank",
    ]


def test_drop_columns_matching(spark):
    names = ["Drug_count_x", "Platelet count", "Unknown", "BUN", "age"]
    df = spark.createDataFrame([tuple(range(5))], names)
    assert columns.drop_columns_matching(df).columns == ["age"]
    assert columns.drop_columns_matching(df, columns.UNKNOWN_NARROW).columns == [
        "Drug_count_x", "Platelet count", "BUN", "age",
    ]
    assert "Unknown" in columns.drop_columns_matching(df, keep=["Unknown"]).columns


def test_one_hot_refuses_clashes_and_ignores_empty(spark):
    df = spark.createDataFrame([("p", "a", 1), ("q", "", 2), ("r", None, 3)], "k string, c string, c_a int")
    assert columns.fit_categories(df, ["c"]) == {"c": ["a"]}
    with pytest.raises(ValueError, match="already exist"):
        columns.one_hot(df, {"c": ["a"]})
    hot = columns.one_hot(df.drop("c_a"), {"c": ["a"]}).orderBy("k").collect()
    assert [r.c_a for r in hot] == [1, 0, 0]
    with pytest.raises(ValueError, match="more than 1 values"):
        columns.fit_categories(df, ["k"], most=1)


def test_day_band(spark):
    days = [(d,) for d in (-3, 6, 7, 14, 15, None)]
    got = evaluate(spark, "d int", days, scalars.day_band("d"))
    assert got == ["<7", "<7", "7-14", "7-14", ">14", None]


def test_nulls_stay_when_a_value_is_dropped(spark):
    from caseloom.operators.rows import drop_value, keep_in_vocab

    df = spark.createDataFrame([("a",), ("unknown",), (None,)], "s string")
    assert {r.s for r in drop_value(df, "s", "unknown").collect()} == {"a", None}
    assert [r.s for r in keep_in_vocab(df, "s", ["a", None]).collect()] == ["a"]
    assert keep_in_vocab(df, "s", [str(i) for i in range(2000)] + ["a"]).count() == 1
    assert keep_in_vocab(df, "s", df.where(F.col("s") == "a")).count() == 1
