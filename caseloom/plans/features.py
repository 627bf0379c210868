"""Feature tables of the seven inputs and the master matrix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from string import ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caseloom.functions.rules import (
    annotate_brand,
    covid_brand,
    flu_kind,
    is_covid,
    substring_flags,
    vaccine_name,
)
from caseloom.functions.scalars import (
    after,
    age,
    clean_year,
    code_chapter,
    days_since,
    label_with_unit,
    norm_text,
    row_max,
    row_min,
    slugs,
    to_number,
    with_range_flag,
)
from caseloom.operators.aggregates import (
    Measure,
    all_value_counts,
    count_pivot,
    entity_span,
    label_set,
    latest_value,
    measure_columns,
    overall_span,
    panel,
    presence_pivot,
    present,
    rate_pivot,
    top_k_vocab,
    vocab_values,
)
from caseloom.operators.columns import (
    UNKNOWN_BROAD,
    coerce_columns,
    drop_columns_matching,
    fit_categories,
    one_hot,
)
from caseloom.operators.merge import merge_inner, merge_outer
from caseloom.operators.rows import (
    dedup,
    dedup_by,
    dictionary_join,
    drop_value,
    inner_on,
    keep_in_vocab,
)
from caseloom.sources.store import Generation, load_lists, save_lists

KEY = "patientid"
DAY = "days_to_covid_diag"
LABEL = "has_long_covid_diag"

# --- Fixed values: panels and column lists ----------------------------------

LAB_MEASURES = (
    Measure("Oxygen saturation (SpO2).pulse oximetry", "OxSatu", ("min", "mean"), high=100),
    Measure("Glucose.random", "Glucose"),
    Measure("Creatinine", "Creatinine"),
    Measure("White blood cell count (WBC)", "WBC"),
    Measure("Red blood cell count (RBC)", "RBC"),
    Measure("Platelet count (PLT)", "PLT"),
    Measure("Carbon dioxide.total (CO2)", "CO2"),
    Measure("Neutrophil.percent", "Neutro"),
    Measure("Lymphocyte.percent", "Lympho"),
    Measure("Monocyte.percent", "Mono"),
    Measure("Eosinophil.percent", "Eosin"),
    Measure("Basophil.percent", "Baso"),
    Measure("Chloride (Cl)", "Chloride"),
    Measure("Mean corpuscular hemoglobin (MCH)", "MCH"),
    Measure("Bilirubin.total", "Billi"),
)
OBSERVATION_MEASURES = (
    Measure("BMI(None)", "BMI"),
    Measure("HT(cm)", "HT"),
    Measure("WT(kg)", "WT"),
    Measure("PULSE(bpm)", "PULSE"),
    Measure("TEMP(deg c)", "TEMP"),
    Measure("RESP(breaths/min)", "RESP"),
    Measure("HR(bpm)", "HR"),
    Measure("PAIN(out of 10)", "PAIN"),
    Measure("PACK_YEARS(pack-years)", "PACKYRS"),
    Measure("DBP(mm Hg)", "DBP"),
    Measure("SBP(mm Hg)", "SBP"),
)
SMOKE_LABEL = "SMOKE(None)"
ALCOHOL_LABEL = "ALCOHOL(None)"
UNSPECIFIED_IMMUNIZATION = "UNSPECIFIED IMMUNIZATION"

COERCED = (
    "Baso_max", "Lympho_max", "Creatinine_max", "WBC_max", "Glucose_max", "CO2_max",
    "Mono_max", "PLT_max", "Eosin_max", "Neutro_max", "RBC_max",
)
CATEGORICAL = ("ethnicity", "race", "ALCOHOL", "SMOKE", "gender", "Influenza", "COVID_19")
DATES = ("index_month_year", "birth_yr")

OBSERVATION_TYPES, PANEL_TESTS, RATE_TESTS = 15, 40, 50


def earliest_panel(measures: Sequence[Measure]) -> tuple[Measure, ...]:
    """The earlier one-statistic panels: the minimum or maximum without the mean."""
    return tuple(
        Measure(m.label, m.prefix, m.stats[:1], m.low, None) for m in measures
    )


@dataclass(frozen=True)
class Vocabularies:
    """Value lists fitted on training data. They fix every pivot's columns."""

    observation_types: tuple[str, ...]
    panel_tests: tuple[str, ...]
    rate_tests: tuple[str, ...]
    drug_categories: tuple[str, ...]
    chapters: tuple[str, ...] = tuple(ascii_uppercase)


Tables = Mapping[str, DataFrame]


def fit_vocabularies(
    tables: Tables,
    dictionary: DataFrame,
    observation_types: int = OBSERVATION_TYPES,
    panel_tests: int = PANEL_TESTS,
    rate_tests: int = RATE_TESTS,
    most_categories: int = 1000,
) -> Vocabularies:
    """Most frequent observation types and tests after dedup, drug categories and chapters.

    More than ``most_categories`` drug categories or chapters are an error.
    """
    codes = tables["diagnoses"].where(F.col("diagnosis_cd_type") == "ICD10")
    chapters = codes.select(code_chapter("diagnosis_cd").alias("chapter"))
    top = {
        "obs": top_k_vocab(dedup(tables["observations"]), "obs_type", observation_types, KEY),
        "rate": top_k_vocab(dedup(tables["labs"]), "test_name", max(panel_tests, rate_tests), KEY),
    }
    tests = vocab_values(top["rate"])
    return Vocabularies(
        observation_types=tuple(vocab_values(top["obs"])),
        panel_tests=tuple(tests[:panel_tests]),
        rate_tests=tuple(tests[:rate_tests]),
        drug_categories=tuple(fit_categories(dictionary, ["Category"], most_categories)["Category"]),
        chapters=tuple(fit_categories(chapters, ["chapter"], most_categories)["chapter"]),
    )


def drug_vocabulary(medication: DataFrame, k: int = 100) -> DataFrame:
    """The drugs a dictionary should cover."""
    return top_k_vocab(dedup(medication), "drug_name", k, KEY)


def save_vocabularies(spark: SparkSession, vocab: Vocabularies, generation: Generation) -> None:
    save_lists(spark, generation, "vocabularies", vars(vocab))


def load_vocabularies(spark: SparkSession, generation: Generation, most: int = 1000) -> Vocabularies:
    lists = load_lists(spark, generation, "vocabularies", most)
    return Vocabularies(**{name: tuple(values) for name, values in lists.items()})


# --- One table at a time ----------------------------------------------------


def diagnosis_features(
    diagnoses: DataFrame, chapters: Sequence[str] = tuple(ascii_uppercase)
) -> DataFrame:
    """0/1 per code chapter. Copies of a row cannot change it, so none are removed."""
    coded = diagnoses.where(F.col("diagnosis_cd_type") == "ICD10").select(
        KEY, code_chapter("diagnosis_cd").alias("chapter")
    )
    return presence_pivot(coded, KEY, "chapter", chapters, "ICD10_status_")


def medication_features(
    medication: DataFrame,
    dictionary: DataFrame,
    categories: Sequence[str],
    binary: bool = False,
) -> DataFrame:
    """Distinct drug rows per category of the dictionary; a doubled line counts twice.

    Rows of drugs without a category are dropped before the dedup, so they are never
    shuffled. A row carries the categories of its drug through it, each once with its
    number of lines.
    """
    listed = dictionary_join(medication, "drug_name", drug_lines(dictionary, categories), "Drug", "inner")
    rows = dedup_by(listed, KEY).select(KEY, F.inline("_categories"))
    return count_pivot(rows, KEY, "Category", categories, "Drug_count_", binary, "_lines")


def drug_lines(dictionary: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One row per drug that has a category: those of its categories that are asked for, each
    once with its number of lines, or an entry of no lines where none is."""
    valued = dictionary.where(F.col("Category").isNotNull() & F.col("Drug").isNotNull())
    none = F.struct(F.lit("").alias("Category"), F.lit(0).cast("bigint").alias("_lines"))
    counted = [
        F.struct(F.lit(value).alias("Category"), F.count_if(F.col("Category") == value).alias("_lines"))
        for value in categories
    ]
    lined = F.filter(F.array(none, *counted), lambda c: c["_lines"] > 0)
    return valued.groupBy("Drug").agg(
        F.when(F.size(lined) > 0, lined).otherwise(F.array(none)).alias("_categories")
    )


def lab_rates(labs: DataFrame, tests: Sequence[str]) -> DataFrame:
    """Share of results outside the normal range, per test."""
    rows = dedup_by(keep_in_vocab(labs, "test_name", tests), KEY)
    flagged = with_range_flag(rows, "test_result", "normal_range", "value_normal")
    return rate_pivot(flagged, KEY, "test_name", "value_normal", tests, "value_normal_")


def lab_panel(
    labs: DataFrame, tests: Sequence[str], measures: Sequence[Measure] = LAB_MEASURES
) -> DataFrame:
    """Panel of known results; a row with any gap adds its entity but no value."""
    rows = dedup_by(keep_in_vocab(drop_value(labs, "test_result", "unknown"), "test_name", tests), KEY)
    whole = reduce(and_, [F.col(c).isNotNull() for c in labs.columns])
    valued = rows.select(
        KEY, "test_name", F.when(whole, to_number("test_result")).alias("value")
    )
    return panel(valued, KEY, "test_name", "value", measures)


def lab_features(
    labs: DataFrame,
    panel_tests: Sequence[str],
    rate_tests: Sequence[str],
    measures: Sequence[Measure] = LAB_MEASURES,
) -> DataFrame:
    """Panel and abnormality rates from one dedup and one ``groupBy``.

    ``_in_panel`` and ``_in_rates`` say which of the two tables the entity is in.
    """
    both = sorted({*panel_tests, *rate_tests})
    rows = dedup_by(keep_in_vocab(labs, "test_name", both), KEY)
    known = ~F.col("test_result").eqNullSafe("unknown") & F.col("test_name").isin(*panel_tests)
    whole = reduce(and_, [F.col(c).isNotNull() for c in labs.columns])
    rated = F.when(F.col("test_name").isin(*rate_tests), F.col("_flag"))
    flagged = with_range_flag(rows, "test_result", "normal_range", "_flag")
    valued = flagged.where(present(KEY)).select(
        KEY,
        "test_name",
        known.alias("known"),
        F.when(known & whole, to_number("test_result")).alias("value"),
        rated.alias("flag"),
    )
    rates = [
        F.avg(F.when(F.col("test_name") == test, F.col("flag"))).alias(f"value_normal_{name}")
        for test, name in zip(rate_tests, slugs(rate_tests))
    ]
    return (
        valued.groupBy(KEY)
        .agg(
            F.max(F.col("known").cast("int")).alias("_in_panel"),
            F.max(F.col("flag").isNotNull().cast("int")).alias("_in_rates"),
            *measure_columns(F.col("test_name"), F.col("value"), measures),
            *rates,
        )
        .where((F.col("_in_panel") == 1) | (F.col("_in_rates") == 1))
    )


def observation_features(
    observations: DataFrame,
    types: Sequence[str],
    measures: Sequence[Measure] = OBSERVATION_MEASURES,
) -> DataFrame:
    """Numeric panel plus the smoking and drinking status of consistent entities."""
    found = observation_part(keep_in_vocab(observations, "obs_type", types), types, measures)
    return found.drop("_from_obs", "_to_obs", "_in_obs")


def demographics(demo: DataFrame) -> DataFrame:
    return demo.select(
        KEY,
        "birth_yr",
        "gender",
        "race",
        "ethnicity",
        "index_month_year",
        days_since("index_month_year").alias("index_month_year_from_begin"),
        after("index_month_year").alias("after_long_covid_start"),
        age(clean_year("birth_yr")).alias("age"),
    )


def known_immunizations(immunization: DataFrame, fill_names: bool = False) -> DataFrame:
    """Rows with a usable description and name; the description in upper case.

    ``fill_names`` derives a missing name from the description instead of dropping the
    row.
    """
    rows = immunization.withColumn("immunization_desc", norm_text("immunization_desc"))
    rows = rows.where(F.col("immunization_desc").isNotNull())
    if fill_names:
        missing = F.col("mapped_name").isNull()
        description = F.col("immunization_desc")
        rows = rows.withColumns(
            {
                "mapped_name": F.coalesce("mapped_name", vaccine_name(description)),
                "immunization_desc": F.when(
                    missing & is_covid(description), annotate_brand(description)
                ).otherwise(description),
            }
        )
    else:
        rows = rows.where(F.col("mapped_name").isNotNull())
    return drop_value(rows, "immunization_desc", UNSPECIFIED_IMMUNIZATION)


def immunization_features(
    immunization: DataFrame, fill_names: bool = False, strict: bool = False, spans: bool = False
) -> DataFrame:
    """Brands, latest flu kind and antigen flags per entity, in one shuffle.

    ``spans`` adds the first and last day.
    """
    rows = known_immunizations(immunization, fill_names).where(present(KEY))
    flags = substring_flags("mapped_name")
    marked = rows.select(
        KEY,
        DAY,
        "mapped_name",
        covid_brand("mapped_name", "immunization_desc").alias("_brand"),
        flu_kind("mapped_name", strict).alias("_flu"),
        *[flag.alias(name) for name, flag in flags.items()],
    )
    return marked.groupBy(KEY).agg(
        label_set(F.col("_brand")).alias("COVID_19"),
        F.coalesce(latest_value(F.col("_flu"), DAY, "mapped_name"), F.lit("")).alias("Influenza"),
        *[F.max(name).alias(name) for name in flags],
        *(_span(F.col(DAY), "imm") if spans else []),
    )


# --- All tables -------------------------------------------------------------


def dated_events(tables: Tables, fill_names: bool = False) -> dict[str, DataFrame]:
    """The rows of each event log that count for its span."""
    return {
        "dia": tables["diagnoses"],
        "med": tables["medication"],
        "lab": drop_value(tables["labs"], "test_result", "unknown"),
        "obs": tables["observations"],
        "imm": known_immunizations(tables["immunization"], fill_names),
    }


def source_spans(tables: Tables) -> dict[str, DataFrame]:
    return {
        name: entity_span(frame, KEY, DAY, name) for name, frame in dated_events(tables).items()
    }


def total_span(tables: Tables) -> DataFrame:
    return overall_span(list(dated_events(tables).values()), KEY, DAY)


# Each of the next four reads its event log once, for its features and its span together.
# Rows that count for the span alone keep nothing but entity and day.


def _span(day: Column, name: str) -> list[Column]:
    return [F.min(day).alias(f"_from_{name}"), F.max(day).alias(f"_to_{name}")]


def _seen(condition: Column, name: str) -> Column:
    """1 where a row of the entity meets the condition."""
    return F.max(F.coalesce(condition, F.lit(False)).cast("int")).alias(f"_in_{name}")


def _only(df: DataFrame, condition: Column, also: Sequence[str] = (KEY, DAY)) -> DataFrame:
    """Rows that fail the condition keep only the columns ``also``."""
    return df.select(
        *[F.col(c) if c in also else F.when(condition, F.col(c)).alias(c) for c in df.columns]
    )


#: Flags that one number tells, and the bits of a number that tell a category's place.
MASK, PLACE = 63, 20


def diagnosis_part(diagnoses: DataFrame, chapters: Sequence[str]) -> DataFrame:
    """A row sets one bit, so grouping costs the same for few and for many chapters."""
    coded = F.when(F.col("diagnosis_cd_type") == "ICD10", code_chapter("diagnosis_cd"))
    rows = diagnoses.where(present(KEY)).select(KEY, DAY, coded.alias("_chapter"))
    known = F.col("_chapter").isNotNull()
    values = list(dict.fromkeys(chapters))
    runs = [values[i : i + MASK] for i in range(0, len(values), MASK)]
    masks = [F.bit_or(F.when(known, _bit("_chapter", run))).alias(f"_bits{i}") for i, run in enumerate(runs)]

    def flag(value: str) -> Column:
        run, place = divmod(values.index(value), MASK)
        return F.getbit(f"_bits{run}", F.lit(place)).cast("int")

    flags = [flag(value).alias(f"ICD10_status_{name}") for value, name in zip(chapters, slugs(chapters))]
    found = rows.groupBy(KEY).agg(*_span(F.col(DAY), "dia"), _seen(known, "dia"), *masks)
    return found.select(KEY, "_from_dia", "_to_dia", "_in_dia", *flags)


def _place(value: Column | str, values: Sequence[str]) -> Column:
    """The place of a value in a list, from 1; 0 where it is not in it."""
    if not values:
        return F.lit(0).cast("bigint")
    return F.array_position(F.array(*[F.lit(v) for v in values]), value)


def _bit(col: str, run: Sequence[str]) -> Column:
    """A number whose one bit is the place of the value in the run; 0 for other values."""
    place = _place(F.col(col), run)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place - 1).cast("int"))
    return F.when(place > 0, one).otherwise(F.lit(0).cast("bigint"))


def medication_part(
    medication: DataFrame, dictionary: DataFrame, categories: Sequence[str]
) -> DataFrame:
    """A drug's categories ride through the dedup as numbers: place in the list and lines."""
    lines = drug_lines(dictionary, categories)
    packed = F.transform(
        "_categories", lambda c: F.shiftleft(c["_lines"], PLACE) + _place(c["Category"], categories)
    )
    lines = lines.withColumn("_categories", packed)
    listed = dictionary_join(medication, "drug_name", lines, "Drug", "left")
    known = F.col("_categories").isNotNull()
    rows = dedup_by(_only(listed.where(present(KEY)), known), KEY)
    each = rows.select(KEY, DAY, F.explode_outer("_categories").alias("_packed"))
    each = each.select(
        KEY, DAY, F.col("_packed").bitwiseAND((1 << PLACE) - 1).alias("_place"), F.shiftright("_packed", PLACE).alias("_lines")
    )
    known = F.col("_place").isNotNull()
    counts = [
        F.sum(F.when(F.col("_place") == categories.index(value) + 1, F.col("_lines")).when(known, 0)).alias(f"Drug_count_{name}")
        for value, name in zip(categories, slugs(categories))
    ]
    return each.groupBy(KEY).agg(*_span(F.col(DAY), "med"), _seen(known, "med"), *counts)


def lab_part(
    labs: DataFrame,
    panel_tests: Sequence[str],
    rate_tests: Sequence[str],
    measures: Sequence[Measure] = LAB_MEASURES,
) -> DataFrame:
    wanted = F.coalesce(F.col("test_name").isin(*{*panel_tests, *rate_tests}), F.lit(False))
    dated = ~F.col("test_result").eqNullSafe("unknown")
    rows = dedup_by(_only(labs.where(present(KEY) & (wanted | dated)), wanted), KEY)
    wanted, panelled = F.col("test_name").isNotNull(), F.col("test_name").isin(*panel_tests)
    flagged = with_range_flag(rows, "test_result", "normal_range", "_flag")
    known = wanted & dated & panelled
    whole = reduce(and_, [F.col(c).isNotNull() for c in labs.columns])
    valued = flagged.select(
        KEY,
        "test_name",
        F.when(dated, F.col(DAY)).alias(DAY),
        dated.alias("dated"),
        known.alias("known"),
        F.when(known & whole, to_number("test_result")).alias("value"),
        F.when(F.col("test_name").isin(*rate_tests), F.col("_flag")).alias("flag"),
    )
    rates = [
        F.avg(F.when(F.col("test_name") == test, F.col("flag"))).alias(f"value_normal_{name}")
        for test, name in zip(rate_tests, slugs(rate_tests))
    ]
    found = valued.groupBy(KEY).agg(
        *_span(F.col(DAY), "lab"),
        _seen(F.col("dated"), "lab_span"),
        _seen(F.col("known"), "panel"),
        _seen(F.col("flag").isNotNull(), "rates"),
        *measure_columns(F.col("test_name"), F.col("value"), measures),
        *rates,
    )
    anything = F.greatest("_in_lab_span", "_in_panel", "_in_rates") == 1
    return found.where(anything).drop("_in_lab_span")


def observation_part(
    observations: DataFrame,
    types: Sequence[str],
    measures: Sequence[Measure] = OBSERVATION_MEASURES,
) -> DataFrame:
    """The numeric panel, and the smoking and drinking status where all known values agree."""
    wanted = F.coalesce(F.col("obs_type").isin(*types), F.lit(False))
    rows = dedup_by(_only(observations.where(present(KEY)), wanted), KEY)
    dated = F.col(DAY).isNotNull()
    valued = rows.select(
        KEY,
        DAY,
        F.col("obs_type").isNotNull().alias("known"),
        label_with_unit("obs_type", "obs_unit").alias("label"),
        F.when(dated, to_number("obs_result")).alias("value"),
        "obs_result",
    )
    smoke = F.when(F.col("label") == SMOKE_LABEL, F.col("obs_result"))
    alcohol = F.when((F.col("label") == ALCOHOL_LABEL) & dated, F.col("obs_result"))
    found = valued.groupBy(KEY).agg(
        *_span(F.col(DAY), "obs"),
        _seen(F.col("known"), "obs"),
        *measure_columns(F.col("label"), F.col("value"), measures),
        *[f(c).alias(n) for c, n in ((smoke, "SMOKE"), (alcohol, "ALCOHOL")) for f, n in ((F.min, f"_{n}"), (F.max, n))],
    )
    agreed = {c: F.when(F.col(f"_{c}") == F.col(c), F.col(c)) for c in ("SMOKE", "ALCOHOL")}
    return found.withColumns(agreed).drop("_SMOKE", "_ALCOHOL")


def feature_tables(
    tables: Tables,
    dictionary: DataFrame,
    vocab: Vocabularies,
    measures: Sequence[Measure] = LAB_MEASURES,
) -> list[DataFrame]:
    """The tables a master is merged from, each one row per entity, each from one scan."""
    return [
        diagnosis_part(tables["diagnoses"], vocab.chapters),
        medication_part(tables["medication"], dictionary, vocab.drug_categories),
        lab_part(tables["labs"], vocab.panel_tests, vocab.rate_tests, measures),
        observation_part(tables["observations"], vocab.observation_types),
        # Laid out by entity like the aggregates, so the merge has nothing left to move.
        demographics(tables["demo"]).repartition(KEY),
        immunization_features(tables["immunization"], spans=True),
    ]


def master(
    tables: Tables,
    dictionary: DataFrame,
    vocab: Vocabularies,
    how: str = "outer",
    measures: Sequence[Measure] = LAB_MEASURES,
) -> DataFrame:
    """All features of every entity (outer) or of the entities every table knows (inner)."""
    frames = feature_tables(tables, dictionary, vocab, measures)
    if how == "outer":
        merged = merge_outer(frames, KEY)
    else:
        known = [F.col(f"_in_{n}") == 1 for n in ("dia", "med", "panel", "rates", "obs")]
        merged = merge_inner(frames, KEY).where(reduce(and_, known))
    sources = ("dia", "med", "lab", "obs", "imm")
    return merged.select(
        KEY,
        row_min([f"_from_{s}" for s in sources]).alias("earliest_to_covid_diag"),
        row_max([f"_to_{s}" for s in sources]).alias("latest_to_covid_diag"),
        *[c for c in merged.columns if c != KEY and not c.startswith(("_in_", "_from_", "_to_"))],
    )


def clean_matrix(
    master_table: DataFrame,
    target: DataFrame | None,
    categories: Mapping[str, Sequence[str]],
    pattern: str | None = UNKNOWN_BROAD,
) -> DataFrame:
    """Numeric matrix: label joined, text coerced, categories encoded, unknowns dropped."""
    rows = master_table if target is None else inner_on(master_table, target, KEY)
    coerced = coerce_columns(rows, [c for c in COERCED if c in rows.columns])
    encoded = one_hot(coerced, categories).drop(*DATES)
    if pattern is None:
        return encoded
    return drop_columns_matching(encoded, pattern, keep=(KEY, LABEL))


def fit_master_categories(master_table: DataFrame, most: int = 1000) -> dict[str, list[str]]:
    return fit_categories(master_table, CATEGORICAL, most)


# --- Profiles ---------------------------------------------------------------


def profile_value_counts(tables: Tables, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(table, column, value, n)`` of the named columns, one scan per table."""
    parts = [
        all_value_counts(tables[name], cols).select(
            F.lit(name).alias("table"), "column", "value", "n"
        )
        for name, cols in columns.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def profile_sizes(tables: Tables, key: str = KEY) -> DataFrame:
    """Rows and distinct entities per table; rows per entity are counted first."""
    parts = []
    for name, frame in tables.items():
        rows = frame.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            rows.agg(F.sum("n").alias("rows"), F.count(key).alias("entities")).select(
                F.lit(name).alias("table"), "rows", "entities"
            )
        )
    return reduce(DataFrame.unionByName, parts)
