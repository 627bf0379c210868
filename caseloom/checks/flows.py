"""Queries over the composed flows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from caseloom.checks import sql
from caseloom.checks.aggregates import (
    KNOWN_SQL,
    LAB_MEASURES,
    LETTERS,
    TESTS,
    measures_sql,
)
from caseloom.checks.fixtures import VIEWS, view, with_views
from caseloom.checks.registry import query, rounded
from caseloom.checks.rows import CATEGORIES, YEAR, scratch
from caseloom.functions.scalars import slugs
from caseloom.operators.aggregates import count_pivot, top_k_vocab, vocab_values
from caseloom.plans import features as ft
from caseloom.plans import train as tr
from caseloom.sources import store as generations

KEY = ft.KEY
PANEL_TESTS = ("click", "purchase", "view")
OBSERVED = ("ALCOHOL", "BMI", "PAIN", "SBP", "SMOKE")
VOCAB = ft.Vocabularies(OBSERVED, PANEL_TESTS, TESTS, CATEGORIES)

EVENTS = ("diagnoses", "medication", "labs", "observations", "immunization")


def tables(spark: SparkSession, folder: str, labelled: bool = True) -> dict[str, DataFrame]:
    names = [*EVENTS, "demo", *(["target"] if labelled else [])]
    return {n: view(spark, folder, n) for n in names}


# Each text below is one common table expression named after its flow.

DIAGNOSES = "select patientid, " + ", ".join(
    f"max(case when substr(coalesce(diagnosis_cd, 'None'), 1, 1) = '{x}' then 1 else 0 end) "
    f"as ICD10_status_{x}"
    for x in LETTERS
) + " from diagnoses where diagnosis_cd_type = 'ICD10' group by patientid"


def medication_sql(close: str = "as bigint)", words: str = "drug_dictionary") -> str:
    return "select patientid, " + ", ".join(
        f"cast(sum(case when Category = '{c}' then 1 else 0 end) {close} as Drug_count_{s}"
        for c, s in zip(CATEGORIES, slugs(CATEGORIES))
    ) + f""" from (select distinct * from medication) join {words} on drug_name = Drug
      where Category is not null group by patientid"""


RATES = "select patientid, " + ", ".join(
    f"round(avg(case when test_name = '{t}' then value_normal::double end), 9) as value_normal_{t}"
    for t in TESTS
) + f""" from ({sql.range_flag('(select distinct * from labs)')})
  where value_normal is not null group by patientid"""

LAB_WHOLE = " and ".join(
    f"{c} is not null"
    for c in (
        "test_type", "test_name", "days_to_covid_diag", "test_result", "result_unit",
        "normal_range",
    )
)
LABS = f"""select patientid, {measures_sql('test_name', 'v', LAB_MEASURES)} from (
    select *, case when {LAB_WHOLE} then {sql.number('test_result')} end as v
    from (select distinct * from labs)
    where test_result is distinct from 'unknown' and test_name in ('click', 'purchase', 'view'))
  group by patientid"""

LABELLED = f"""(select *, concat(obs_type, '(', coalesce(obs_unit, 'None'), ')') as label,
    case when days_to_covid_diag is not null then {sql.number('obs_result')} end as v
    from (select distinct * from observations))"""


def status_sql(name: str, label: str, test: str = "true") -> str:
    return f"""select patientid, max(obs_result) as {name} from {LABELLED}
      where label = '{label}' and {test} group by patientid
      having count(distinct obs_result) = 1"""


OBSERVATIONS = f"""select * from (
    select patientid, {measures_sql('label', 'v', ft.OBSERVATION_MEASURES)}
    from {LABELLED} group by patientid)
  left join ({status_sql('SMOKE', ft.SMOKE_LABEL)}) using (patientid)
  left join ({status_sql('ALCOHOL', ft.ALCOHOL_LABEL, 'days_to_covid_diag is not null')})
    using (patientid)"""

DEMO = f"""select patientid, birth_yr, gender, race, ethnicity, index_month_year,
    cast(date_diff('day', date '2020-01-01', cast(index_month_year as date)) as int)
      as index_month_year_from_begin,
    cast(index_month_year > timestamp '2021-06-01' as int) as after_long_covid_start,
    2021 - ({YEAR}) as age from demo"""

IMMUNIZATIONS = f"""select patientid,
    coalesce(string_agg(distinct brand, ',' order by brand), '') as COVID_19,
    coalesce(arg_max(kind, row(days_to_covid_diag, mapped_name)) filter (kind is not null), '')
      as Influenza,
    {", ".join(f"max({e}) as {f}" for f, e in sql.antigen_flags('mapped_name').items())}
  from (select *, {sql.brand('mapped_name', 'immunization_desc')} as brand,
          {sql.flu('mapped_name')} as kind from known) group by patientid"""

SPANS = """select patientid, min(d) as earliest_to_covid_diag, max(d) as latest_to_covid_diag from (
    select patientid, days_to_covid_diag as d from diagnoses
    union all select patientid, days_to_covid_diag from medication
    union all select patientid, days_to_covid_diag from labs
      where test_result is distinct from 'unknown'
    union all select patientid, days_to_covid_diag from observations
    union all select patientid, days_to_covid_diag from known) group by patientid"""


def composed(parts: dict[str, str], body: str, views: tuple[str, ...] = ()) -> str:
    names = views or tuple(VIEWS)
    head = with_views(names, "").rstrip()
    if "immunization" in names:
        head += ",\n" + KNOWN_SQL
    for name, part in parts.items():
        head += f",\n{name} as ({part})"
    return head + "\n" + body


@query("diagnosis_features", with_views(["diagnoses"], DIAGNOSES))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ft.diagnosis_features(view(spark, folder, "diagnoses"))


@query("medication_features", with_views(["medication", "drug_dictionary"], medication_sql()))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ft.medication_features(
        view(spark, folder, "medication"), view(spark, folder, "drug_dictionary"), CATEGORIES
    )


@query(
    "medication_features_doubled_lines",
    with_views(["medication", "doubled_dictionary"], medication_sql(words="doubled_dictionary")),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ft.medication_features(
        view(spark, folder, "medication"), view(spark, folder, "doubled_dictionary"), CATEGORIES
    )


@query(
    "medication_features_binary",
    with_views(["medication", "drug_dictionary"], medication_sql("<> 0 as int)")),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ft.medication_features(
        view(spark, folder, "medication"), view(spark, folder, "drug_dictionary"), CATEGORIES,
        binary=True,
    )


@query("lab_rates", with_views(["labs"], RATES))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ft.lab_rates(view(spark, folder, "labs"), TESTS), 9)


@query("lab_panel", with_views(["labs"], LABS))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ft.lab_panel(view(spark, folder, "labs"), PANEL_TESTS, LAB_MEASURES), 9)


@query(
    "lab_features_one_pass",
    composed(
        {"lab_panel": LABS, "lab_rates": RATES},
        "select * from lab_panel full outer join lab_rates using (patientid)",
        ("labs",),
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    labs = view(spark, folder, "labs")
    both = ft.lab_features(labs, PANEL_TESTS, TESTS, LAB_MEASURES)
    return rounded(both.drop("_in_panel", "_in_rates"), 9)


@query("observation_features", with_views(["observations"], OBSERVATIONS))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ft.observation_features(view(spark, folder, "observations"), OBSERVED), 9)


@query("demographics", with_views(["demo"], DEMO))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ft.demographics(view(spark, folder, "demo"))


@query("immunization_features", composed({}, IMMUNIZATIONS, ("immunization",)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ft.immunization_features(view(spark, folder, "immunization"))


@query("total_span", composed({}, SPANS, EVENTS))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ft.total_span(tables(spark, folder))


PARTS = {
    "t_span": SPANS,
    "t_dia": DIAGNOSES,
    "t_med": medication_sql(),
    "t_lab": LABS,
    "t_rate": RATES,
    "t_obs": OBSERVATIONS,
    "t_demo": DEMO,
    "t_imm": IMMUNIZATIONS,
}


def master_sql(how: str) -> str:
    first, *rest = PARTS
    joins = " ".join(f"{how} join {name} using (patientid)" for name in rest)
    return f"select * from {first} {joins}"


def build_master(spark: SparkSession, folder: str, how: str = "outer") -> DataFrame:
    return ft.master(
        tables(spark, folder), view(spark, folder, "drug_dictionary"), VOCAB, how, LAB_MEASURES
    )


@query("master_outer", composed(PARTS, master_sql("full outer")))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(build_master(spark, folder), 9)


@query("master_inner", composed(PARTS, master_sql("inner")))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(build_master(spark, folder, "inner"), 9)


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CATEGORY_VALUES = {
    "ethnicity": ("Hispanic", "Not Hispanic", "Unknown"),
    "race": SEGMENTS,
    "ALCOHOL": ("Current", "Never"),
    "SMOKE": ("Current", "Never"),
    "gender": ("F", "M", "Unknown"),
    "Influenza": ("Live", "Unspecified"),
    "COVID_19": ("JNJ", "PFIZER", "JNJ,PFIZER"),
}


def clean_sql(drop_unknown: bool) -> str:
    hot = [
        f"cast({c} is not distinct from {sql.text(v)} as int) as {c}_{s}"
        for c, values in CATEGORY_VALUES.items()
        for v, s in zip(values, slugs(values))
        if not (drop_unknown and "un" in f"{c}_{s}".lower())
    ]
    drop = [*CATEGORY_VALUES, *ft.DATES]
    if drop_unknown:
        drop += [f"Drug_count_{s}" for s in slugs(CATEGORIES)]
    return f"""select * exclude ({', '.join(drop)}), {', '.join(hot)}
               from master join target using (patientid)"""


PARTS_AND_MASTER = {**PARTS, "master": master_sql("full outer")}


@query("clean_matrix", composed(PARTS_AND_MASTER, clean_sql(True)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    master = build_master(spark, folder)
    return rounded(ft.clean_matrix(master, view(spark, folder, "target"), CATEGORY_VALUES), 9)


@query("clean_matrix_all_columns", composed(PARTS_AND_MASTER, clean_sql(False)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    target = view(spark, folder, "target")
    cleaned = ft.clean_matrix(build_master(spark, folder), target, CATEGORY_VALUES, pattern=None)
    return rounded(cleaned, 9)


@query(
    "fit_vocabularies",
    with_views(
        ["observations", "labs", "drug_dictionary", "diagnoses"],
        """select 'observation_types' as list, obs_type as value,
             cast(row_number() over (order by n desc, obs_type) - 1 as int) as rank
           from (select obs_type, count(patientid) as n from (select distinct * from observations)
                 group by obs_type)
           qualify rank < 4
           union all
           select list, test_name, rank from (
             select test_name, cast(row_number() over (order by n desc, test_name) - 1 as int) as rank
             from (select test_name, count(patientid) as n from (select distinct * from labs)
                   group by test_name))
           join (values ('panel_tests', 3), ('rate_tests', 4)) t(list, k) on rank < k
           union all
           select 'drug_categories', Category, cast(row_number() over (order by Category) - 1 as int)
           from (select distinct Category from drug_dictionary where Category is not null)
           union all
           select 'chapters', chapter, cast(row_number() over (order by chapter) - 1 as int)
           from (select distinct substr(coalesce(diagnosis_cd, 'None'), 1, 1) as chapter
                 from diagnoses where diagnosis_cd_type = 'ICD10')""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    fitted = ft.fit_vocabularies(
        {n: view(spark, folder, n) for n in ("observations", "labs", "diagnoses")},
        view(spark, folder, "drug_dictionary"),
        4, 3, 4,
    )
    lists = ("observation_types", "panel_tests", "rate_tests", "drug_categories", "chapters")
    rows = [(n, v, i) for n in lists for i, v in enumerate(getattr(fitted, n))]
    return spark.createDataFrame(rows, "list string, value string, rank int")


PROFILED = {
    "demo": ("birth_yr", "gender", "race", "ethnicity"),
    "diagnoses": ("days_to_covid_diag", "diagnosis_cd", "diagnosis_cd_type"),
    "immunization": ("days_to_covid_diag", "immunization_desc", "mapped_name"),
    "labs": ("test_type", "days_to_covid_diag", "test_result", "result_unit", "normal_range"),
    "medication": ("days_to_covid_diag", "drug_name", "ndc"),
    "observations": ("obs_type", "obs_result", "obs_unit", "days_to_covid_diag"),
    "target": ("has_long_covid_diag",),
}


@query(
    "profile_value_counts",
    with_views(
        list(PROFILED),
        " union all ".join(
            f"""select '{t}' as "table", '{c}' as "column", cast({c} as string) as value,
                count(*) as n from {t} where {c} is not null group by {c}"""
            for t, cols in PROFILED.items()
            for c in cols
        ),
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ft.profile_value_counts(tables(spark, folder), PROFILED)


@query(
    "profile_table_sizes",
    with_views(
        list(PROFILED),
        " union all ".join(
            f"""select '{t}' as "table", count(*) as rows,
                count(distinct patientid) as entities from {t}"""
            for t in PROFILED
        ),
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ft.profile_sizes({n: t for n, t in tables(spark, folder).items() if n in PROFILED})


HELD_OUT = with_views(
    ["target"],
    f"""select count(*) filter (has_long_covid_diag = 1) as positives,
          count(*) filter (has_long_covid_diag = 0) as negatives, true as fits
        from target where {sql.fraction('patientid', tr.SEED)} < {tr.TEST_SHARE}""",
)


def held_out_facts(measured: DataFrame) -> DataFrame:
    """Held-out rows of both classes, and whether the metrics fit them and each other."""
    called = F.col("tp") + F.col("fp")
    fits = (
        (F.col("tp") + F.col("fn") == F.col("positives"))
        & (called + F.col("fn") + F.col("tn") == F.col("positives") + F.col("negatives"))
        & F.col("auc").between(0, 1)
        & F.col("average_precision").between(0, 1)
        # A thresholded score has two steps, so its area follows from the two rates.
        & (F.abs(F.col("auc_hard") - (1 + F.col("sensitivity") - F.col("fpr")) / 2) < 1e-4)
    )
    return measured.select("positives", "negatives", fits.alias("fits"))


@query("train_and_evaluate", HELD_OUT)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return held_out_facts(
        tr.train_on(
            spark,
            tables(spark, folder),
            view(spark, folder, "drug_dictionary"),
            scratch(spark, "store"),
            VOCAB,
            LAB_MEASURES,
        )
    )


#: Test names that differ in blanks and line breaks alone (fixed values), by the plain name.
ODD_NAMES = {"click": "click ", "view": "click", "error": "cli\nck", "purchase": " "}


@query(
    "pivot_by_saved_values",
    with_views(
        ["labs"],
        """select patientid, case test_name when 'click' then 'click ' when 'view' then 'click'
             when 'error' then 'cli' || chr(10) || 'ck' when 'purchase' then ' ' else test_name end as value,
             count(*) as n from labs where test_name is not null group by all""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Counts by a list of values that was fitted, saved and read again."""
    plain = F.col("test_name")
    odd = reduce(lambda c, pair: c.when(plain == pair[0], pair[1]), ODD_NAMES.items(), F.when(plain.isNull(), None))
    labs = view(spark, folder, "labs").withColumn("test_name", odd.otherwise(plain))
    generation = generations.begin(scratch(spark, "lists"))
    fitted = vocab_values(top_k_vocab(labs, "test_name", 100))
    generations.save_lists(spark, generation, "vocabularies", {"tests": fitted})
    values = generations.load_lists(spark, generation, "vocabularies")["tests"]
    wide = count_pivot(labs, KEY, "test_name", values, "n_")
    cells = [F.struct(F.lit(v).alias("value"), F.col(c).alias("n")) for v, c in zip(values, wide.columns[1:])]
    return wide.select(KEY, F.inline(F.array(*cells))).where("n > 0")


@query(
    "train_save_load_score",
    with_views(
        ["demo"],
        """select 'even' as batch, patientid, true as sums from demo
             where cast(substr(patientid, 2) as bigint) % 2 = 0
           union all select 'third', patientid, true from demo
             where cast(substr(patientid, 2) as bigint) % 3 = 0""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of entities, that share some, scored one after the other under one store."""
    store = scratch(spark, "store")
    words = view(spark, folder, "drug_dictionary")
    tr.train_on(spark, tables(spark, folder), words, store, VOCAB, LAB_MEASURES)
    number, parts = F.substring(KEY, 2, 20).cast("bigint"), []
    for name, every in (("even", 2), ("third", 3)):
        batch = {
            n: t.where(number % every == 0) for n, t in tables(spark, folder, labelled=False).items()
        }
        scored = tr.score_on(spark, batch, words, store, f"{store}/{name}", LAB_MEASURES)
        sums = F.abs(F.col("prediction") + F.col("p_positive") - 1) < 1e-12
        parts.append(scored.select(F.lit(name).alias("batch"), KEY, sums.alias("sums")))
    return parts[0].unionByName(parts[1])

