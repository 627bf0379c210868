"""Queries over spans, pivots, panels, vocabularies and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from caseloom.checks import sql
from caseloom.checks.fixtures import base, view, with_views
from caseloom.checks.registry import query, rounded
from caseloom.checks.rows import NORMALISED
from caseloom.functions import rules, scalars
from caseloom.operators import aggregates as ag
from caseloom.operators import columns, quantiles, rows
from caseloom.operators.aggregates import Measure
from caseloom.operators.merge import merge_outer
from caseloom.plans.features import DAY, KEY, earliest_panel, known_immunizations

TESTS = ("click", "error", "purchase", "signup", "view")
LAB_MEASURES = (
    Measure("click", "Click", ("min", "mean"), high=60),
    Measure("purchase", "Purchase"),
    Measure("view", "View"),
)
LETTERS = tuple("ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def measures_sql(label: str, value: str, measures: tuple[Measure, ...], digits: int = 9) -> str:
    parts = []
    for m in measures:
        test = f"{label} = {sql.text(m.label)}"
        if m.high is not None:
            test += f" and {value} <= {m.high}"
        for stat in m.stats:
            call = {"mean": "avg"}.get(stat, stat)
            parts.append(
                f"round({call}(case when {test} then {value} end), {digits}) as {m.prefix}_{stat}"
            )
    return ", ".join(parts)


# --- Spans ------------------------------------------------------------------


@query(
    "entity_span",
    with_views(
        ["labs"],
        """select patientid, min(days_to_covid_diag) as earliest_lab_response_to_covid_diag,
             max(days_to_covid_diag) as latest_lab_response_to_covid_diag
           from labs where test_result is distinct from 'unknown' group by patientid""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    labs = rows.drop_value(view(spark, folder, "labs"), "test_result", "unknown")
    return ag.entity_span(labs, KEY, DAY, "lab")


@query(
    "order_span",
    """select o_custkey, min(o_orderkey) as earliest_to_covid_diag,
         max(o_orderkey) as latest_to_covid_diag from orders group by o_custkey""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.entity_span(base(spark, folder, "orders"), "o_custkey", "o_orderkey")


SPANNED = ("diagnoses", "medication", "labs")
OVERALL = with_views(
    SPANNED,
    "select patientid, min(d) as earliest_to_covid_diag, max(d) as latest_to_covid_diag from ("
    + " union all ".join(f"select patientid, days_to_covid_diag as d from {t}" for t in SPANNED)
    + ") group by patientid",
)


@query("overall_span", OVERALL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.overall_span([view(spark, folder, t) for t in SPANNED], KEY, DAY)


@query("overall_span_by_columns", OVERALL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    spans = [ag.entity_span(view(spark, folder, t), KEY, DAY, t) for t in SPANNED]
    return ag.span_of_spans(
        merge_outer(spans, KEY),
        KEY,
        [f"earliest_{t}_response_to_covid_diag" for t in SPANNED],
        [f"latest_{t}_response_to_covid_diag" for t in SPANNED],
    )


# --- Pivots -----------------------------------------------------------------


@query(
    "presence_pivot",
    with_views(
        ["diagnoses"],
        "select patientid, "
        + ", ".join(
            f"max(case when substr(diagnosis_cd, 1, 1) = '{x}' then 1 else 0 end) as ch_{x}"
            for x in LETTERS
        )
        + " from diagnoses group by patientid",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    coded = view(spark, folder, "diagnoses").select(
        KEY, scalars.code_chapter("diagnosis_cd", null_token=None).alias("chapter")
    )
    return ag.presence_pivot(coded, KEY, "chapter", LETTERS, "ch_")


FLAGS = ("A", "N", "R")


def _flag_counts(suffix: str) -> str:
    return (
        "select l_orderkey, "
        + ", ".join(
            f"cast(sum(case when l_returnflag = '{f}' then 1 else 0 end){suffix}" f" as flag_{f}"
            for f in FLAGS
        )
        + " from lineitem group by l_orderkey"
    )


@query("count_pivot", _flag_counts(" as bigint)"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = base(spark, folder, "lineitem")
    return ag.count_pivot(lines, "l_orderkey", "l_returnflag", FLAGS, "flag_")


@query("count_pivot_binary", _flag_counts(" <> 0 as int)"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = base(spark, folder, "lineitem")
    return ag.count_pivot(lines, "l_orderkey", "l_returnflag", FLAGS, "flag_", binary=True)


@query(
    "rate_pivot",
    with_views(
        ["labs"],
        "select patientid, "
        + ", ".join(
            f"round(avg(case when test_name = '{t}' then value_normal::double end), 9) as out_{t}"
            for t in TESTS
        )
        + f" from ({sql.range_flag('labs')}) where value_normal is not null group by patientid",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    flagged = view(spark, folder, "labs").select(
        KEY, "test_name", scalars.range_flag("test_result", "normal_range").alias("flag")
    )
    return rounded(ag.rate_pivot(flagged, KEY, "test_name", "flag", TESTS, "out_"), 9)


def _valued_labs(spark: SparkSession, folder: str) -> DataFrame:
    labs = view(spark, folder, "labs")
    return labs.select(KEY, "test_name", scalars.to_number("test_result").alias("value"))


PANEL_SQL = with_views(
    ["labs"],
    f"""select patientid, {measures_sql('test_name', 'v', LAB_MEASURES)}
        from (select *, {sql.number('test_result')} as v from labs) group by patientid""",
)


@query("measurement_panel", PANEL_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    valued = _valued_labs(spark, folder)
    return rounded(ag.panel(valued, KEY, "test_name", "value", LAB_MEASURES), 9)


def panel_by_joins(
    df: DataFrame, key: str, label: str, value: str, measures: list[Measure]
) -> DataFrame:
    """The same table as a left join per measure from the entity spine.

    Costs a scan and a shuffle per measure; it is here to show that both forms agree.
    """
    wide = df.where(ag.present(key)).select(key).distinct()
    for m in measures:
        one = df.where(F.col(label) == m.label).groupBy(key)
        wide = wide.join(
            one.agg(*ag.measure_columns(F.col(label), F.col(value), [m])), key, "left"
        )
    return wide


@query("measurement_panel_by_joins", PANEL_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    valued = _valued_labs(spark, folder)
    return rounded(panel_by_joins(valued, KEY, "test_name", "value", LAB_MEASURES), 9)


@query(
    "measurement_panel_single_statistic",
    with_views(
        ["labs"],
        f"""select patientid, {measures_sql('test_name', 'v', earliest_panel(LAB_MEASURES))}
            from (select *, {sql.number('test_result')} as v from labs) group by patientid""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    measures = earliest_panel(LAB_MEASURES)
    return rounded(ag.panel(_valued_labs(spark, folder), KEY, "test_name", "value", measures), 9)


SMOKE = "obs_type = 'SMOKE' and obs_unit is null"


@query(
    "consistent_label",
    with_views(
        ["observations"],
        f"""select patientid, max(obs_result) as smoke from observations where {SMOKE}
            group by patientid having count(distinct obs_result) = 1""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    smoke = view(spark, folder, "observations").where(SMOKE)
    return ag.consistent_label(smoke.select(KEY, F.col("obs_result").alias("smoke")), KEY, "smoke")


@query(
    "consistent_label_with_null_rows",
    """with s as (select o_custkey as id,
                    case when o_orderstatus = 'P' then null else o_orderpriority end as priority
                  from orders)
       select distinct id, priority from s where id in (
         select id from s group by id having count(distinct priority) = 1)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    orders = base(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"), priority.alias("priority")
    )
    return ag.consistent_label(orders, "id", "priority", keep_null_rows=True)


# --- Text profiles ----------------------------------------------------------

KNOWN_SQL = f"""known as (select patientid, days_to_covid_diag, d as immunization_desc, mapped_name
  from (select *, {NORMALISED} as d from immunization)
  where d is not null and mapped_name is not null and d <> 'UNSPECIFIED IMMUNIZATION')"""
KNOWN = with_views(["immunization"], "").rstrip() + ",\n" + KNOWN_SQL + "\n"


@query(
    "antigen_profile",
    KNOWN
    + "select patientid, "
    + ", ".join(f"max({e}) as {f}" for f, e in sql.antigen_flags("mapped_name").items())
    + " from known group by patientid",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    known = known_immunizations(view(spark, folder, "immunization"))
    return ag.flag_profile(known, KEY, rules.substring_flags("mapped_name"))


@query(
    "latest_flu_kind",
    KNOWN
    + f"""select patientid, arg_max(kind, row(days_to_covid_diag, mapped_name)) as flu
          from (select *, {sql.flu('mapped_name')} as kind from known) where kind is not null
          group by patientid""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    known = known_immunizations(view(spark, folder, "immunization"))
    kinds = known.withColumn("kind", rules.flu_kind("mapped_name"))
    latest = ag.latest_value(F.col("kind"), DAY, "mapped_name")
    return kinds.groupBy(KEY).agg(latest.alias("flu")).where(F.col("flu").isNotNull())


@query(
    "brand_set",
    KNOWN
    + f"""select patientid, coalesce(string_agg(distinct brand, ',' order by brand), '') as brands
          from (select *, {sql.brand('mapped_name', 'immunization_desc')} as brand from known)
          group by patientid""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    known = known_immunizations(view(spark, folder, "immunization"))
    brands = known.withColumn("brand", rules.covid_brand("mapped_name", "immunization_desc"))
    return brands.groupBy(KEY).agg(ag.label_set(F.col("brand")).alias("brands"))


# --- Vocabularies -----------------------------------------------------------


@query(
    "value_counts",
    with_views(
        ["diagnoses"],
        """select diagnosis_cd, count(*) as n from diagnoses where diagnosis_cd is not null
           group by diagnosis_cd""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.value_counts(view(spark, folder, "diagnoses"), "diagnosis_cd")


TOP_CODES = """select code as value, cast(row_number() over (order by n desc, code) - 1 as int)
    as rank, n from (select code, count(patientid) as n from (
      select distinct patientid, days_to_covid_diag, diagnosis_cd, diagnosis_cd_type,
        diagnosis_cd || '_' || diagnosis_cd_type as code from diagnoses)
    where code is not null group by code) order by n desc, code limit 200"""


def _coded(spark: SparkSession, folder: str) -> DataFrame:
    code = scalars.concat_key("diagnosis_cd", "diagnosis_cd_type")
    return rows.dedup(view(spark, folder, "diagnoses")).withColumn("code", code)


@query("top_k_vocab", with_views(["diagnoses"], TOP_CODES))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.top_k_vocab(_coded(spark, folder), "code", 200, KEY)


@query(
    "top_k_vocab_excluding",
    with_views(
        ["labs"],
        """select test_name as value, n,
             cast(row_number() over (order by n desc, test_name) - 1 as int) as rank
           from (select test_name, count(patientid) as n from (select distinct * from labs)
                 where test_result is distinct from 'unknown' group by test_name)
           order by n desc, test_name limit 3""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.top_k_vocab(
        rows.dedup(view(spark, folder, "labs")), "test_name", 3, KEY,
        exclude=F.col("test_result") == "unknown",
    )


@query(
    "vocab_coverage",
    with_views(["diagnoses"], "").rstrip()
    + f""",
 top as ({TOP_CODES}),
 c as (select distinct *, diagnosis_cd || '_' || diagnosis_cd_type as code from diagnoses)
 select count(*) as rows,
   cast(sum(case when code in (select value from top) then 1 else 0 end) as bigint) as kept,
   count(distinct code) as values,
   round(sum(case when code in (select value from top) then 1 else 0 end)::double
         / count(*), 9) as share
 from c""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    coded = _coded(spark, folder)
    vocab = ag.top_k_vocab(coded, "code", 200, KEY)
    return rounded(ag.vocab_coverage(coded, "code", vocab, KEY), 9)


# --- Reports ----------------------------------------------------------------


@query(
    "dedup_ratio",
    with_views(
        ["medication"],
        """select (select count(*) from medication) as rows,
             (select count(*) from (select distinct * from medication)) as distinct_rows,
             round((select count(*) from (select distinct * from medication))::double
                   / (select count(*) from medication), 9) as kept""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ag.dedup_ratio(view(spark, folder, "medication")), 9)


COUNTED = ("patientid", "test_name", "test_result", "normal_range")


@query(
    "distinct_count",
    with_views(
        ["labs"],
        " union all ".join(
            f"select '{c}' as column, count(distinct {c}) as n from labs" for c in COUNTED
        ),
    ).replace("as column", 'as "column"'),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.distinct_count(view(spark, folder, "labs"), COUNTED)


@query(
    "distinct_count_approximate",
    with_views(
        ["labs"],
        " union all ".join(
            f"""select '{c}' as "column", count(distinct {c}) as exact, true as near from labs"""
            for c in COUNTED
        ),
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Exact counts, and whether the approximate ones are within a tenth of them."""
    labs = view(spark, folder, "labs")
    exact = ag.distinct_count(labs, COUNTED).select("column", F.col("n").alias("exact"))
    near = F.abs(F.col("n") - F.col("exact")) <= 0.1 * F.col("exact")
    rough = ag.distinct_count(labs, COUNTED, approximate=True)
    return rough.join(exact, "column").select("column", "exact", near.alias("near"))


DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "describe_columns",
    " union all ".join(
        f"""select '{c}' as "column", count({c}) as n, round(avg({c}), 6) as mean,
              round(stddev_samp({c}), 6) as std, min({c}) as min, max({c}) as max,
              round(quantile_cont({c}, 0.25), 6) as q25, round(quantile_cont({c}, 0.5), 6) as q50,
              round(quantile_cont({c}, 0.75), 6) as q75 from lineitem"""
        for c in DESCRIBED
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quantiles.describe(base(spark, folder, "lineitem"), DESCRIBED))


@query(
    "column_sums",
    with_views(
        ["diagnoses"],
        """select 'ICD10' as "column", cast(sum(i10) as bigint) as total from (
             select patientid, max(case when diagnosis_cd_type = 'ICD10' then 1 else 0 end) as i10
             from diagnoses group by patientid)
           union all select 'ICD9', cast(sum(i9) as bigint) from (
             select patientid, max(case when diagnosis_cd_type = 'ICD9' then 1 else 0 end) as i9
             from diagnoses group by patientid)""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    wide = ag.presence_pivot(
        view(spark, folder, "diagnoses"), KEY, "diagnosis_cd_type", ["ICD10", "ICD9"], ""
    )
    return ag.column_sums(wide, ["ICD10", "ICD9"])


@query(
    "crosstab",
    """select quality, count(*) filter (toxic = 0) as toxic_0, count(*) filter (toxic = 1) as toxic_1
       from labels group by quality""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.crosstab(base(spark, folder, "labels"), "quality", "toxic", [0, 1], "toxic_")


@query(
    "class_balance",
    with_views(
        ["target"],
        """select count(*) filter (has_long_covid_diag = 1) as positives,
             count(*) filter (has_long_covid_diag = 0) as negatives,
             round(avg(has_long_covid_diag), 9) as positive_fraction from target""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ag.class_balance(view(spark, folder, "target"), "has_long_covid_diag"), 9)


@query(
    "per_visit_counts",
    with_views(
        ["medication"],
        """select patientid, days_to_covid_diag, count(*) as n from (select distinct * from medication)
           group by patientid, days_to_covid_diag""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.per_visit_counts(rows.dedup(view(spark, folder, "medication")), KEY, DAY)


@query(
    "conflicting_results",
    with_views(
        ["labs"],
        """select patientid, days_to_covid_diag, count(distinct test_result) as results from labs
           where test_name = 'view' group by patientid, days_to_covid_diag
           having count(distinct test_result) > 1""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    labs = view(spark, folder, "labs")
    return ag.conflicting_results(labs, KEY, DAY, "test_name", "view", "test_result")


@query(
    "results_per_entity",
    with_views(
        ["labs"],
        """select patientid, count(test_result) as n from labs where test_name = 'view'
           group by patientid""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.results_per_entity(
        view(spark, folder, "labs"), KEY, "test_name", "view", "test_result"
    )


@query(
    "day_bands",
    with_views(
        ["medication"],
        """select patientid, count(*) filter (days_to_covid_diag < 7) as early,
             count(*) filter (days_to_covid_diag between 7 and 14) as middle,
             count(*) filter (days_to_covid_diag > 14) as late
           from medication group by patientid""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.day_bands(view(spark, folder, "medication"), KEY, DAY)


@query(
    "metric_summary",
    """select l_returnflag, round(avg(l_discount), 9) as l_discount_mean,
         round(stddev_samp(l_discount), 9) as l_discount_std,
         round(avg(l_quantity), 9) as l_quantity_mean,
         round(stddev_samp(l_quantity), 9) as l_quantity_std
       from lineitem group by l_returnflag""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = base(spark, folder, "lineitem")
    return rounded(ag.metric_summary(lines, "l_returnflag", ["l_discount", "l_quantity"]), 9)


@query(
    "distinct_ranges",
    with_views(
        ["labs"],
        "select test_name, normal_range, count(*) as n from labs group by test_name, normal_range",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.distinct_ranges(view(spark, folder, "labs"), "test_name", "normal_range")


@query(
    "label_rate_by_month",
    with_views(
        ["demo", "target"],
        """select index_month_year, count(*) as n, round(avg(has_long_covid_diag), 9) as label_rate
           from demo join target using (patientid) group by index_month_year""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    joined = rows.inner_on(view(spark, folder, "demo"), view(spark, folder, "target"), KEY)
    return rounded(ag.label_rate_by(joined, "index_month_year", "has_long_covid_diag"), 9)


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "one_hot",
    with_views(
        ["demo"],
        "select patientid, "
        + ", ".join(f"coalesce(cast(race = '{s}' as int), 0) as race_{s}" for s in SEGMENTS)
        + ", "
        + ", ".join(
            f"cast(birth_yr is not distinct from {v} as int) as birth_yr_{n}"
            for n, v in (("null", "null"), ("Unknown", "'Unknown'"))
        )
        + " from demo",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    demo = view(spark, folder, "demo").select(KEY, "race", "birth_yr")
    return columns.one_hot(demo, {"race": SEGMENTS, "birth_yr": [None, "Unknown"]})

