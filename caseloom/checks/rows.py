"""Queries over sources, projections, filters and joins."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from caseloom.checks import sql
from caseloom.checks.fixtures import base, view, with_views
from caseloom.checks.registry import query
from caseloom.functions import rules, scalars
from caseloom.operators import aggregates as ag
from caseloom.operators import columns, merge, rows
from caseloom.operators.models import top_with_forced
from caseloom.plans.features import DAY, KEY, drug_vocabulary
from caseloom.session import checkpoint_dir
from caseloom.sources import tables as io

CATEGORIES = (
    "Diabetes", "anvil", "bolt", "diabetes", "gear", "gizmo", "plate", "ring", "rod", "widget",
)
ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder every executor can reach."""
    return f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}/{name}"


# --- Sources and sinks ------------------------------------------------------


@query("scan_parquet_declared_schema", "select * from orders")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return io.read_table(spark, folder, "orders", ORDERS_SCHEMA)


DAYED = ("diagnoses", "medication", "labs", "observations", "immunization")


@query(
    "scan_tables_as_pandas_writes_them",
    with_views(
        [*DAYED, "demo", "target"],
        " union all ".join(
            f"""select '{t}' as name, count(*) as rows, count(days_to_covid_diag) as days,
                cast(sum(days_to_covid_diag) as bigint) as total, 'int' as kind,
                cast(count(distinct patientid) as bigint) as entities from {t}"""
            for t in DAYED
        )
        + """ union all select 'demo', count(*), count(index_month_year),
              cast(sum(epoch(index_month_year)) as bigint), 'timestamp', count(distinct patientid) from demo
             union all select 'target', count(*), count(has_long_covid_diag),
              cast(sum(has_long_covid_diag) as bigint), 'int', count(distinct patientid) from target""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Days stored as bigint or, where nullable, double; labels as bigint."""
    path, parts = scratch(spark, "raw"), []
    for i, name in enumerate([*DAYED, "demo", "target"]):
        table = view(spark, folder, name)
        wide = "bigint" if i % 2 or name == "target" else "double"
        stored = {
            c: F.col(c).cast(wide if kind == "int" else "timestamp_ntz")
            for c, kind in table.dtypes
            if kind in ("int", "timestamp")
        }
        table.withColumns(stored).write.parquet(f"{path}/{name}.parquet")
        read = io.read_table(spark, path, name)
        column = {"demo": "index_month_year", "target": "has_long_covid_diag"}.get(name, DAY)
        number = F.unix_seconds(column) if name == "demo" else F.col(column)
        parts.append(
            read.select(KEY, column, number.alias("_n")).agg(
                F.count(F.lit(1)).alias("rows"),
                F.count(column).alias("days"),
                F.sum("_n").cast("bigint").alias("total"),
                F.lit(dict(read.dtypes)[column]).alias("kind"),
                F.countDistinct(KEY).alias("entities"),
            ).select(F.lit(name).alias("name"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


@query("tsv_write_and_read", with_views(["drug_dictionary"], "select * from drug_dictionary"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "dictionary.tsv")
    io.write_tsv(view(spark, folder, "drug_dictionary"), path)
    return io.read_tsv(spark, path, io.DICTIONARY_SCHEMA)


@query(
    "vocab_write_and_read",
    with_views(
        ["medication"],
        """select drug_name as value, cast(row_number() over (order by n desc, drug_name) - 1 as int)
           as rank from (select drug_name, count(patientid) as n
                         from (select distinct * from medication) group by drug_name)
           order by n desc, drug_name limit 100""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "drugs")
    io.write_vocab(drug_vocabulary(view(spark, folder, "medication")), path)
    return io.read_vocab(spark, path)


@query(
    "stage_reuse",
    with_views(
        ["diagnoses"],
        "select patientid, count(*) as n from diagnoses group by patientid",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "visits")
    counts = view(spark, folder, "diagnoses").groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    io.stage(spark, path, lambda: counts)

    def never() -> DataFrame:
        raise AssertionError("a finished stage is read, not built again")

    return io.stage(spark, path, never)


@query(
    "predictions_write_and_read",
    """select concat('P', cast(doc_id as string)) as patientid,
              1 - n_chars / 30000.0::double as prediction, n_chars / 30000.0::double as p_positive
       from documents""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "scores")
    p = F.col("n_chars") / F.lit(30000.0)
    scored = base(spark, folder, "documents").select(
        F.concat(F.lit("P"), F.col("doc_id").cast("string")).alias(KEY),
        (1 - p).alias("prediction"),
        p.alias("p_positive"),
    )
    io.write_predictions(scored, path)
    return spark.read.parquet(f"{path}/predictions.parquet")


# --- Filters and projections ------------------------------------------------


@query("dedup_rows", with_views(["medication"], "select distinct * from medication"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rows.dedup(view(spark, folder, "medication"))


@query(
    "dedup_projected",
    with_views(["diagnoses"], "select distinct patientid, diagnosis_cd from diagnoses"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rows.dedup(view(spark, folder, "diagnoses"), [KEY, "diagnosis_cd"])


@query(
    "filter_equal",
    with_views(["diagnoses"], "select * from diagnoses where diagnosis_cd_type = 'ICD10'"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "diagnoses").where(F.col("diagnosis_cd_type") == "ICD10")


@query(
    "keep_in_vocab_table",
    with_views(
        ["medication"],
        """select * from medication where drug_name in (
             select drug_name from (select distinct * from medication)
             group by drug_name order by count(patientid) desc, drug_name limit 20)""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    medication = view(spark, folder, "medication")
    return rows.keep_in_vocab(medication, "drug_name", drug_vocabulary(medication, 20))


@query(
    "keep_in_vocab_list",
    with_views(["labs"], "select * from labs where test_name in ('click', 'view', 'purchase')"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rows.keep_in_vocab(
        view(spark, folder, "labs"), "test_name", ["click", "view", "purchase"]
    )


@query(
    "drop_value_keep_nulls",
    with_views(["labs"], "select * from labs where test_result is distinct from 'unknown'"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rows.drop_value(view(spark, folder, "labs"), "test_result", "unknown")


@query(
    "complete_cases_all",
    with_views(
        ["labs"],
        """select * from labs where patientid is not null and test_type is not null
           and test_name is not null and days_to_covid_diag is not null
           and test_result is not null and result_unit is not null and normal_range is not null""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rows.complete_cases(view(spark, folder, "labs"))


@query(
    "complete_cases_subset",
    with_views(
        ["immunization"],
        """select * from immunization
           where mapped_name is not null and immunization_desc is not null""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rows.complete_cases(
        view(spark, folder, "immunization"), ["mapped_name", "immunization_desc"]
    )


@query(
    "numeric_only",
    with_views(
        ["observations"],
        f"""select patientid, obs_type, obs_unit, days_to_covid_diag, value from (
              select *, {sql.number('obs_result')} as value from observations)
            where value is not null""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    observations = view(spark, folder, "observations")
    return rows.numeric_only(observations, "obs_result", "value").drop("obs_result")


@query(
    "digits_only",
    with_views(["labs"], r"select * from labs where regexp_matches(test_result, '\d')"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rows.digits_only(view(spark, folder, "labs"), "test_result")


@query(
    "plausible_bound",
    with_views(
        ["labs"],
        f"""select patientid, test_name, value from (
              select *, {sql.number('test_result')} as value from labs)
            where value <= 60""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    numeric = rows.numeric_only(view(spark, folder, "labs"), "test_result", "value")
    return rows.plausible(numeric, "value", high=60).select(KEY, "test_name", "value")


@query(
    "coerce_columns",
    with_views(
        ["labs"],
        f"""select patientid, test_name, {sql.number('test_result')} as test_result,
              {sql.number('normal_range')} as normal_range from labs""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    coerced = columns.coerce_columns(view(spark, folder, "labs"), ["test_result", "normal_range"])
    return coerced.select(KEY, "test_name", "test_result", "normal_range")


@query(
    "code_chapter_letter",
    with_views(
        ["diagnoses"],
        "select *, substr(coalesce(diagnosis_cd, 'None'), 1, 1) as chapter from diagnoses",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "diagnoses").withColumn(
        "chapter", scalars.code_chapter("diagnosis_cd")
    )


def _chapter_sql(c: str, chapters: tuple) -> str:
    arms = " ".join(
        f"when substr({c}, 1, {len(first)}) between '{first}' and '{last}' then {sql.text(title)}"
        for first, last, title in chapters
    )
    return f"case {arms} end"


@query(
    "code_chapter_title",
    with_views(
        ["diagnoses"],
        f"""select patientid, diagnosis_cd, diagnosis_cd_type,
              case diagnosis_cd_type
                when 'ICD10' then {_chapter_sql('diagnosis_cd', rules.ICD10_CHAPTERS)}
                when 'ICD9' then {_chapter_sql('diagnosis_cd', rules.ICD9_CHAPTERS)} end as title
            from diagnoses""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    system = F.col("diagnosis_cd_type")
    title = F.when(system == "ICD10", rules.code_range_chapter("diagnosis_cd", "ICD10")).when(
        system == "ICD9", rules.code_range_chapter("diagnosis_cd", "ICD9")
    )
    return view(spark, folder, "diagnoses").select(
        KEY, "diagnosis_cd", "diagnosis_cd_type", title.alias("title")
    )


@query(
    "label_with_unit",
    with_views(
        ["observations"],
        """select patientid, concat(obs_type, '(', coalesce(obs_unit, 'None'), ')') as label
           from observations""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "observations").select(
        KEY, scalars.label_with_unit("obs_type", "obs_unit").alias("label")
    )


@query(
    "concat_key",
    with_views(
        ["diagnoses"],
        "select patientid, diagnosis_cd || '_' || diagnosis_cd_type as code from diagnoses",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "diagnoses").select(
        KEY, scalars.concat_key("diagnosis_cd", "diagnosis_cd_type").alias("code")
    )


NORMALISED = "upper(replace(immunization_desc, ';', ','))"


@query(
    "normalise_text",
    with_views(["immunization"], f"select patientid, {NORMALISED} as description from immunization"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "immunization").select(
        KEY, scalars.norm_text("immunization_desc").alias("description")
    )


def _annotated_sql(c: str) -> str:
    def dose(x: str, amount: str) -> str:
        return f"contains(replace({x}, ' ', ''), '{amount}')"

    modern = f"{dose(c, rules.MODERNA_DOSE)} or {sql.any_of(c, rules.MODERNA_WORDS)}"
    named = f"(case when {modern} then concat({c}, ' (MODERNA)') else {c} end)"
    return (
        f"(case when {dose(named, rules.PFIZER_DOSE)} then concat({named}, '(PFIZER)') "
        f"else {named} end)"
    )


@query(
    "annotate_brand",
    with_views(
        ["immunization"],
        f"""select patientid, {_annotated_sql('d')} as description from (
              select patientid, {NORMALISED} as d from immunization)""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    text = view(spark, folder, "immunization").select(
        KEY, scalars.norm_text("immunization_desc").alias("d")
    )
    return text.select(KEY, rules.annotate_brand("d").alias("description"))


def _name_sql(c: str) -> str:
    covid = sql.first_match(
        _annotated_sql(c), rules.COVID_NAME_RULES, sql.text(rules.UNSPECIFIED_NAME)
    )
    rest = (
        f"case when contains(replace({c}, ' ', ''), 'RHO(D)') or contains({c}, 'RHO D ') "
        f"then {sql.text(rules.RHO_NAME)} when contains({c}, 'TDAP') "
        f"then {sql.text(rules.TDAP_NAME)} else {c} end"
    )
    other = sql.first_match(c, rules.OTHER_NAME_RULES, rest)
    return f"case when {sql.any_of(c, rules.COVID_WORDS)} then {covid} else {other} end"


@query(
    "first_match_vaccine_name",
    with_views(
        ["immunization"],
        f"""select patientid, d as description, {_name_sql('d')} as name from (
              select patientid, {NORMALISED} as d from immunization)
            where d is not null""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    text = view(spark, folder, "immunization").select(
        KEY, scalars.norm_text("immunization_desc").alias("description")
    )
    known = text.where(F.col("description").isNotNull())
    return known.withColumn("name", rules.vaccine_name("description"))


@query(
    "covid_brand",
    with_views(
        ["immunization"],
        f"""select patientid, mapped_name, {sql.brand('mapped_name', 'd')} as brand from (
              select patientid, mapped_name, {NORMALISED} as d from immunization)""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    description = scalars.norm_text("immunization_desc")
    return view(spark, folder, "immunization").select(
        KEY, "mapped_name", rules.covid_brand("mapped_name", description).alias("brand")
    )


@query(
    "flu_kind",
    with_views(
        ["immunization"],
        f"""select patientid, mapped_name, {sql.flu('mapped_name')} as kind,
              {sql.flu('mapped_name', strict=True)} as strict_kind from immunization""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "immunization").select(
        KEY,
        "mapped_name",
        rules.flu_kind("mapped_name").alias("kind"),
        rules.flu_kind("mapped_name", strict=True).alias("strict_kind"),
    )


@query(
    "substring_flags",
    with_views(
        ["immunization"],
        "select patientid, mapped_name, "
        + ", ".join(
            f"coalesce({e}, 0) as {f}" for f, e in sql.antigen_flags("mapped_name").items()
        )
        + " from immunization",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    flags = rules.substring_flags("mapped_name")
    return view(spark, folder, "immunization").select(
        KEY, "mapped_name", *[f.alias(n) for n, f in flags.items()]
    )


YEAR = """case when contains(birth_yr, 'Earlier') then 1932
          when birth_yr is null or contains(birth_yr, 'Un') then 1968
          else cast(birth_yr as int) end"""


@query(
    "demographic_scalars",
    with_views(
        ["demo"],
        f"""select patientid, {YEAR} as year, 2021 - ({YEAR}) as age,
              cast(date_diff('day', date '2020-01-01', cast(index_month_year as date)) as int)
                as days,
              cast(index_month_year > timestamp '2021-06-01' as int) as late
            from demo""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    year = scalars.clean_year("birth_yr")
    return view(spark, folder, "demo").select(
        KEY,
        year.alias("year"),
        scalars.age(year).alias("age"),
        scalars.days_since("index_month_year").alias("days"),
        scalars.after("index_month_year").alias("late"),
    )


@query(
    "normal_range_flag",
    with_views(
        ["labs"],
        sql.range_flag("labs", "patientid, test_name, test_result, normal_range"),
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "labs").select(
        KEY,
        "test_name",
        "test_result",
        "normal_range",
        scalars.range_flag("test_result", "normal_range").alias("value_normal"),
    )


@query(
    "binarise_counts",
    """select o_custkey, cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) <> 0 as int) as f,
         cast(sum(case when o_orderstatus = 'O' then 1 else 0 end) <> 0 as int) as o
       from orders group by o_custkey""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    counts = base(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.count_if(F.col("o_orderstatus") == "O").alias("o"),
    )
    return columns.binarise(counts, ["f", "o"])


@query(
    "select_drop_rename",
    "select o_orderkey as visit, o_custkey as patient, o_totalprice from orders",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    kept = base(spark, folder, "orders").drop("o_orderstatus", "o_orderpriority", "o_orderdate")
    return kept.toDF("visit", "patient", "o_totalprice")


@query(
    "drop_columns_matching",
    "select l_orderkey, l_partkey, l_suppkey, l_tax from lineitem",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = base(spark, folder, "lineitem")
    return columns.drop_columns_matching(lines, "(?i)un|line|price|date|flag|quant")


@query("non_numeric_columns", "select o_orderstatus, o_orderdate, o_orderpriority from orders")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = base(spark, folder, "orders")
    return orders.select(*columns.non_numeric_columns(orders))


@query(
    "row_min_max",
    """select l_orderkey, l_linenumber, least(l_discount, l_tax, lower_half) as low,
              greatest(l_discount, l_tax, lower_half) as high
       from (select *, case when l_quantity < 25 then l_quantity / 100 end as lower_half
             from lineitem)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = base(spark, folder, "lineitem").withColumn(
        "lower_half", F.when(F.col("l_quantity") < 25, F.col("l_quantity") / 100)
    )
    three = ["l_discount", "l_tax", "lower_half"]
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        scalars.row_min(three).alias("low"),
        scalars.row_max(three).alias("high"),
    )


# --- Joins ------------------------------------------------------------------


@query(
    "join_label_inner",
    with_views(
        ["demo", "target"],
        "select patientid, birth_yr, gender, has_long_covid_diag from demo join target using (patientid)",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    joined = rows.inner_on(view(spark, folder, "demo"), view(spark, folder, "target"), KEY)
    return joined.select(KEY, "birth_yr", "gender", "has_long_covid_diag")


@query(
    "join_dictionary_left",
    with_views(
        ["medication", "drug_dictionary"],
        """select patientid, days_to_covid_diag, drug_name, ndc, Category
           from medication left join drug_dictionary on drug_name = Drug""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rows.dictionary_join(
        view(spark, folder, "medication"),
        "drug_name",
        view(spark, folder, "drug_dictionary"),
        "Drug",
    )


@query(
    "dictionary_problems",
    with_views(
        ["drug_dictionary"],
        """select Drug, count(*) as lines, count(Category) as valued from drug_dictionary
           group by Drug having count(*) > 1 or count(Category) < count(*)""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rows.dictionary_problems(view(spark, folder, "drug_dictionary"), "Drug", "Category")


SPAN_SOURCES = {"dia": "diagnoses", "med": "medication", "lab": "labs"}
SPAN_SQL = {
    short: f"""{short}_span as (select patientid,
        min(days_to_covid_diag) as earliest_{short}_response_to_covid_diag,
        max(days_to_covid_diag) as latest_{short}_response_to_covid_diag
      from {table} group by patientid)"""
    for short, table in SPAN_SOURCES.items()
}


def _spans(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [
        ag.entity_span(view(spark, folder, table), KEY, DAY, short)
        for short, table in SPAN_SOURCES.items()
    ]


def _merge_sql(how: str) -> str:
    body = f"""select * from dia_span {how} join med_span using (patientid)
               {how} join lab_span using (patientid)"""
    return with_views(list(SPAN_SOURCES.values()), "").rstrip() + ",\n" + ",\n".join(
        SPAN_SQL.values()
    ) + "\n" + body


@query("merge_outer", _merge_sql("full outer"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return merge.merge_outer(_spans(spark, folder), KEY)


@query("merge_inner", _merge_sql("inner"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return merge.merge_inner(_spans(spark, folder), KEY)


@query("merge_chain_outer", _merge_sql("full outer"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return merge.merge_chain(_spans(spark, folder), KEY)


@query("merge_chain_left", _merge_sql("left"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return merge.merge_chain(_spans(spark, folder), KEY, "left")


@query(
    "anti_filter",
    with_views(
        ["medication", "drug_dictionary"],
        """select * from medication m
           where not exists (select 1 from drug_dictionary d where d.Drug = m.drug_name)""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    known = view(spark, folder, "drug_dictionary").withColumnRenamed("Drug", "drug_name")
    return rows.without_keys(view(spark, folder, "medication"), known, "drug_name")


@query(
    "semi_filter",
    with_views(
        ["demo", "labs"],
        "select patientid, gender, race from demo where patientid in (select patientid from labs)",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    known = rows.with_keys(view(spark, folder, "demo"), view(spark, folder, "labs"), KEY)
    return known.select(KEY, "gender", "race")


@query(
    "columns_beside_key",
    """select c_custkey, c_acctbal, cast(c_mktsegment = 'BUILDING' as int) as building,
              c_acctbal * 2 as doubled from customer""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    customer = base(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return customer.withColumns(
        {
            "building": (F.col("c_mktsegment") == "BUILDING").cast("int"),
            "doubled": F.col("c_acctbal") * 2,
        }
    ).drop("c_mktsegment")


COVERAGE = ("diagnoses", "medication", "labs", "observations", "immunization", "demo")


@query(
    "source_coverage",
    with_views(
        COVERAGE,
        "select patientid, "
        + ", ".join(f"max(cast(s = '{n}' as int)) as {n}" for n in COVERAGE)
        + " from ("
        + " union all ".join(f"select patientid, '{n}' as s from {n}" for n in COVERAGE)
        + ") group by patientid",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.coverage({n: view(spark, folder, n) for n in COVERAGE}, KEY)


# --- Order, limits, unions --------------------------------------------------


@query(
    "sort_by_count",
    """select o_custkey, count(*) as n from orders group by o_custkey order by n desc, o_custkey""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.value_counts(base(spark, folder, "orders"), "o_custkey")


@query(
    "first_k",
    """select p_name, count(*) as n from part group by p_name order by n desc, p_name limit 15""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ag.value_counts(base(spark, folder, "part"), "p_name").limit(15)


@query(
    "top_k_with_forced",
    """with r as (select p_name as feature, cast(row_number() over (order by n desc, p_name) as int)
                    as rank from (select p_name, count(*) as n from part group by p_name)),
         t as (select * from r where rank <= 20)
       select * from t union all
       select * from (values ('red widget', 21), ('a feature of no part', 22)) f(feature, rank)
       where feature not in (select feature from t)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    top = ag.top_k_vocab(base(spark, folder, "part"), "p_name", 20).select(
        F.col("value").alias("feature"), (F.col("rank") + 1).alias("rank")
    )
    return top_with_forced(top, 20, ["red widget", "a feature of no part"])


@query(
    "stack_rows",
    """select o_custkey, o_totalprice from orders where o_orderstatus = 'F'
       union all select o_custkey, o_totalprice from orders where o_totalprice > 1000""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = base(spark, folder, "orders")
    pair = ["o_custkey", "o_totalprice"]
    return rows.stack_rows(
        orders.where(F.col("o_orderstatus") == "F").select(*pair),
        orders.where(F.col("o_totalprice") > 1000).select(*pair),
    )

