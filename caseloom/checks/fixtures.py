"""Event tables derived from the star-schema test tables.

Each text runs unchanged on both engines, as a Spark view and as a common table
expression of the SQL a query is checked with.
"""

from __future__ import annotations

from functools import lru_cache
from math import ceil

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    "demo": """
select concat('P', cast(c_custkey as string)) patientid, case when c_custkey%97=0 then null when c_custkey%89=0 then 'Unknown' when c_custkey%83=0 then '1932 and Earlier' else cast(1933+c_custkey%70 as string) end birth_yr,
case c_custkey%3 when 0 then 'F' when 1 then 'M' else 'Unknown' end gender, c_mktsegment race, case c_nationkey%3 when 0 then 'Hispanic' when 1 then 'Not Hispanic' else 'Unknown' end ethnicity,
cast(concat(cast(2020+cast(floor((c_custkey*7%25)/12) as int) as string),'-',lpad(cast((c_custkey*7%25)%12+1 as string),2,'0'),'-01') as timestamp) index_month_year from customer
""",
    "target": """
select concat('P', cast(c_custkey as string)) patientid, case when (c_custkey*7%25)>=18 and c_custkey%11=0 then 1 else 0 end has_long_covid_diag from customer
""",
    "diagnoses": """
select concat('P', cast(o_custkey as string)) patientid, cast(l_partkey%61-30 as int) days_to_covid_diag, case when l_partkey%211=0 then null else concat(chr(cast(65+l_suppkey%26 as int)),cast(l_partkey%100 as string)) end diagnosis_cd,
case l_linenumber%4 when 0 then 'ICD9' when 1 then 'SNOMED' else 'ICD10' end diagnosis_cd_type from lineitem join orders on l_orderkey=o_orderkey
""",
    "medication": """
select concat('P', cast(o_custkey as string)) patientid, cast(l_partkey%61-30 as int) days_to_covid_diag, p_name drug_name, cast(l_partkey as string) ndc from lineitem join orders on l_orderkey=o_orderkey join part on p_partkey=l_partkey
""",
    "drug_dictionary": """
select distinct p_name Drug, case when p_name='red plate' then null when p_name like 'old%' then 'Diabetes' when p_name like 'large%' then 'diabetes' else split_part(p_name,' ',2) end Category from part where p_name not like 'hot%'
""",
    "doubled_dictionary": """
select p_name Drug, case when p_name='red plate' then null when p_name like 'old%' then 'Diabetes' when p_name like 'large%' then 'diabetes' else split_part(p_name,' ',2) end Category from part where p_name not like 'hot%'
""",
    "labs": """
select concat('P', cast(user_id as string)) patientid, 'chem' test_type, event_type test_name, cast(event_id%61-30 as int) days_to_covid_diag,
case event_id%20 when 0 then 'unknown' when 1 then '<5' when 2 then null when 3 then 'negative' else cast(value as string) end test_result,
case when event_id%13=0 then null else 'u' end result_unit,
case event_id%11 when 0 then null when 1 then '-' when 2 then '>=5' when 3 then '<=100' when 4 then 'negative' when 5 then '10.5-60' when 6 then '<50' when 7 then '>20' when 8 then '1-2-3' else '5-120' end normal_range from events
""",
    "observations": """
select concat('P', cast(user_id as string)) patientid, case event_type when 'click' then 'BMI' when 'view' then 'SBP' when 'purchase' then 'PAIN' when 'error' then 'SMOKE' else 'ALCOHOL' end obs_type,
case when event_type in ('error','signup') then case when user_id%9=0 then null when user_id%4=0 then case event_id%2 when 0 then 'Current' else 'Never' end else 'Never' end else case event_id%20 when 0 then 'n/a' when 2 then null else cast(value as string) end end obs_result,
case event_type when 'view' then 'mm Hg' when 'purchase' then 'out of 10' else null end obs_unit, cast(event_id%61-30 as int) days_to_covid_diag from events
""",
    "immunization": """
select concat('P', cast(o_custkey as string)) patientid, cast(o_orderkey%61-30 as int) days_to_covid_diag,
case o_orderkey%10 when 0 then 'sars-cov-2 mRNA; 30 mcg/0.3 mL (Pfizer)' when 1 then 'COVID-19 Moderna 100 mcg/0.5 mL' when 2 then 'covid-19 Janssen' when 3 then 'influenza, seasonal' when 4 then 'Hib' when 5 then 'Unspecified Immunization' when 6 then null when 7 then 'covid-19 NOS' when 8 then 'Tdap' else 'Hep B adult' end immunization_desc,
case o_orderkey%10 when 0 then 'COVID-19 vaccine, mRNA, BNT162b2, LNP-S (Pfizer)/PF' when 1 then 'COVID-19 vaccine, mRNA, BNT162b2, LNP-S (Pfizer)/PF' when 2 then 'COVID-19 vac, Ad26.COV2.S (Janssen)/PF' when 3 then 'Influenza Live Vaccine' when 4 then 'Haemophilus influenzae b vaccine' when 5 then 'Flu Vaccine Unspecified' when 6 then 'Rabies Vaccine, Unspecified' when 7 then null when 8 then 'Acellular Pertussis-Diphtheria-Tetanus Toxoids Vaccine-Reduced (TDaP)' else 'Hepatitis B Vaccine Unspecified' end mapped_name from orders
""",
}


@lru_cache(maxsize=256)
def base(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Keys of the large tables that are joined, and the bytes of them as parquet that a task joins.
JOINED = {"lineitem": "l_orderkey", "orders": "o_orderkey", "part": "p_partkey"}
JOINED_BYTES = 32 * 1024 * 1024


def join_parts(spark: SparkSession, folder: str) -> int:
    """Into how many parts the joined tables are dealt, so that what a task sorts is bounded;
    0 where the session's own number is enough."""
    plan = base(spark, folder, "lineitem")._jdf.queryExecution().optimizedPlan()
    parts = ceil(int(str(plan.stats().sizeInBytes())) / JOINED_BYTES)
    return parts if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else 0


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One derived table over the parquet files in ``folder``."""
    text = VIEWS[name]
    parts = join_parts(spark, folder) if " join " in text else 0
    for table in BASE_TABLES:
        if table in text:
            rows = base(spark, folder, table)
            if parts and table in JOINED:
                rows = rows.repartition(parts, JOINED[table])
            rows.createOrReplaceTempView(table)
    return spark.sql(text)


def with_views(names: list[str] | tuple[str, ...], body: str) -> str:
    """``body`` with the named derived tables in front of it."""
    parts = [f"{name} as ({VIEWS[name].strip()})" for name in names]
    return "with " + ",\n".join(parts) + "\n" + body.strip()
