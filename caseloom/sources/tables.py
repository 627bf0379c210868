"""Scans and sinks."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, FractionalType, IntegralType, StructType

# The input tables and their columns.
SCHEMAS: dict[str, str] = {
    "diagnoses": "patientid string, days_to_covid_diag int, diagnosis_cd string, "
                 "diagnosis_cd_type string",
    "observations": "patientid string, obs_type string, obs_result string, obs_unit string, "
                    "days_to_covid_diag int",
    "medication": "patientid string, days_to_covid_diag int, drug_name string, ndc string",
    "labs": "patientid string, test_type string, test_name string, days_to_covid_diag int, "
            "test_result string, result_unit string, normal_range string",
    "immunization": "patientid string, days_to_covid_diag int, immunization_desc string, "
                    "mapped_name string",
    "demo": "patientid string, birth_yr string, gender string, race string, ethnicity string, "
            "index_month_year timestamp",
    "target": "patientid string, has_long_covid_diag int",
}
DICTIONARY_SCHEMA = "Drug string, Category string"


def whole_number(c: Column, into: DataType) -> Column:
    """A floating number as an integer type: NaN is null, a fraction is an error."""
    bad = F.concat(F.lit("not a whole number: "), c.cast("string"))
    return F.when(F.isnan(c), F.lit(None)).when(c == F.floor(c), c).when(
        c.isNotNull(), F.raise_error(bad)
    ).cast(into)


def as_declared(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns with the declared types, whatever integer or floating types the
    file has; a declared column that the file lacks is null. Other columns are left out."""
    kinds = {f.name: f.dataType for f in df.schema}
    made = []
    for field in schema:
        have = kinds.get(field.name)
        if have is None:
            made.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif have == field.dataType:
            made.append(F.col(field.name))
        elif isinstance(have, FractionalType) and isinstance(field.dataType, IntegralType):
            made.append(whole_number(F.col(field.name), field.dataType).alias(field.name))
        else:
            made.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*made)


def read_table(
    spark: SparkSession, folder: str, name: str, schema: str | StructType | None = None
) -> DataFrame:
    """``<folder>/<name>.parquet`` in its declared schema, cast from the types of the file.

    pandas stores integers in 64 bits and nullable ones as doubles; both are read.
    """
    found = spark.read.parquet(f"{folder}/{name}.parquet")
    schema = schema or SCHEMAS.get(name)
    if schema is None:
        return found
    return as_declared(found, StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def read_tsv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=schema)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """A line list as ``(value, rank)``, right-trimmed, in file order.

    Line lists are written as one file of at most a few hundred lines.
    """
    lines = spark.read.text(path, wholetext=True)
    split = lines.select(F.posexplode(F.split("value", r"\r?\n")).alias("rank", "value"))
    trimmed = split.select(F.regexp_replace("value", r"\s+$", "").alias("value"), "rank")
    return trimmed.where(F.length("value") > 0)


def write_vocab(
    df: DataFrame, path: str, value: str = "value", rank: str = "rank", most: int = 10_000
) -> None:
    """Values in rank order, one per line, in one file, for people and other programs to read.

    More than ``most`` values, and values that would not come back as they are (null, empty,
    with a line break or white space at the end), are an error.
    """
    rows = df.select(F.col(value).cast("string").alias("value"), F.col(rank).alias("rank"))
    # at most this many rows, worked out where they are, go into the one file
    rows = df.sparkSession.createDataFrame(rows.orderBy("rank").limit(most + 1).collect(), rows.schema)
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("value").isNull() | (F.col("value") == "") | F.col("value").rlike(r"[\r\n]|\s$")).alias("odd"),
    ).first()
    if facts["n"] > most:
        raise ValueError(f"a line list has at most {most} values")
    if facts["odd"]:
        raise ValueError(f"{facts['odd']} values cannot be lines of a list")
    rows.coalesce(1).sortWithinPartitions("rank").select("value").write.mode("overwrite").text(path)


def write_predictions(df: DataFrame, path: str, entity: str = "patientid") -> None:
    """Scores as parquet and as CSV, both written by the executors."""
    scores = df.select(entity, "prediction", "p_positive")
    scores.write.mode("overwrite").parquet(f"{path}/predictions.parquet")
    # The file just written feeds the CSV, so scoring runs once.
    saved = df.sparkSession.read.schema(scores.schema).parquet(f"{path}/predictions.parquet")
    saved.select(entity, "prediction").write.mode("overwrite").csv(
        f"{path}/predictions.csv", header=True
    )


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def fingerprint(spark: SparkSession, frames: Mapping[str, DataFrame], *parameters: object) -> str:
    """Names what a stage is built from: plans, input files (path, size, time), parameters.

    The files' facts are listed and summed by Spark. A frame that holds rows of its own,
    outside files, has a new name each time, so nothing built from it is used again.
    """
    parts = [repr(p) for p in parameters]
    for name, df in sorted(frames.items()):
        text = df._jdf.queryExecution().analyzed().canonicalized().toString()
        files = [unquote(f) for f in sorted(df.inputFiles())]
        if not files or "LocalRelation" in text or "LogicalRDD" in text:
            parts.append(uuid.uuid4().hex)
            continue
        found = spark.read.format("binaryFile").load(files)
        fact = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        count, total = found.agg(F.count(F.lit(1)), F.sum(fact)).first()
        parts += [name, text, str(count), str(total)]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:20]


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The finished table at ``path``; built and written first when it is not there.

    ``path`` has to name what the table is built from; see ``fingerprint``.
    """
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
