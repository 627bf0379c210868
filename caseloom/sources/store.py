"""A store of fitted things in generations.

A generation is a folder of its own: lists of values, numbers, and a model. Nothing in it is
seen by readers until it is published, which is the last thing written: one small table that
names the generation. A run that ends before that leaves readers on the generation before, as
a whole. Lists are parquet columns, so every value comes back as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession, functions as F

from caseloom.sources.tables import exists

PUBLISHED = "published"


@dataclass(frozen=True)
class Generation:
    """A folder for one generation, and what it was made with."""

    store: str
    name: str

    @property
    def path(self) -> str:
        return f"{self.store}/generations/{self.name}"

    @property
    def model(self) -> str:
        return f"{self.path}/model"


def begin(store: str) -> Generation:
    return Generation(store, uuid.uuid4().hex)


def save_lists(
    spark: SparkSession, generation: Generation, kind: str, lists: Mapping[str, Sequence[str | None]]
) -> None:
    """Lists by name, each in its order."""
    rows = [(name, i, value) for name, values in lists.items() for i, value in enumerate(values)]
    table = spark.createDataFrame(rows, "name string, rank int, value string")
    table.coalesce(1).write.mode("overwrite").parquet(f"{generation.path}/{kind}")
    names = spark.createDataFrame([(n,) for n in lists], "name string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{generation.path}/{kind}_names")


def load_lists(spark: SparkSession, generation: Generation, kind: str, most: int = 1000) -> dict[str, list[str | None]]:
    """The lists as they were saved; one of more than ``most`` values is an error."""
    lists: dict[str, list[str | None]] = {
        r["name"]: [] for r in spark.read.parquet(f"{generation.path}/{kind}_names").collect()
    }
    table = spark.read.parquet(f"{generation.path}/{kind}")
    long = table.groupBy("name").count().where(F.col("count") > most).first()
    if long is not None:
        raise ValueError(f"{long['name']} has more than {most} values")
    for row in table.orderBy("name", "rank").collect():
        lists[row["name"]].append(row["value"])
    return lists


def save_numbers(spark: SparkSession, generation: Generation, kind: str, numbers: Mapping[str, float]) -> None:
    table = spark.createDataFrame(list(numbers.items()), "name string, value double")
    table.coalesce(1).write.mode("overwrite").parquet(f"{generation.path}/{kind}")


def load_numbers(spark: SparkSession, generation: Generation, kind: str) -> dict[str, float]:
    return {r["name"]: r["value"] for r in spark.read.parquet(f"{generation.path}/{kind}").collect()}


def _editions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of all published generations whose table is complete."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/{PUBLISHED}")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit() and exists(spark, f"{store}/{PUBLISHED}/{n}/_SUCCESS"))


def publish(spark: SparkSession, generation: Generation, facts: Mapping[str, object]) -> None:
    """From now on readers see this generation. Of two runs that publish at once one fails."""
    edition = max(_editions(spark, generation.store), default=0) + 1
    row = spark.createDataFrame([(generation.name, json.dumps(dict(facts)))], "generation string, facts string")
    row.coalesce(1).write.mode("errorifexists").parquet(f"{generation.store}/{PUBLISHED}/{edition}")


def latest(spark: SparkSession, store: str) -> tuple[Generation, dict]:
    """The generation published last, and its facts."""
    editions = _editions(spark, store)
    if not editions:
        raise ValueError(f"nothing was published in {store}")
    row = spark.read.parquet(f"{store}/{PUBLISHED}/{editions[-1]}").first()
    return Generation(store, row["generation"]), json.loads(row["facts"])

