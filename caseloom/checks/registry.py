"""Registered queries, each next to the SQL it has to agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql.strip()
        return build

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at a precision both engines' summation orders agree on."""

    def short(name: str, kind: str) -> Column:
        return F.round(name, digits).alias(name) if kind == "double" else F.col(name)

    return df.select(*[short(name, kind) for name, kind in df.dtypes])
