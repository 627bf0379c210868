"""Whole-frame column rewrites. Each is a projection; none moves a row."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from caseloom.functions.scalars import slugs, to_number
from caseloom.operators.aggregates import unpivot

# The broad pattern the cleaning step uses by default, and a narrow one.
UNKNOWN_BROAD = "(?i)un"
UNKNOWN_NARROW = "(?i)unknown|unspecified"


def coerce_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text columns as numbers; unreadable text becomes null and the row stays."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            c: to_number(c) if isinstance(kinds[c], StringType) else F.col(c).cast("double")
            for c in cols
        }
    )


def binarise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts to 0/1; null stays null."""
    return df.withColumns({c: (F.col(c) != 0).cast("int") for c in cols})


def drop_columns_matching(
    df: DataFrame, pattern: str = UNKNOWN_BROAD, keep: Sequence[str] = ()
) -> DataFrame:
    return df.select([c for c in df.columns if c in keep or not re.search(pattern, c)])


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)]


def one_hot(
    df: DataFrame,
    vocab: Mapping[str, Sequence[str | None]],
    drop: bool = True,
) -> DataFrame:
    """A 0/1 column ``<column>_<value>`` per fitted value.

    Null and unseen values light no column, unless the vocabulary lists ``None``. Two columns
    of one name, capital or small, are an error.
    """
    hot = {}
    taken = {c.lower() for c in df.columns}
    for col, values in vocab.items():
        for name, value in zip(slugs(["null" if v is None else v for v in values]), values):
            into = f"{col}_{name}"
            if into.lower() in taken:
                raise ValueError(f"one-hot column {into} of {col} already exists")
            taken.add(into.lower())
            hot[into] = F.col(col).eqNullSafe(value).cast("int")
    wide = df.withColumns(hot)
    return wide.drop(*vocab) if drop else wide


def fit_categories(df: DataFrame, cols: Sequence[str], most: int = 1000) -> dict[str, list[str]]:
    """Distinct non-empty values per column, in one pass.

    One-hot needs short lists, so more than ``most`` values of a column is an error.
    """
    found = unpivot(df, cols).where(F.col("value") != "").distinct()
    rows = found.limit(most * len(cols) + 1).collect()
    values: dict[str, list[str]] = {c: [] for c in cols}
    for column, value in rows:
        values[column].append(value)
    for column, seen in values.items():
        if len(seen) > most:
            raise ValueError(f"{column} has more than {most} values; it is not a category")
    return {c: sorted(v) for c, v in values.items()}
