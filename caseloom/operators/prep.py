"""Imputing, scaling, splitting and class balancing of a feature matrix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from caseloom.operators.quantiles import medians
from caseloom.operators.ranking import (
    key_fraction,
    random_order,
    random_sample,
    ranked,
)


def impute(df: DataFrame, fills: Mapping[str, float | None]) -> DataFrame:
    """Fill nulls and NaN with fitted values; a column without one stays as it is."""
    columns = {}
    for c, fill in fills.items():
        value = F.col(c).cast("double")
        if fill is not None:
            value = F.coalesce(F.when(~F.isnan(value), value), F.lit(float(fill)))
        columns[c] = value
    return df.withColumns(columns)


def median_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return impute(df, medians(df, cols))


def fit_scale(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, in one pass."""
    stats = []
    for k, c in enumerate(cols):
        stats += [F.avg(c).alias(f"m{k}"), F.stddev_pop(c).alias(f"s{k}")]
    row = df.agg(*stats).first()
    return {c: (row[f"m{k}"] or 0.0, row[f"s{k}"] or 0.0) for k, c in enumerate(cols)}


def scale(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Centre and divide; a constant column becomes 0."""
    return df.withColumns(
        {c: (F.col(c) - F.lit(mean)) / F.lit(std or 1.0) for c, (mean, std) in fitted.items()}
    )


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return scale(df, fit_scale(df, cols))


def hash_split(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """``held_out`` = 1 for about ``fraction`` of the entities, the same ones every time."""
    return df.withColumn("held_out", (key_fraction(key, seed) < fraction).cast("int"))


def split(df: DataFrame, key: str, fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows."""
    out = key_fraction(key, seed) < fraction
    return df.where(~out), df.where(out)


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int) -> DataFrame:
    """``fold`` in 0..k-1; each label is dealt out evenly in a random order."""
    bucketed, order = random_order(df, key, seed)
    dealt = ranked(bucketed, order, [label])
    return dealt.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def class_counts(df: DataFrame, label: str) -> tuple[int, int]:
    """Rows labelled 0 and rows labelled 1."""
    row = df.agg(
        F.count_if(F.col(label) == 0).alias("zero"), F.count_if(F.col(label) == 1).alias("one")
    ).first()
    return row.zero, row.one


def downsample(
    df: DataFrame, key: str, label: str, seed: int, n: int | None = None
) -> DataFrame:
    """All rows labelled 1 and ``n`` rows labelled 0, as many as the former by default."""
    if n is None:
        n = class_counts(df, label)[1]
    drawn = random_sample(df.where(F.col(label) == 0), key, n, seed)
    return drawn.unionByName(df.where(F.col(label) == 1))


def copy_numbers(df: DataFrame, key: str, extra: int, rows: int, seed: int) -> DataFrame:
    """``_copies`` per row, summing to ``extra`` over all ``rows`` rows.

    Every row gets the whole part; the remainder goes to rows drawn at random.
    """
    whole, rest = divmod(extra, rows)
    if not rest:
        return df.withColumn("_copies", F.lit(whole))
    bucketed, order = random_order(df, key, seed)
    dealt = ranked(bucketed, order)
    return dealt.withColumn(
        "_copies", F.lit(whole) + (F.col("_rank") <= rest).cast("int")
    ).drop("_rank")


# Copies of one row that a task writes.
COPY_RUN = 1000


def with_copies(df: DataFrame, key: str, into: str) -> DataFrame:
    """Each row ``_copies`` times, numbered from 1 in ``into``.

    A row with many copies is first cut into runs of them, which are dealt out to all tasks,
    so that few rows that stand for many do not end up in one task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = F.explode(F.sequence(F.lit(1), F.col("_copies"), F.lit(COPY_RUN)))
    runs = df.where(F.col("_copies") > 0).withColumn("_from", starts).repartition(tasks, key, "_from")
    last = F.least(F.col("_from") + F.lit(COPY_RUN - 1), F.col("_copies"))
    return runs.withColumn(into, F.explode(F.sequence(F.col("_from"), last))).drop("_from")


def oversample_random(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """Repeat rows labelled 1 until they number as many as the rows labelled 0.

    ``copy`` is 0 for original rows and counts the repeats of one.
    """
    zeros, ones = class_counts(df, label)
    originals = df.withColumn("copy", F.lit(0))
    if not ones or zeros <= ones:
        return originals
    numbered = copy_numbers(df.where(F.col(label) == 1), key, zeros - ones, ones, seed)
    repeats = with_copies(numbered, key, "copy")
    return originals.unionByName(repeats.drop("_copies").select(*originals.columns))


def enrich_test(
    held_out: DataFrame,
    population: DataFrame,
    train: DataFrame,
    key: str,
    label: str,
    n: int,
    seed: int,
) -> DataFrame:
    """The held-out rows plus ``n`` rows labelled 0 that training has not seen."""
    seen = train.select(key).unionByName(held_out.select(key))
    fresh = population.where(F.col(label) == 0).join(seen, key, "left_anti")
    return held_out.unionByName(random_sample(fresh, key, n, seed).select(*held_out.columns))
