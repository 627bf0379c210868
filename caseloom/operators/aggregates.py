"""Grouped aggregates, pivots and reports.

Pivots are conditional aggregates in a single ``groupBy``: one shuffle, with partial
aggregation in front of it, so an entity holding a third of all rows still reaches
its reducer as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from caseloom.functions.rules import BRANDS
from caseloom.functions.scalars import day_band, row_max, row_min, slugs


def present(key: str) -> Column:
    """Entities without an id belong to nobody."""
    return F.col(key).isNotNull()


def unpivot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long ``(column, value)`` rows of the named columns as text, nulls left out."""
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in cols
            ]
        )
    )
    return df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull())


# --- Spans ------------------------------------------------------------------


def entity_span(df: DataFrame, key: str, day: str, source: str | None = None) -> DataFrame:
    """Earliest and latest day per entity. Copies cannot change it, so none are removed."""
    infix = f"_{source}_response" if source else ""
    return (
        df.where(present(key))
        .groupBy(key)
        .agg(
            F.min(day).alias(f"earliest{infix}_to_covid_diag"),
            F.max(day).alias(f"latest{infix}_to_covid_diag"),
        )
    )


def overall_span(frames: Sequence[DataFrame], key: str, day: str) -> DataFrame:
    """Earliest and latest day per entity over several event logs, in one shuffle."""
    days = [frame.select(key, day) for frame in frames]
    union = days[0]
    for frame in days[1:]:
        union = union.unionByName(frame)
    return entity_span(union, key, day)


def span_of_spans(
    df: DataFrame, key: str, earliest: Sequence[str], latest: Sequence[str]
) -> DataFrame:
    """Row-wise form of the same over already merged span columns."""
    return df.select(
        key,
        row_min(earliest).alias("earliest_to_covid_diag"),
        row_max(latest).alias("latest_to_covid_diag"),
    )


# --- Pivots -----------------------------------------------------------------


def _named(prefix: str, values: Sequence[str]) -> list[tuple[str, str]]:
    return list(zip([f"{prefix}{s}" for s in slugs(values)], values))


def presence_pivot(
    df: DataFrame, key: str, category: str, values: Sequence[str], prefix: str
) -> DataFrame:
    """1 where the entity has the category, else 0."""
    flags = [
        F.max(F.when(F.col(category) == value, 1).otherwise(0)).alias(name)
        for name, value in _named(prefix, values)
    ]
    return df.where(present(key)).groupBy(key).agg(*flags)


def count_pivot(
    df: DataFrame,
    key: str,
    category: str,
    values: Sequence[str],
    prefix: str,
    binary: bool = False,
    times: str | None = None,
) -> DataFrame:
    """Rows per entity and category, 0 where none; ``binary`` turns them into 0/1.

    A row stands for as many as its column ``times`` says, if one is named.
    """
    named = _named(prefix, values)

    def count(value: str) -> Column:
        hit = F.col(category) == value
        return F.sum(F.when(hit, F.col(times)).otherwise(0)) if times else F.count_if(hit)

    wide = (
        df.where(present(key) & F.col(category).isNotNull())
        .groupBy(key)
        .agg(*[count(value).alias(name) for name, value in named])
    )
    if not binary:
        return wide
    return wide.select(
        key, *[(F.col(name) != 0).cast("int").alias(name) for name, _ in named]
    )


def rate_pivot(
    df: DataFrame, key: str, category: str, flag: str, values: Sequence[str], prefix: str
) -> DataFrame:
    """Mean 0/1 flag per entity and category; null where there was no verdict.

    Entities without any verdict are left out after the aggregate: a filter in front of
    it would work every flag out twice.
    """
    rates = [
        F.avg(F.when(F.col(category) == value, F.col(flag))).alias(name)
        for name, value in _named(prefix, values)
    ]
    wide = df.where(present(key)).groupBy(key).agg(F.count(flag).alias("_flags"), *rates)
    return wide.where(F.col("_flags") > 0).drop("_flags")


@dataclass(frozen=True)
class Measure:
    """One panel entry: which label, what to call it, which statistics, what is plausible."""

    label: str
    prefix: str
    stats: tuple[str, ...] = ("max", "mean")
    low: float | None = None
    high: float | None = None


STATISTICS = {"min": F.min, "max": F.max, "mean": F.avg}


def measure_columns(
    label: Column, value: Column, measures: Sequence[Measure], usable: Column | None = None
) -> list[Column]:
    """Conditional aggregates of a panel, ready for one ``agg``.

    ``value`` has to be numeric; null values count for nothing.
    """
    columns = []
    for m in measures:
        test = label == m.label
        if usable is not None:
            test = test & usable
        if m.low is not None:
            test = test & (value >= m.low)
        if m.high is not None:
            test = test & (value <= m.high)
        for stat in m.stats:
            columns.append(STATISTICS[stat](F.when(test, value)).alias(f"{m.prefix}_{stat}"))
    return columns


def panel(
    df: DataFrame, key: str, label: str, value: str, measures: Sequence[Measure]
) -> DataFrame:
    """Statistics of every measure per entity. Every entity in ``df`` gets a row."""
    return (
        df.where(present(key))
        .groupBy(key)
        .agg(*measure_columns(F.col(label), F.col(value), measures))
    )


def consistent_label(
    df: DataFrame, key: str, value: str, keep_null_rows: bool = False
) -> DataFrame:
    """The entity's value where all its known values agree; other entities are left out.

    ``keep_null_rows`` adds a second, null row for an agreeing entity that also has a
    missing value.
    """
    agreed = (
        df.where(present(key))
        .select(key, value)
        .distinct()
        .groupBy(key)
        .agg(
            F.min(value).alias("_low"),
            F.max(value).alias(value),
            F.max(F.col(value).isNull()).alias("_gap"),
        )
        .where(F.col("_low") == F.col(value))
    )
    if not keep_null_rows:
        return agreed.select(key, value)
    both = F.array(F.col(value), F.lit(None).cast("string"))
    only = F.array(F.col(value))
    return agreed.select(key, F.explode(F.when(F.col("_gap"), both).otherwise(only)).alias(value))


# --- Text profiles ----------------------------------------------------------


def flag_profile(df: DataFrame, key: str, flags: Mapping[str, Column]) -> DataFrame:
    """1 where any of the entity's rows raises the flag."""
    return (
        df.where(present(key))
        .groupBy(key)
        .agg(*[F.max(flag).alias(name) for name, flag in flags.items()])
    )


def latest_value(value: Column, *order: str) -> Column:
    """Aggregate: the value on the entity's last row in the given order."""
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))


def label_set(label: Column, labels: Sequence[str] = BRANDS) -> Column:
    """Aggregate: the sorted, comma-joined labels an entity has, from a closed list."""
    return F.concat_ws(
        ",", *[F.when(F.max(F.when(label == v, 1)) == 1, F.lit(v)) for v in sorted(labels)]
    )


# --- Vocabularies -----------------------------------------------------------


def value_counts(df: DataFrame, col: str, weight: str | None = None) -> DataFrame:
    """Rows per value (non-null ``weight`` rows when given), most frequent first."""
    counted = F.count(weight if weight else F.lit(1)).alias("n")
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(counted)
    return counts.orderBy(F.desc("n"), F.asc(col))


def all_value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` for several columns in one scan and one shuffle."""
    return unpivot(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def top_k_vocab(
    df: DataFrame,
    col: str,
    k: int,
    weight: str | None = None,
    exclude: Column | None = None,
) -> DataFrame:
    """The ``k`` most frequent values with their rank; ties go to the smaller value."""
    rows = df if exclude is None else df.where(~F.coalesce(exclude, F.lit(False)))
    top = value_counts(rows, col, weight).limit(k)
    # At most k rows are left, so a plain array of them numbers the ranks.
    packed = top.agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(col).alias("v")))
        ).alias("a")
    )
    return packed.select(F.posexplode("a").alias("rank", "r")).select(
        F.col("r.v").alias("value"), "rank", (-F.col("r.m")).alias("n")
    )


def vocab_values(vocab: DataFrame, most: int = 1000) -> list[str]:
    """A fitted vocabulary as a list, in rank order. Refuses anything but a short one."""
    rows = vocab.orderBy("rank").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"vocabulary has more than {most} values")
    return [row["value"] for row in rows]


def vocab_coverage(df: DataFrame, col: str, vocab: DataFrame, key: str) -> DataFrame:
    """Rows kept by a vocabulary and their share, in one pass over the value counts."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    words = vocab.select(F.col("value").alias(col), F.lit(1).alias("known"))
    return (
        counts.join(words, col, "left")
        .agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("known") == 1, F.col("n"))), F.lit(0)).alias("kept"),
            F.count(col).alias("values"),
        )
        .withColumn("share", F.col("kept") / F.col("rows"))
    )


# --- Reports ----------------------------------------------------------------


def dedup_ratio(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and their ratio from a single shuffle."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("distinct_rows")
    ).withColumn("kept", F.col("distinct_rows") / F.col("rows"))


def distinct_count(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column."""
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in cols]
        return wide.select(F.inline(F.array(*pairs)))
    values = unpivot(df, cols).distinct()
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("n"))


def column_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    wide = df.agg(*[F.sum(c).alias(c) for c in cols])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("total")) for c in cols]
    return wide.select(F.inline(F.array(*pairs)))


def crosstab(
    df: DataFrame, row: str, col: str, values: Sequence[object], prefix: str
) -> DataFrame:
    """Counts of ``col`` values per ``row`` value."""
    return df.groupBy(row).agg(
        *[F.count_if(F.col(col) == v).alias(f"{prefix}{v}") for v in values]
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )
    total = F.col("positives") + F.col("negatives")
    return counts.withColumn("positive_fraction", F.try_divide("positives", total))


def per_visit_counts(df: DataFrame, key: str, day: str) -> DataFrame:
    return df.groupBy(key, day).agg(F.count(F.lit(1)).alias("n"))


def conflicting_results(
    df: DataFrame, key: str, day: str, test: str, name: str, result: str
) -> DataFrame:
    """Same-day contradictions of one test: days on which an entity got several results."""
    results = (
        df.where((F.col(test) == name) & F.col(result).isNotNull())
        .select(key, day, result)
        .distinct()
    )
    return (
        results.groupBy(key, day)
        .agg(F.count(F.lit(1)).alias("results"))
        .where(F.col("results") > 1)
    )


def results_per_entity(
    df: DataFrame, key: str, test: str, name: str, result: str
) -> DataFrame:
    return df.where(F.col(test) == name).groupBy(key).agg(F.count(result).alias("n"))


def day_bands(df: DataFrame, key: str, day: str, edges: tuple[int, int] = (7, 14)) -> DataFrame:
    """Rows per entity in the early, middle and late response band."""
    low, high = edges
    names = {f"<{low}": "early", f"{low}-{high}": "middle", f">{high}": "late"}
    band = day_band(day, edges)
    return (
        df.where(present(key))
        .groupBy(key)
        .agg(*[F.count_if(band == b).alias(name) for b, name in names.items()])
    )


def metric_summary(df: DataFrame, by: str, metrics: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation of each metric per group."""
    columns = []
    for m in metrics:
        columns += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_std")]
    return df.groupBy(by).agg(*columns)


def distinct_ranges(df: DataFrame, test: str, normal: str) -> DataFrame:
    """Every normal range each test was reported with, and how often."""
    return df.groupBy(test, normal).agg(F.count(F.lit(1)).alias("n"))


def label_rate_by(df: DataFrame, bucket: str, label: str) -> DataFrame:
    return df.groupBy(bucket).agg(
        F.count(F.lit(1)).alias("n"), F.avg(label).alias("label_rate")
    )


def coverage(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Which sources know each entity, as 0/1 columns, in one shuffle."""
    union = None
    for name, frame in frames.items():
        part = frame.where(present(key)).select(key, F.lit(name).alias("_source"))
        union = part if union is None else union.unionByName(part)
    flags = [
        F.max(F.when(F.col("_source") == name, 1).otherwise(0)).alias(name) for name in frames
    ]
    return union.groupBy(key).agg(*flags)
