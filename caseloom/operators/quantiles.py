"""Exact quantiles with linear interpolation, and column summaries.

Doubles are put in order by their 64 bits, 16 at a time. A pass counts, for every wanted
rank, the values that share the digits known so far, by their next digit; the digit at
which the counts reach the rank is the next one known, and after at most four passes the value
is. A rank is found as soon as the values that share its digits are all the same; values that are
no more than 65,536 are told apart in full by the next pass, which is usually the second or the
last one, and a pass reads only the columns whose ranks are open.
So a task sees at most 65,536 counts per column and rank, whatever the table holds, and
values shared by many rows are one count. A short table is aggregated directly.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from math import floor

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from caseloom.session import cut_lineage

# Tasks get these functions by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows up to which a table is aggregated directly.
SHORT = 100_000
DIGIT = 16
SIGN = np.uint64(1 << 63)


def _doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as doubles, with NaN as null."""
    values = {c: F.col(c).cast("double") for c in cols}
    return df.select(*[F.when(~F.isnan(v), v).alias(c) for c, v in values.items()])


def sortable(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; both zeros are one."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits & SIGN, ~bits, bits | SIGN)


def from_sortable(number: int) -> float:
    bits = number ^ int(SIGN) if number & int(SIGN) else ~number & (1 << 64) - 1
    return float(np.array([bits], dtype=np.uint64).view(np.float64)[0])


def digit_counts(
    numbers: DataFrame, known: dict[int, set[int]], level: int, whole: dict[int, set[int]] | None = None
) -> DataFrame:
    """``column``, ``known``, ``digit`` and ``n``: values by their next digit, of those whose first
    ``level`` digits are listed for their column (by its place); where they are also listed in
    ``whole``, by all the digits left. ``low`` and ``high`` are the extremes of these values, as
    signed numbers in their order."""
    names = ["column", "known", "digit", "n", "low", "high"]
    left = 64 - DIGIT * level
    wanted = {c: np.array(sorted(digits), dtype=np.uint64) for c, digits in known.items()}
    full = {c: np.array(sorted(digits), dtype=np.uint64) for c, digits in (whole or {}).items()}
    read = sorted(known)

    def groups(values: np.ndarray, c: int, bits: int) -> list[np.ndarray]:
        """Of sorted values, those that agree down to ``bits`` from the end."""
        upto = values >> np.uint64(bits)
        starts = np.flatnonzero(np.r_[True, upto[1:] != upto[:-1]])
        ends = np.r_[starts[1:], len(values)]
        digits = np.uint64(left - bits)
        before = upto[starts] >> digits if level else np.zeros(len(starts), dtype=np.uint64)
        digit = upto[starts] & np.uint64((1 << (left - bits)) - 1)
        low, high = ((v ^ SIGN).view(np.int64) for v in (values[starts], values[ends - 1]))
        return [np.full(len(starts), c), before, digit, ends - starts, low, high]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for place, c in enumerate(read):
                values = sortable(batch.column(place).drop_null().to_numpy(zero_copy_only=False))
                in_full = np.zeros(len(values), dtype=bool)
                if level:
                    # the digits before this one, in one number
                    before = values >> np.uint64(left)
                    mine = np.isin(before, wanted[c])
                    values, before = values[mine], before[mine]
                    in_full = np.isin(before, full.get(c, wanted[c][:0]))
                for part, bits in ((values[~in_full], left - DIGIT), (values[in_full], 0)):
                    if len(part):
                        found.append(groups(np.sort(part), c, bits))
            if found:
                joined = [np.concatenate(parts).astype(np.int64) for parts in zip(*found)]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in joined], names)

    schema = ", ".join(f"{n} long" for n in names)
    narrow = numbers.toDF(*[f"v{i}" for i in range(len(numbers.columns))]).select(*[f"v{c}" for c in read])
    return narrow.mapInArrow(count, schema).groupBy(*names[:3]).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def order_statistics(
    numbers: DataFrame, wanted: dict[int, set[int]], first: DataFrame | None = None
) -> dict[tuple[int, int], float]:
    """The values at ranks (from 0) of columns, by the place of the column and the rank.

    Every rank has to be below the number of values in its column. ``first`` are the counts of
    the first digits, if they are there already.
    """
    spark = numbers.sparkSession
    # of each open rank: the digits known so far, its rank among the values that share them, and their number
    at = {(c, rank): (0, rank, 0) for c, ranks in wanted.items() for rank in ranks}
    values: dict[tuple[int, int], float] = {}
    level = 0
    while at:
        known: dict[int, set[int]] = {}
        whole: dict[int, set[int]] = {}
        for (c, _), (digits, _, n) in at.items():
            known.setdefault(c, set()).add(digits)
            if level and n <= 1 << DIGIT:
                whole.setdefault(c, set()).add(digits)
        counts = first if first is not None and not level else digit_counts(numbers, known, level, whole)
        targets = spark.createDataFrame(
            [(c, digits, rank, left) for (c, rank), (digits, left, _) in at.items()],
            "column long, known long, rank long, left long",
        )
        window = Window.partitionBy("column", "known").orderBy("digit")
        through = F.sum("n").over(window)
        placed = counts.withColumn("through", through)
        hit = (F.col("through") - F.col("n") <= F.col("left")) & (F.col("left") < F.col("through"))
        # one row per open rank
        found = placed.join(F.broadcast(targets), ["column", "known"]).where(hit).collect()
        at = {}
        for r in found:
            key = r["column"], r["rank"]
            if r["low"] == r["high"]:
                values[key] = from_sortable(r["low"] + int(SIGN))
            else:
                at[key] = r["known"] << DIGIT | r["digit"], r["left"] - (r["through"] - r["n"]), r["n"]
        level += 1
    return values


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probabilities: Sequence[float],
    short: int = SHORT,
) -> dict[str, list[float | None]]:
    """Quantiles of each column, equal to a full sort with linear interpolation.

    Up to ``short`` rows are aggregated directly.
    """
    numbers = _doubles(df, cols)
    if numbers.count() <= short:
        levels = F.array(*[F.lit(float(p)) for p in probabilities])
        row = numbers.agg(*[F.percentile(c, levels).alias(c) for c in cols]).first()
        return {c: row[c] or [None] * len(probabilities) for c in cols}
    first = cut_lineage(digit_counts(numbers, {i: {0} for i in range(len(cols))}, 0))
    sizes = {r["column"]: r["n"] for r in first.groupBy("column").agg(F.sum("n").alias("n")).collect()}
    places = {(i, p): p * (n - 1) for i, n in sizes.items() for p in probabilities}
    wanted: dict[int, set[int]] = {}
    for (i, _), place in places.items():
        wanted.setdefault(i, set()).update((floor(place), min(floor(place) + 1, sizes[i] - 1)))
    values = order_statistics(numbers, wanted, first)

    def quantile(i: int, p: float) -> float | None:
        if (i, p) not in places:
            return None
        below = floor(places[i, p])
        low, high = values[i, below], values[i, min(below + 1, sizes[i] - 1)]
        return low if low == high else low + (places[i, p] - below) * (high - low)

    return {c: [quantile(i, p) for p in probabilities] for i, c in enumerate(cols)}


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    return {c: found[0] for c, found in exact_quantiles(df, cols, [0.5]).items()}


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, a row per column."""
    numbers = _doubles(df, cols)
    stats = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = numbers.agg(
        *[f(c).alias(f"{name}_{k}") for k, c in enumerate(cols) for name, f in stats.items()]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"), *[F.col(f"{name}_{k}").alias(name) for name in stats]
        )
        for k, c in enumerate(cols)
    ]
    quartiles = df.sparkSession.createDataFrame(
        [(c, *q) for c, q in exact_quantiles(df, cols, [0.25, 0.5, 0.75]).items()],
        "column string, q25 double, q50 double, q75 double",
    )
    return wide.select(F.inline(F.array(*rows))).join(F.broadcast(quartiles), "column")
