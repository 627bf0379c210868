"""Scalar expressions. All of them stay inside generated JVM code."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Text accepted as a finite or infinite number, and the number
# pattern looked for inside a normal-range text.
NUMBER_PATTERN = r"^\s*[-+]?(\d+\.?\d*([eE][-+]?\d+)?|\.\d+([eE][-+]?\d+)?|(?i:inf|infinity))\s*$"
RANGE_NUMBER_PATTERN = r"[-+]?(?:\d*\.*\d+)"
RANGE_OPERATORS = (">=", "<=", "<", ">")

UNKNOWN_YEAR = 1968
EARLIEST_YEAR = 1932
REFERENCE_YEAR = 2021
OUTBREAK_DATE = dt.date(2020, 1, 1)
CUTOFF_DATE = dt.date(2021, 6, 1)

# What a missing code or unit reads as inside a label.
NULL_TOKEN = "None"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text as double; anything that is not a number, and NaN, becomes null."""
    c = _col(c)
    return F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))


def has_digit(c: Column | str) -> Column:
    return _col(c).rlike(r"\d")


def within(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """True where the value lies in the closed bounds; an absent bound is open."""
    c = _col(c)
    test = c.isNotNull()
    if low is not None:
        test = test & (c >= low)
    if high is not None:
        test = test & (c <= high)
    return test


def code_chapter(c: Column | str, n: int = 1, null_token: str | None = NULL_TOKEN) -> Column:
    """Leading ``n`` characters of a code; a null code reads as ``null_token``."""
    c = _col(c)
    if null_token is not None:
        c = F.coalesce(c, F.lit(null_token))
    return F.substring(c, 1, n)


def label_with_unit(label: Column | str, unit: Column | str) -> Column:
    """``label(unit)``, with a missing unit spelled out."""
    return F.concat(
        F.coalesce(_col(label), F.lit(NULL_TOKEN)),
        F.lit("("),
        F.coalesce(_col(unit), F.lit(NULL_TOKEN)),
        F.lit(")"),
    )


def concat_key(*parts: Column | str, sep: str = "_") -> Column:
    """Parts joined by ``sep``; null as soon as one part is null."""
    joined: list[Column] = []
    for part in parts:
        joined += [_col(part), F.lit(sep)]
    return F.concat(*joined[:-1])


def norm_text(c: Column | str) -> Column:
    return F.upper(F.translate(_col(c), ";", ","))


def clean_year(
    c: Column | str, unknown: int = UNKNOWN_YEAR, earliest: int = EARLIEST_YEAR
) -> Column:
    """Birth-year text as int, with missing, 'Un…' and '… Earlier' spellings resolved."""
    c = _col(c)
    return (
        F.when(c.contains("Earlier"), F.lit(earliest))
        .when(c.isNull() | c.contains("Un"), F.lit(unknown))
        .otherwise(c.try_cast("int"))
    )


def age(year: Column | str, reference: int = REFERENCE_YEAR) -> Column:
    return F.lit(reference) - _col(year)


def days_since(ts: Column | str, day: dt.date = OUTBREAK_DATE) -> Column:
    return F.datediff(_col(ts), F.lit(day))


def after(ts: Column | str, day: dt.date = CUTOFF_DATE) -> Column:
    """1 where the moment is strictly later than midnight of ``day``, else 0."""
    later = _col(ts) > F.lit(day).cast("timestamp")
    return F.coalesce(later, F.lit(False)).cast("int")


def row_min(columns: Sequence[Column | str]) -> Column:
    return F.least(*map(_col, columns))


def row_max(columns: Sequence[Column | str]) -> Column:
    return F.greatest(*map(_col, columns))


def day_band(day: Column | str, edges: Sequence[int] = (7, 14)) -> Column:
    """Band names ``<7``, ``7-14``, ``>14`` for a response day."""
    day = _col(day)
    low, high = edges
    return (
        F.when(day < low, F.lit(f"<{low}"))
        .when(day <= high, F.lit(f"{low}-{high}"))
        .when(day > high, F.lit(f">{high}"))
    )


def _range_parts(result: Column, normal: Column) -> dict[str, Column]:
    """What a verdict needs of the two texts. Dashes separate bounds, so signs are lost."""
    bounds = F.translate(normal, "-", ",")
    return {
        "numbers": F.regexp_extract_all(bounds, F.lit(RANGE_NUMBER_PATTERN), F.lit(0)),
        "sign": F.regexp_replace(bounds, "[^<=>]", ""),
        "value": to_number(result),
    }


def _range_verdict(result: Column, normal: Column, parts: dict[str, Column]) -> Column:
    value, sign, count = parts["value"], parts["sign"], F.size(parts["numbers"])
    first = F.get(parts["numbers"], F.lit(0)).try_cast("double")
    second = F.get(parts["numbers"], F.lit(1)).try_cast("double")

    def verdict(ok: Column) -> Column:
        return F.when(ok, F.lit(0)).otherwise(F.lit(1))

    interval = (
        F.when(value.isNull() | first.isNull(), F.lit(None))
        .when(value < first, F.lit(1))
        .when(second.isNull(), F.lit(None))
        .otherwise(verdict(value <= second))
    )
    holds = (
        F.when(sign == ">=", value >= first)
        .when(sign == "<=", value <= first)
        .when(sign == "<", value < first)
        .otherwise(value > first)
    )
    bounded = (
        F.when(~sign.isin(*RANGE_OPERATORS), F.lit(1))
        .when(value.isNull() | first.isNull(), F.lit(None))
        .otherwise(verdict(holds))
    )
    return (
        F.when(normal.isNull() | (normal == "-") | result.eqNullSafe("unknown"), F.lit(None))
        .when(normal.eqNullSafe(result), F.lit(0))
        .when(count == 2, interval)
        .when(count == 1, bounded)
        .otherwise(F.lit(1))
        .cast("int")
    )


def range_flag(result: Column | str, normal: Column | str) -> Column:
    """0 inside the normal range, 1 outside, null where no verdict is possible.

    Two numbers are a closed interval; one number needs a comparison sign; any other
    count is abnormal.
    """
    result, normal = _col(result), _col(normal)
    return _range_verdict(result, normal, _range_parts(result, normal))


def with_range_flag(df: DataFrame, result: str, normal: str, into: str) -> DataFrame:
    """The same flag as a new column, with each text taken apart once per row."""
    parts = _range_parts(F.col(result), F.col(normal))
    named = {f"_{name}": part for name, part in parts.items()}
    flag = _range_verdict(F.col(result), F.col(normal), {n: F.col(f"_{n}") for n in parts})
    return df.withColumns(named).withColumn(into, flag).drop(*named)


def slug(text: str) -> str:
    """A column-name-safe spelling of a category value."""
    return re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_") or "blank"


def slugs(values: Sequence[str]) -> list[str]:
    """Slugs made unique without regard to case, since column names ignore case."""
    seen: dict[str, int] = {}
    names = []
    for value in values:
        name = slug(value)
        seen[name.lower()] = seen.get(name.lower(), 0) + 1
        repeat = seen[name.lower()]
        names.append(name if repeat == 1 else f"{name}__{repeat}")
    return names
