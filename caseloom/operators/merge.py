"""Merging one-row-per-entity tables into the master matrix."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _stacked(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Union of the tables; table ``i`` fills the struct column ``_t<i>``."""
    tagged = []
    for i, frame in enumerate(frames):
        fields = F.struct(F.lit(1).alias("_row"), *[F.col(c) for c in frame.columns if c != key])
        tagged.append(frame.where(F.col(key).isNotNull()).select(key, fields.alias(f"_t{i}")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _check_names(frames: Sequence[DataFrame], key: str) -> None:
    seen: set[str] = set()
    for frame in frames:
        names = {c for c in frame.columns if c != key}
        if names & seen:
            raise ValueError(f"columns {sorted(names & seen)} come from two tables")
        seen |= names


def _merged(frames: Sequence[DataFrame], key: str, keep: Column | None) -> DataFrame:
    _check_names(frames, key)
    tables = [f"_t{i}" for i in range(len(frames))]
    # One aggregate per table, however wide the table is.
    merged = _stacked(frames, key).groupBy(key).agg(
        *[F.any_value(t, ignoreNulls=F.lit(True)).alias(t) for t in tables],
        *[F.count(t).alias(f"_n{t}") for t in tables],
    )
    doubled = F.greatest(*[f"_n{t}" for t in tables], F.lit(0)) > 1
    message = F.concat(F.lit(f"more than one row in a source for {key} "), F.col(key))
    # A filter, so that the key column keeps the layout later merges can build on.
    checked = merged.where(F.when(doubled, F.raise_error(message)).otherwise(F.lit(True)))
    if keep is not None:
        checked = checked.where(keep)
    return checked.select(
        key,
        *[F.col(f"{t}.{c}") for t, frame in zip(tables, frames) for c in frame.columns if c != key],
    )


def merge_outer(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer merge: every entity of any table, nulls where a table lacks it.

    The tables are stacked and grouped once, and tables already grouped by the key
    are not moved again. A chain of full outer joins would reshuffle the growing
    result at each step. A second row for an entity in one table raises an error.
    """
    return _merged(frames, key, None)


def merge_inner(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Inner merge of the same kind: entities every table has."""
    everywhere = reduce(lambda a, b: a & b, [F.col(f"_t{i}").isNotNull() for i in range(len(frames))])
    return _merged(frames, key, everywhere)


def merge_chain(frames: Sequence[DataFrame], key: str, how: str = "full_outer") -> DataFrame:
    """Pairwise joins, for tables which may hold several rows per entity."""
    return reduce(lambda a, b: a.join(b, key, how), frames)
