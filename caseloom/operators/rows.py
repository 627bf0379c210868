"""Row filters, dedup and sampling-free set operations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from caseloom.functions.scalars import has_digit, to_number, within

# A literal IN list this long still plans quickly and reaches the parquet reader.
MAX_LITERALS = 1000
# A lookup table this short fits into every executor many times over.
SHORT_TABLE = 100_000
# Into how many parts the rows of one entity are dealt where they are told apart.
SPREAD = 4


def is_short(df: DataFrame, most: int = SHORT_TABLE) -> bool:
    """Whether the table has at most ``most`` rows; looks at no more than one beyond."""
    return df.limit(most + 1).count() <= most


def dedup(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, of the named columns only when given.

    Copies collapse before the shuffle, so a much-repeated row moves once per task.
    """
    return (df.select(*cols) if cols else df).distinct()


def dedup_by(df: DataFrame, key: str, spread: int = SPREAD) -> DataFrame:
    """Distinct rows, for totals per entity to be taken of them.

    The rows of an entity lie in at most ``spread`` parts, so they leave so many partial
    totals, into however many parts the table is dealt. The part is picked by the row itself:
    copies meet in it, and an entity of very many rows is not left to one task.
    """
    part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c != key]), F.lit(spread))
    return df.withColumn("_part", part).repartition(key, "_part").distinct().drop("_part")


def keep_in_vocab(df: DataFrame, col: str, vocab: DataFrame | Iterable[str]) -> DataFrame:
    """Rows whose ``col`` is in the vocabulary.

    A short list becomes a literal predicate that is pushed into the scan. A table is
    semi-joined on its first column and Spark chooses broadcast or shuffle by its size.
    """
    if isinstance(vocab, DataFrame):
        words = vocab.select(F.col(vocab.columns[0]).alias(col)).where(F.col(col).isNotNull())
        return df.join(words, col, "left_semi")
    values = sorted({v for v in vocab if v is not None})
    if len(values) <= MAX_LITERALS:
        return df.where(F.col(col).isin(values))
    words = df.sparkSession.createDataFrame([(v,) for v in values], f"{col} string")
    return df.join(words, col, "left_semi")


def drop_value(df: DataFrame, col: str, value: object) -> DataFrame:
    """Rows whose ``col`` is anything but ``value``; nulls stay."""
    return df.where(~F.col(col).eqNullSafe(value))


def complete_cases(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(subset) if subset else None)


def numeric_only(df: DataFrame, col: str, into: str | None = None) -> DataFrame:
    """``col`` as a number in ``into``; rows without one are dropped."""
    into = into or col
    return df.withColumn(into, to_number(col)).where(F.col(into).isNotNull())


def digits_only(df: DataFrame, col: str) -> DataFrame:
    return df.where(has_digit(col))


def plausible(
    df: DataFrame, col: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    return df.where(within(col, low, high))


def inner_on(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner equi join on the entity; a null key never matches."""
    return left.join(right, key, "inner")


def dictionary_join(
    df: DataFrame,
    col: str,
    dictionary: DataFrame,
    word: str,
    how: str = "left",
    short: bool | None = None,
) -> DataFrame:
    """Look ``col`` up in a dictionary table.

    A dictionary counted to be short is broadcast, so a word in a third of the rows
    moves nothing. A longer one is joined by shuffle, where skewed words are split.
    """
    renamed = dictionary.withColumnRenamed(word, col) if word != col else dictionary
    if short is None:
        short = is_short(renamed)
    return df.join(F.broadcast(renamed) if short else renamed, col, how)


def without_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")


def with_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def stack_rows(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def dictionary_problems(dictionary: DataFrame, word: str, value: str) -> DataFrame:
    """Dictionary lines that would silently lose rows: no value, or a doubled word."""
    repeats = F.count(F.lit(1)).alias("lines")
    return (
        dictionary.groupBy(word)
        .agg(repeats, F.count(value).alias("valued"))
        .where((F.col("lines") > 1) | (F.col("valued") < F.col("lines")))
    )
