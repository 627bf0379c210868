"""Global order without a global sort.

Rows are put into ordered buckets, buckets are counted, and a row's place is the count
of all earlier buckets plus its place inside its own. Only bucket counts, whose number
is fixed, ever meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

HASH_DIGITS = 3
MOST_BUCKETS = 16**HASH_DIGITS


def key_hash(key: Column | str, seed: int) -> Column:
    """Hex digest that orders entities at random, the same on every run and partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")).cast("binary"))


def key_fraction(key: Column | str, seed: int) -> Column:
    """The digest as a number in [0, 1)."""
    head = F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10)
    return head.cast("double") / F.lit(float(2**32))


def hash_bucket(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("int")


def value_bucket(
    df: DataFrame, col: str, into: str = "_bucket", buckets: int | None = None
) -> DataFrame:
    """Ordered buckets of about equal row count for a numeric column.

    The split points come from one sketch pass and are plain literals afterwards, so a
    task that is run again puts its rows in the same buckets. Rows need a value.
    """
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(buckets, MOST_BUCKETS))
    points: list[float] = []
    if buckets > 1:
        grid = [i / buckets for i in range(1, buckets)]
        row = df.agg(F.percentile_approx(col, grid, 4 * buckets).alias("points")).first()
        points = sorted({float(p) for p in row.points or []})
    if not points:
        return df.withColumn(into, F.lit(0))
    splits = [float("-inf"), *points, float("inf")]
    cut = Bucketizer(splits=splits, inputCol=col, outputCol=into, handleInvalid="keep")
    return cut.transform(df).withColumn(into, F.col(into).cast("int"))


def earlier(counts: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """For each bucket, the totals of ``columns`` over all earlier buckets."""
    window = (
        Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(c).over(window), F.lit(0)).alias(f"_before_{c}") for c in columns],
    )


def ranked(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """``_rank`` from 1 within each ``by`` group, over rows that carry ``_bucket``.

    The join with the bucket offsets and the window need the same partitioning, so the
    rows move once.
    """
    keys = [*by, "_bucket"]
    offsets = earlier(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), ["n"], by)
    window = Window.partitionBy(*keys).orderBy(*order)
    placed = df.join(offsets, keys).withColumn("_place", F.row_number().over(window))
    return placed.withColumn("_rank", F.col("_before_n") + F.col("_place")).drop(
        "_before_n", "_place", "_bucket"
    )


def smallest(df: DataFrame, n: int | Column, order: Sequence[Column]) -> DataFrame:
    """The ``n`` first rows in the given order, for rows that carry ``_bucket``.

    Whole buckets past the ``n``-th row are dropped before anything is shuffled. Bucket
    counts number at most ``MOST_BUCKETS``, which makes them safe to broadcast.
    """
    counts = df.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = earlier(counts, ["n"]).where(F.col("_before_n") < n)
    near = df.join(F.broadcast(offsets), "_bucket")
    window = Window.partitionBy("_bucket").orderBy(*order)
    placed = near.withColumn("_place", F.row_number().over(window))
    kept = placed.where(F.col("_before_n") + F.col("_place") <= n)
    return kept.drop("_before_n", "_place", "_bucket")


def random_order(df: DataFrame, key: str, seed: int) -> tuple[DataFrame, list[Column]]:
    """``df`` with the bucket of its random order, and that order's sort columns."""
    digest = key_hash(key, seed)
    return df.withColumn("_bucket", hash_bucket(digest)), [digest, F.col(key)]


def random_sample(df: DataFrame, key: str, n: int | Column, seed: int) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), drawn without replacement."""
    bucketed, order = random_order(df, key, seed)
    return smallest(bucketed, n, order)


def nth_value(df: DataFrame, col: str, n: int) -> tuple[float, int] | None:
    """The ``n``-th smallest value and how many rows are smaller; None if there are fewer.

    Works on distinct values, so a value shared by a third of the rows is one row here.
    """
    values = (
        value_bucket(df, col).groupBy("_bucket", col).agg(F.count(F.lit(1)).alias("n"))
    )
    totals = values.groupBy("_bucket").agg(F.sum("n").alias("n"))
    window = Window.partitionBy("_bucket").orderBy(col)
    through = F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, 0))
    placed = values.withColumn("_through", through).join(earlier(totals, ["n"]), "_bucket")
    last = F.col("_before_n") + F.col("_through")
    hit = placed.where((last - F.col("n") < n) & (last >= n))
    row = hit.select(F.col(col).alias("value"), (last - F.col("n")).alias("smaller")).first()
    return (row.value, row.smaller) if row else None


def top_rows(
    df: DataFrame, col: str, key: str, n: int, descending: bool = False, seed: int = 0
) -> DataFrame:
    """The ``n`` rows with the smallest (or largest) ``col``.

    Rows that tie for the last places are drawn at random, but always the same ones.
    """
    signed = -F.col(col) if descending else F.col(col)
    rows = df.where(F.col(col).isNotNull()).withColumn("_by", signed.cast("double"))
    if n < 1:
        return df.limit(0)
    limit = nth_value(rows, "_by", n)
    if limit is None:
        return rows.drop("_by")
    value, smaller = limit
    tied = random_sample(rows.where(F.col("_by") == value), key, n - smaller, seed)
    return rows.where(F.col("_by") < value).unionByName(tied).drop("_by")
