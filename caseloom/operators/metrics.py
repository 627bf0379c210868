"""Ranking metrics, confusion counts and rank correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window, functions as F

from caseloom.operators.ranking import earlier, value_bucket
from caseloom.session import cut_lineage


def _score_steps(
    df: DataFrame, label: str, score: str, by: Sequence[str], descending: bool
) -> DataFrame:
    """One row per distinct score with the positives and negatives strictly before it."""
    sign = -1.0 if descending else 1.0
    clean = df.select(
        *by,
        (F.col(score).cast("double") * sign).alias("_score"),
        F.col(label).cast("int").alias("_label"),
    ).where(F.col("_score").isNotNull() & ~F.isnan("_score") & F.col("_label").isNotNull())
    steps = (
        value_bucket(clean, "_score")
        .groupBy(*by, "_bucket", "_score")
        .agg(F.sum("_label").alias("pos"), F.count_if(F.col("_label") == 0).alias("neg"))
    )
    totals = steps.groupBy(*by, "_bucket").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    offsets = earlier(totals, ["pos", "neg"], by)
    window = (
        Window.partitionBy(*by, "_bucket")
        .orderBy("_score")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = [
        F.coalesce(F.sum(c).over(window), F.lit(0)).alias(f"_in_{c}") for c in ("pos", "neg")
    ]
    return (
        steps.select("*", *inside)
        .join(offsets, [*by, "_bucket"])
        .select(
            *by,
            "pos",
            "neg",
            (F.col("_before_pos") + F.col("_in_pos")).alias("pos_before"),
            (F.col("_before_neg") + F.col("_in_neg")).alias("neg_before"),
        )
    )


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve: ordered pairs won, ties counting half."""
    steps = _score_steps(df, label, score, by, descending=False)
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.sum("pos") * F.sum("neg")
    return steps.groupBy(*by).agg(F.try_divide(won, pairs).alias("auc"))


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision at each distinct score, weighted by the recall gained there."""
    steps = _score_steps(df, label, score, by, descending=True)
    hits = F.col("pos_before") + F.col("pos")
    shown = hits + F.col("neg_before") + F.col("neg")
    gained = F.sum(F.col("pos") * hits / shown)
    return steps.groupBy(*by).agg(
        F.try_divide(gained, F.sum("pos")).alias("average_precision")
    )


def confusion(
    df: DataFrame, label: str, score: str, threshold: float, by: Sequence[str] = ()
) -> DataFrame:
    """Counts at ``score >= threshold``."""
    real, called = F.col(label) == 1, F.col(score) >= threshold
    return df.groupBy(*by).agg(
        F.count_if(real & called).alias("tp"),
        F.count_if(~real & called).alias("fp"),
        F.count_if(real & ~called).alias("fn"),
        F.count_if(~real & ~called).alias("tn"),
    )


def rates(counts: DataFrame, digits: int = 4) -> DataFrame:
    """Sensitivity, false positive rate and accuracy of confusion counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "positives": tp + fn,
            "negatives": fp + tn,
            "sensitivity": F.round(F.try_divide(tp, tp + fn), digits),
            "fpr": F.round(F.try_divide(fp, fp + tn), digits),
            "accuracy": F.try_divide(tp + tn, tp + fp + fn + tn),
        }
    )


def confident_errors(
    df: DataFrame, key: str, label: str, score: str, n: int = 20
) -> DataFrame:
    """The ``n`` highest scored negatives and the ``n`` lowest scored positives."""
    high = df.where(F.col(label) == 0).orderBy(F.desc(score), key).limit(n)
    low = df.where(F.col(label) == 1).orderBy(F.asc(score), key).limit(n)
    return high.unionByName(low)


def average_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, rank)`` for every distinct value, ties sharing their mean rank."""
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"), F.col(c).cast("double").alias("value")
                    )
                    for c in cols
                ]
            )
        ).alias("p")
    ).select("p.*")
    # Pooled split points: each column's rows spread over at least its share of buckets.
    counts = (
        value_bucket(long, "value")
        .groupBy("column", "_bucket", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    offsets = earlier(
        counts.groupBy("column", "_bucket").agg(F.sum("n").alias("n")), ["n"], ["column"]
    )
    window = (
        Window.partitionBy("column", "_bucket")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("_before_n") + F.coalesce(F.sum("n").over(window), F.lit(0))
    return counts.join(offsets, ["column", "_bucket"]).select(
        "column", "value", (before + (F.col("n") + 1) / 2).alias("rank")
    )


#: A column with at most so many distinct values has its ranks broadcast.
FEW_VALUES = 20_000


def rank_rows(df: DataFrame, cols: Sequence[str], few_values: int = FEW_VALUES) -> DataFrame:
    """``r0``, ``r1``, ...: the rank of every column's value, a row per row.

    A column with few distinct values, however uneven, has its ranks broadcast and moves
    nothing. The others are looked up together: rows are numbered, a (row, column, value) meets
    its rank, a crowded value being split, and one grouped pass packs the ranks of a row. So
    however many columns there are, their values move twice and no row is moved as a whole.
    """
    ranks = cut_lineage(average_ranks(df, cols))
    sizes = {r["column"]: r["n"] for r in ranks.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    many = [k for k, c in enumerate(cols) if sizes.get(c, 0) > few_values]
    few = [k for k in range(len(cols)) if k not in many]
    wide = df.select(*[F.col(c).cast("double").alias(f"v{k}") for k, c in enumerate(cols)])
    if many:
        # written, so that the numbers of the rows hold
        wide = cut_lineage(wide.withColumn("row", F.monotonically_increasing_id()))
    for k in few:
        own = ranks.where(F.col("column") == cols[k]).select(F.col("value").alias(f"v{k}"), F.col("rank").alias(f"r{k}"))
        wide = wide.join(F.broadcast(own), f"v{k}")
    names = [f"r{k}" for k in range(len(cols))]
    if not many:
        return wide.select(*names)
    values = [F.struct(F.lit(cols[k]).alias("column"), F.col(f"v{k}").alias("value")) for k in many]
    long = wide.select("row", F.explode(F.array(*values)).alias("p")).select("row", "p.*")
    found = long.join(ranks, ["column", "value"]).select(
        "row", "column", "rank", F.lit(None).cast("array<double>").alias("rest")
    )
    rest = wide.select(
        "row", F.lit(None).cast("string").alias("column"), F.lit(None).cast("double").alias("rank"),
        F.array(*[F.col(f"r{k}") for k in few]).cast("array<double>").alias("rest"),
    )
    packed = found.unionByName(rest).groupBy("row").agg(
        F.max("rest").alias("rest"), *[F.max(F.when(F.col("column") == cols[k], F.col("rank"))).alias(f"r{k}") for k in many]
    )
    return packed.select(*[F.get("rest", F.lit(few.index(k))).alias(f"r{k}") if k in few else f"r{k}" for k in range(len(cols))])


def spearman(df: DataFrame, cols: Sequence[str], few_values: int = FEW_VALUES) -> DataFrame:
    """Rank correlation of every column pair, long form ``(a, b, rho)``.

    Columns may hold no nulls. A constant column correlates to NaN. See ``rank_rows``.
    """
    wide = rank_rows(df, cols, few_values)
    vectors = VectorAssembler(inputCols=wide.columns, outputCol="ranks").transform(wide)
    matrix = Correlation.corr(vectors.select("ranks"), "ranks", "pearson").first()[0].toArray()
    pairs = [
        (a, b, float(matrix[i][j])) for i, a in enumerate(cols) for j, b in enumerate(cols)
    ]
    return df.sparkSession.createDataFrame(pairs, "a string, b string, rho double")


def correlated_pairs(matrix: DataFrame, threshold: float) -> DataFrame:
    """Column pairs, each once, whose correlation reaches the threshold either way."""
    return matrix.where((F.col("a") < F.col("b")) & (F.abs("rho") >= threshold))
