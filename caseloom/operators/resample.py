"""Neighbour-based class rebalancing over ``(key, label, point)`` rows.

``label`` is 1 for the rare class and ``point`` is an array of doubles. Every sampler
returns rows of the same three columns.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool
from threading import Lock

import numpy as np
import pandas as pd
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from caseloom.operators.logistic import fit_many, scores_of
from caseloom.operators.metrics import average_precision, confusion, rates, roc_auc
from caseloom.operators.neighbors import distances_to, knn, matrix
from caseloom.operators.prep import class_counts, copy_numbers, downsample, oversample_random
from caseloom.operators.prep import stratified_folds, with_copies
from caseloom.operators.quantiles import exact_quantiles
from caseloom.operators.ranking import key_fraction, random_sample, top_rows
from caseloom.session import cut_lineage

# Tasks get these functions by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 37
RADIAL, LINEAR = "radial", "linear"
# Fixed bounds: rows a radial kernel is measured against, and rows replayed in one task.
LANDMARKS = 200
REPLAYED = 5_000


def _rare(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label) == 1)


def _common(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label) == 0)


def _draw(key: str, copy: str, seed: int, what: str) -> Column:
    """A number in [0, 1) that belongs to one copy of one row."""
    return key_fraction(F.concat_ws("|", F.col(key).cast("string"), F.col(copy), F.lit(what)), seed)


# --- Oversampling -----------------------------------------------------------


def interpolate(
    seeds: DataFrame, pool: DataFrame, key: str, label: str, point: str, k: int, seed: int,
    end: str | None = None,
) -> DataFrame:
    """New rare rows on the lines from each seed row to its neighbours in ``pool``.

    ``seeds`` carries ``_copies``, the number of new rows per seed row.
    """
    return between(seeds, pool, knn(seeds, pool, k, key, point, label), key, label, point, seed, end)


def between(
    seeds: DataFrame, pool: DataFrame, hits: DataFrame, key: str, label: str, point: str, seed: int,
    end: str | None = None,
) -> DataFrame:
    """New rare rows between each seed row and those of the neighbours listed in ``hits``.

    A seed with a ``_reach`` takes steps up to that share of the way; a negative one leads away
    from the neighbour. ``end`` names a column for the neighbour's id, as text, if it is wanted.
    """
    reach = F.col("_reach") if "_reach" in seeds.columns else F.lit(1.0)
    choice = hits.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("rank", "neighbor"))).alias("hits")
    )
    needed = seeds.select(key, point, "_copies", reach.alias("_reach"))
    copies = with_copies(needed, key, "_copy").drop("_copies")
    at = F.floor(_draw(key, "_copy", seed, "neighbor") * F.size("hits")).cast("int")
    aimed = copies.join(choice, key).withColumn("_neighbor", F.get("hits", at)["neighbor"])
    ends = pool.select(F.col(key).alias("_neighbor"), F.col(point).alias("_end"))
    step = _draw(key, "_copy", seed, "step")
    placed = aimed.join(ends, "_neighbor").withColumn("_step", F.col("_reach") * step)
    fresh = F.zip_with(point, "_end", lambda a, b: a + F.col("_step") * (b - a))
    named = [F.col("_neighbor").cast("string").alias(end)] if end else []
    return placed.select(
        new_key(key, "_copy").alias(key), F.lit(1).alias(label), fresh.alias(point), *named
    )


def new_key(key: str, copy: str) -> Column:
    """The id of a made row: its seed's id as text, a tilde and the number of the copy."""
    return F.concat(F.col(key).cast("string"), F.lit("~"), F.col(copy).cast("string"))


def with_text_keys(rows: DataFrame, key: str) -> DataFrame:
    """Ids as text, so that they can stand next to those of made rows.

    An original id that looks like that of a made row is an error.
    """
    if rows.schema[key].dataType.simpleString() != "string":
        return rows.withColumn(key, F.col(key).cast("string"))
    if not rows.where(F.col(key).rlike("~[0-9]+$")).isEmpty():
        raise ValueError(f"{key} holds ids that end in a tilde and a number")
    return rows


def _grown(rows: DataFrame, made: DataFrame, key: str) -> DataFrame:
    """The original rows and the made ones."""
    return with_text_keys(rows, key).unionByName(made, allowMissingColumns=True)


def _as_they_are(rows: DataFrame, key: str, end: str | None) -> DataFrame:
    """The original rows where none are made."""
    kept = with_text_keys(rows, key)
    return kept.withColumn(end, F.lit(None).cast("string")) if end else kept


def _parts(df: DataFrame, key: str, label: str, point: str) -> tuple[DataFrame, int, int]:
    rows = df.select(
        key, F.col(label).cast("int").alias(label), F.col(point).cast("array<double>").alias(point)
    )
    zeros, ones = class_counts(rows, label)
    return rows, zeros, ones


def smote(
    df: DataFrame, key: str, label: str, point: str, k: int = 5, seed: int = SEED
) -> DataFrame:
    """New rare rows between rare neighbours until both classes are the same size."""
    rows, zeros, ones = _parts(df, key, label, point)
    if ones < 2 or zeros <= ones:
        return with_text_keys(rows, key)
    rare = _rare(rows, label)
    seeds = copy_numbers(rare, key, zeros - ones, ones, seed)
    return _grown(rows, interpolate(seeds, rare, key, label, point, k, seed), key)


def adasyn(
    df: DataFrame, key: str, label: str, point: str, k: int = 5, seed: int = SEED
) -> DataFrame:
    """As SMOTE, with more copies where more of the neighbours are common."""
    rows, zeros, ones = _parts(df, key, label, point)
    if ones < 2 or zeros <= ones:
        return with_text_keys(rows, key)
    rare = _rare(rows, label)
    hard = cut_lineage(
        knn(rare, rows, k, key, point, label)
        .groupBy(key)
        .agg(F.avg(1 - F.col("neighbor_label")).alias("_hard"))
    )
    total = hard.agg(F.sum("_hard")).first()[0]
    if not total:
        return with_text_keys(rows, key)
    share = F.col("_hard") / F.lit(total) * F.lit(zeros - ones)
    seeds = rare.join(hard, key).withColumn("_copies", F.rint(share).cast("int"))
    return _grown(rows, interpolate(seeds, rare, key, label, point, k, seed), key)


def _from_seeds(
    rows: DataFrame, seeds: DataFrame, key: str, label: str, point: str, extra: int, k: int,
    seed: int, end: str | None = None,
) -> DataFrame:
    """``extra`` new rows shared out over the seed rows."""
    seeds = cut_lineage(seeds)
    count = seeds.count()
    if not count:
        return _as_they_are(rows, key, end)
    numbered = copy_numbers(seeds, key, extra, count, seed)
    made = interpolate(numbered, _rare(rows, label), key, label, point, k, seed, end)
    return _grown(rows, made, key)


def borderline_smote(
    df: DataFrame, key: str, label: str, point: str, k: int = 5, m: int = 10, seed: int = SEED
) -> DataFrame:
    """SMOTE from rare rows with at least half, but not all, of ``m`` neighbours common."""
    rows, zeros, ones = _parts(df, key, label, point)
    if ones < 2 or zeros <= ones:
        return with_text_keys(rows, key)
    around = knn(_rare(rows, label), rows, m, key, point, label).groupBy(key).agg(
        F.count_if(F.col("neighbor_label") == 0).alias("_common")
    )
    border = around.where((F.col("_common") >= m / 2) & (F.col("_common") < m)).select(key)
    seeds = _rare(rows, label).join(border, key, "left_semi")
    return _from_seeds(rows, seeds, key, label, point, zeros - ones, k, seed)


def radial_features(
    rows: DataFrame, key: str, point: str, into: str, landmarks: int = LANDMARKS, seed: int = SEED
) -> DataFrame:
    """The rows with a vector ``into`` whose inner products stand for a radial kernel.

    The kernel is ``exp(-g * distance^2)`` with ``g`` one over the number of coordinates times
    the variance of all of them. It is measured against at most ``landmarks`` rows, drawn by a
    hash of the id, and divided by the root of the kernel among those (the method of Nystroem),
    so it is exact where all rows are landmarks. Every row is mapped where it lies.
    """
    square = F.aggregate(point, F.lit(0.0), lambda acc, x: acc + x * x)
    total = F.aggregate(point, F.lit(0.0), lambda acc, x: acc + x)
    facts = rows.agg(
        F.sum(total).alias("total"), F.sum(square).alias("square"), F.sum(F.size(point)).alias("n"),
        F.max(F.size(point)).alias("width"),
    ).first()
    spread = facts.square / facts.n - (facts.total / facts.n) ** 2
    g = 1.0 / (facts.width * spread) if spread > 0 else 1.0
    drawn = random_sample(rows, key, landmarks, seed).orderBy(key).select(point).toPandas()
    marks = matrix(drawn[point])
    values, vectors = np.linalg.eigh(np.exp(-g * distances_to(marks, marks) ** 2))
    held = values > 1e-10 * values.max()
    root = vectors[:, held] / np.sqrt(values[held])
    shared = rows.sparkSession.sparkContext.broadcast((marks, root))

    def place(batches):
        for batch in batches:
            if len(batch):
                marks, root = shared.value
                near = np.exp(-g * distances_to(matrix(batch[point]), marks) ** 2) @ root
                yield batch.assign(**{into: list(near)})

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = rows.mapInPandas(place, f"{kinds}, `{into}` array<double>")
    return placed.withColumn(into, array_to_vector(into))


def support_rows(
    rows: DataFrame, key: str, label: str, point: str, kernel: str = RADIAL, seed: int = SEED
) -> DataFrame:
    """The rare rows on or inside the margin of a separator, radial or linear."""
    if kernel not in (RADIAL, LINEAR):
        raise ValueError(f"kernel is {RADIAL} or {LINEAR}, not {kernel}")
    if kernel == LINEAR:
        vectors = rows.withColumn("_v", array_to_vector(point))
        separator = LinearSVC(featuresCol="_v", labelCol=label, maxIter=50)
    else:
        vectors = cut_lineage(radial_features(rows, key, point, "_v", seed=seed))
        # A penalty of 1 on each row outside its margin, as a mean over the rows.
        separator = LinearSVC(
            featuresCol="_v", labelCol=label, maxIter=100, regParam=1.0 / vectors.count(), standardization=False
        )
    scored = separator.fit(vectors).transform(_rare(vectors, label))
    return scored.where(vector_to_array("rawPrediction")[1] <= 1 + 1e-3).select(key, label, point)


def svm_smote(
    df: DataFrame, key: str, label: str, point: str, k: int = 5, m: int = 10, seed: int = SEED,
    end: str | None = None, kernel: str = RADIAL, outward: float = 0.5,
) -> DataFrame:
    """SMOTE from the rare rows a separator leaves on or inside its margin.

    The ``m`` nearest rows of a seed tell what becomes of it: where all are common it is noise
    and left out; where at least half are, new rows lie between it and its rare neighbours;
    else it is safe and they lie beyond it, by up to ``outward`` of the way to the neighbour.
    ``end`` names a further column for the id of the neighbour a new row was drawn along.
    """
    rows, zeros, ones = _parts(df, key, label, point)
    if ones < 2 or zeros <= ones:
        return _as_they_are(rows, key, end)
    seeds = cut_lineage(support_rows(rows, key, label, point, kernel, seed))
    around = knn(seeds, rows, m, key, point, label).groupBy(key).agg(
        F.count_if(F.col("neighbor_label") == 0).alias("_common"), F.count(F.lit(1)).alias("_all")
    )
    danger = F.col("_common") * 2 >= F.col("_all")
    placed = seeds.join(around.where(F.col("_common") < F.col("_all")), key).withColumn(
        "_reach", F.when(danger, F.lit(1.0)).otherwise(F.lit(-outward))
    )
    return _from_seeds(rows, placed.drop("_common", "_all"), key, label, point, zeros - ones, k, seed, end)


def kmeans_smote(
    df: DataFrame, key: str, label: str, point: str, clusters: int = 5, k: int = 5,
    seed: int = SEED, end: str | None = None,
) -> DataFrame:
    """SMOTE inside the clusters whose rare share is at least the overall one.

    Sparser clusters receive more of the new rows: a cluster weighs its typical distance
    between two rare rows (the root of the mean square, from sums alone), raised to a power
    that grows with its size, over its number of rare rows. One search finds the neighbours
    of all clusters: a coordinate more than any distance sets clusters apart.
    ``end`` names a further column for the id of the neighbour a new row was drawn towards.
    """
    rows, zeros, ones = _parts(df, key, label, point)
    if ones < 2 or zeros <= ones:
        return _as_they_are(rows, key, end)
    vectors = rows.withColumn("_v", array_to_vector(point))
    model = KMeans(k=clusters, featuresCol="_v", predictionCol="_cluster", seed=seed).fit(vectors)
    placed = cut_lineage(model.transform(vectors).select(key, label, point, "_cluster"))
    square = F.aggregate(point, F.lit(0.0), lambda acc, x: acc + x * x)
    width = rows.agg(F.max(F.size(point))).first()[0]
    only = F.when(F.col(label) == 1, F.lit(1))
    sums = [F.sum(only * F.get(point, F.lit(i))).alias(f"s{i}") for i in range(width)]
    facts = placed.groupBy("_cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("rare"), F.sum(only * square).alias("square"), *sums
    )
    weights = {}
    for r in facts.collect():
        if r.rare > 1 and r.rare / r.n >= ones / (zeros + ones):
            mean = sum(r[f"s{i}"] ** 2 for i in range(width)) / r.rare
            apart = math.sqrt(max(0.0, 2 * (r.square - mean) / (r.rare - 1)))
            power = math.log(r.rare, 1.6) ** 1.8 * 0.16
            weights[r["_cluster"]] = r.rare, apart**power / r.rare
    if not weights:
        return _as_they_are(rows, key, end)
    pool = _rare(placed, label).where(F.col("_cluster").isin(list(weights)))
    total, left, numbered = sum(w for _, w in weights.values()), zeros - ones, []
    for i, (cluster, (size, weight)) in enumerate(weights.items()):
        share = weight / total if total else 1 / len(weights)
        extra = left if i == len(weights) - 1 else min(left, round((zeros - ones) * share))
        left -= extra
        numbered.append(copy_numbers(pool.where(F.col("_cluster") == cluster), key, extra, size, seed))
    seeds = cut_lineage(reduce(DataFrame.unionByName, numbered))
    far = 4 * math.sqrt(rows.agg(F.max(square)).first()[0] or 0.0) + 1
    set_apart = F.concat(F.col(point), F.array(F.col("_cluster") * F.lit(far)))
    apart = pool.withColumn(point, set_apart)
    hits = knn(apart, apart, k, key, point, "_cluster")
    own = hits.join(pool.select(key, "_cluster"), key).where(F.col("neighbor_label") == F.col("_cluster"))
    made = between(seeds, pool, own.drop("_cluster"), key, label, point, seed, end)
    return _grown(rows, made, key)


def random_over(df: DataFrame, key: str, label: str, point: str, seed: int = SEED) -> DataFrame:
    rows, _, _ = _parts(df, key, label, point)
    repeated = oversample_random(rows, key, label, seed)
    with_text_keys(rows, key)
    own = F.when(F.col("copy") == 0, F.col(key).cast("string")).otherwise(new_key(key, "copy"))
    return repeated.select(own.alias(key), label, point)


# --- Undersampling ----------------------------------------------------------


def random_under(df: DataFrame, key: str, label: str, point: str, seed: int = SEED) -> DataFrame:
    rows, _, _ = _parts(df, key, label, point)
    return downsample(rows, key, label, seed)


def near_miss_distances(
    df: DataFrame, key: str, label: str, point: str, version: int, n: int = 3
) -> DataFrame:
    """Candidate common rows with their mean distance to rare rows."""
    rare, common = _rare(df, label), _common(df, label)
    if version == 3:
        near = knn(rare, common, n, key, point, label).select(F.col("neighbor").alias(key))
        common = common.join(near.distinct(), key, "left_semi")
    hits = knn(common, rare, n, key, point, label, farthest=version == 2)
    return hits.groupBy(key).agg(F.avg("distance").alias("mean_distance"))


def near_miss(
    df: DataFrame, key: str, label: str, point: str, version: int = 1, n: int = 3
) -> DataFrame:
    """As many common rows as rare ones, chosen by distance to the rare class.

    1: closest to their nearest rare rows; 2: closest to their farthest rare rows;
    3: among the rare rows' nearest common rows, those farthest from the rare class.
    """
    rows, _, ones = _parts(df, key, label, point)
    # Two numbers per row, read again for each step of the choice.
    scored = cut_lineage(near_miss_distances(rows, key, label, point, version, n))
    kept = top_rows(scored, "mean_distance", key, ones, descending=version == 3)
    return _rare(rows, label).unionByName(
        _common(rows, label).join(kept.select(key), key, "left_semi")
    )


def disagreeing(
    df: DataFrame, key: str, label: str, point: str, k: int = 3, hits: DataFrame | None = None
) -> DataFrame:
    """Keys of common rows with a rare row among their ``k`` nearest, which are ``hits`` if given."""
    hits = knn(_common(df, label), df, k, key, point, label) if hits is None else hits
    return hits.where(F.col("neighbor_label") != 0).select(key).distinct()


def edited_nn(
    df: DataFrame, key: str, label: str, point: str, k: int = 3, hits: DataFrame | None = None
) -> DataFrame:
    rows, _, _ = _parts(df, key, label, point)
    return rows.join(disagreeing(rows, key, label, point, k, hits), key, "left_anti")


def repeated_edited_nn(
    df: DataFrame, key: str, label: str, point: str, k: int = 3, rounds: int | None = None,
    searched: list[int] | None = None, hits: DataFrame | None = None,
) -> DataFrame:
    """Edited neighbours until a round removes nothing; each round before removes a row.

    The neighbours of every common row are looked up once and kept. A removed row can change
    only the judgement of rows that have it among their neighbours: those alone are searched
    again, a number that falls from round to round. ``searched``, if given, is told how many
    rows each round looked up. ``rounds`` ends it earlier. ``hits`` are the neighbours of the common
    rows, where they are known.
    """
    rows, zeros, ones = _parts(df, key, label, point)
    wanted = _common(rows, label)
    lists = None
    done = 0
    while rounds is None or done < rounds:
        if searched is not None:
            searched.append(wanted.count())
        if hits is None or done:
            found = cut_lineage(knn(wanted, rows, k, key, point, label).select(key, "neighbor", "neighbor_label"))
        else:
            found = hits.select(key, "neighbor", "neighbor_label")
        kept = found if lists is None else cut_lineage(lists.join(wanted.select(key), key, "left_anti").unionByName(found))
        gone = cut_lineage(kept.where(F.col("neighbor_label") != 0).select(key).distinct())
        removed = gone.count()
        if not removed:
            break
        if zeros - removed < ones:
            # Another round would make the common class the smaller one.
            return rows
        rows = cut_lineage(rows.join(gone, key, "left_anti"))
        zeros, done = zeros - removed, done + 1
        # lists of rows that are left; those that name a removed row are out of date
        lists = kept.join(gone, key, "left_anti")
        stale = lists.join(gone.withColumnRenamed(key, "neighbor"), "neighbor", "left_semi").select(key).distinct()
        wanted = cut_lineage(rows.join(stale, key, "left_semi"))
    return rows


def tomek_links(
    df: DataFrame, key: str, label: str, point: str, hits: DataFrame | None = None
) -> DataFrame:
    """``(common, rare)`` key pairs that are each other's nearest row.

    Only rare rows, and the common rows nearest to them, are looked up. ``hits`` are the neighbours
    of all rows, whose keys do not repeat, where they are known.
    """
    if hits is not None:
        nearest = hits.where(F.col("rank") == 1)
        named = nearest.where(F.col("neighbor_label") == 0).join(_rare(df, label).select(key), key, "left_semi")
        back = nearest.select(F.col(key).alias("common"), F.col("neighbor").alias("rare"))
        return named.select(F.col("neighbor").alias("common"), F.col(key).alias("rare")).join(
            back, ["common", "rare"], "left_semi"
        )
    near_rare = knn(_rare(df, label), df, 1, key, point, label)
    named = cut_lineage(
        near_rare.where(F.col("neighbor_label") == 0).select(
            F.col("neighbor").alias("common"), F.col(key).alias("rare")
        )
    )
    candidates = df.join(named.select(F.col("common").alias(key)).distinct(), key, "left_semi")
    back = knn(candidates, df, 1, key, point, label).select(
        F.col(key).alias("common"), F.col("neighbor").alias("rare")
    )
    return named.join(back, ["common", "rare"], "left_semi")


def drop_tomek_links(
    df: DataFrame, key: str, label: str, point: str, both: bool = False, hits: DataFrame | None = None
) -> DataFrame:
    """Without the common member of every Tomek link, or without both members."""
    rows, _, _ = _parts(df, key, label, point)
    links = tomek_links(rows, key, label, point, hits)
    members = F.array("common", "rare") if both else F.array("common")
    gone = links.select(F.explode(members).alias(key))
    return rows.join(gone, key, "left_anti")


def one_sided_selection(
    df: DataFrame, key: str, label: str, point: str, seed: int = SEED
) -> DataFrame:
    """Rare rows, one common row and every common row those misjudge; then Tomek links."""
    rows, _, _ = _parts(df, key, label, point)
    first = random_sample(_common(rows, label), key, 1, seed)
    store = _rare(rows, label).unionByName(first.select(*rows.columns))
    rest = _common(rows, label).join(first.select(key), key, "left_anti")
    missed = knn(rest, store, 1, key, point, label).where(F.col("neighbor_label") == 1)
    kept = store.unionByName(rest.join(missed.select(key), key, "left_semi"))
    return drop_tomek_links(cut_lineage(kept), key, label, point)


def condensed_nn(
    df: DataFrame, key: str, label: str, point: str, seed: int = SEED, rounds: int | None = None
) -> DataFrame:
    """Rare rows plus common rows until the store judges every common row rightly.

    Every round but the last adds a row, so it ends; ``rounds`` ends it earlier.

    All rows misjudged in a round join together, where ``condensed_nn_in_order`` adds them
    one at a time; the store may come out larger.
    """
    rows, _, _ = _parts(df, key, label, point)
    first = random_sample(_common(rows, label), key, 1, seed)
    store = cut_lineage(_rare(rows, label).unionByName(first.select(*rows.columns)))
    done = 0
    while rounds is None or done < rounds:
        done += 1
        rest = _common(rows, label).join(store.select(key), key, "left_anti")
        missed = knn(rest, store, 1, key, point, label).where(F.col("neighbor_label") == 1)
        added = cut_lineage(rest.join(missed.select(key), key, "left_semi"))
        if added.isEmpty():
            break
        store = cut_lineage(store.unionByName(added))
    return store


def _replayed(head: DataFrame, key: str, point: str) -> DataFrame:
    """The rows of ``head``, a bounded number, that the row-by-row rule admits."""

    def replay(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values(key, kind="stable").reset_index(drop=True)
        ids, against = some[key].to_numpy(), some["_against"].to_numpy()
        points, limit = matrix(some[point]), some["_distance"].to_numpy()
        judged = np.zeros(len(some), dtype=bool)
        admitted = []
        for i in range(len(some)):
            if not judged[i]:
                admitted.append(i)
                gap = points - points[i]
                distance = np.sqrt(np.einsum("ij,ij->i", gap, gap))
                judged |= (distance < limit) | (distance == limit) & (ids[i] < against)
        return some.iloc[admitted]

    return head.groupBy(F.lit("all")).applyInPandas(replay, head.schema)


def condensed_nn_in_order(
    df: DataFrame, key: str, label: str, point: str, seed: int = SEED, block: int = REPLAYED
) -> DataFrame:
    """Rare rows plus the common rows that join when rows are judged one at a time, by id.

    The store begins with the rare rows and one common row. A common row joins if its nearest
    row of the store, as it is at its turn, is rare. Common rows that join can only put others
    right, so a row judged rightly once is done with, and a misjudged one needs no more than
    the distance and id of its nearest rare row. A round replays the next ``block`` misjudged
    rows in one task, then judges all rows behind them against those that joined. It ends with
    the misjudged rows: after one round for each ``block`` rows that join or less are put right.

    Rows without an id or a point join nothing, as in every search.
    """
    rows, _, _ = _parts(df, key, label, point)
    first = random_sample(_common(rows, label), key, 1, seed)
    store = cut_lineage(_rare(rows, label).unionByName(first.select(*rows.columns)))
    rest = _common(rows, label).join(store.select(key), key, "left_anti")
    near = knn(rest, store, 1, key, point, label).where(F.col("neighbor_label") == 1)
    limits = near.select(key, F.col("distance").alias("_distance"), F.col("neighbor").alias("_against"))
    misjudged = cut_lineage(rest.join(limits, key))
    while True:
        head = cut_lineage(misjudged.orderBy(key).limit(block))
        last = head.agg(F.max(key)).first()[0]
        if last is None:
            return store
        joined = cut_lineage(_replayed(head, key, point).select(*rows.columns))
        store = store.unionByName(joined)
        behind = misjudged.where(F.col(key) > F.lit(last))
        nearest = knn(behind, joined, 1, key, point).select(key, "distance", "neighbor")
        closer = (F.col("distance") < F.col("_distance")) | (
            (F.col("distance") == F.col("_distance")) & (F.col("neighbor") < F.col("_against"))
        )
        right = behind.join(nearest, key).where(closer).select(key)
        misjudged = cut_lineage(behind.join(right, key, "left_anti"))


def neighbourhood_cleaning(
    df: DataFrame, key: str, label: str, point: str, k: int = 3, hits: DataFrame | None = None
) -> DataFrame:
    """Edited neighbours, and the common rows that outvote a rare row."""
    rows, _, _ = _parts(df, key, label, point)
    noisy = disagreeing(rows, key, label, point, k, hits)
    around = knn(_rare(rows, label), rows, k, key, point, label)
    votes = around.groupBy(key).agg(
        F.avg(F.col("neighbor_label").cast("double")).alias("rare_share"),
        F.collect_list(F.when(F.col("neighbor_label") == 0, F.col("neighbor"))).alias("common"),
    )
    outvoting = votes.where(F.col("rare_share") < 0.5).select(F.explode("common").alias(key))
    return rows.join(noisy.unionByName(outvoting), key, "left_anti")


def instance_easiness(
    rows: DataFrame, key: str, label: str, point: str, folds: int = 5, seed: int = SEED
) -> DataFrame:
    """``_easy`` of every common row: P(common) by a model that never saw it."""
    dealt = cut_lineage(stratified_folds(rows, key, label, folds, seed)).withColumn(
        "_v", array_to_vector(point)
    )
    scored = []
    for fold in range(folds):
        fitted = LogisticRegression(featuresCol="_v", labelCol=label).fit(
            dealt.where(F.col("fold") != fold)
        )
        judged = fitted.transform(_common(dealt.where(F.col("fold") == fold), label))
        scored.append(judged.select(key, vector_to_array("probability")[0].alias("_easy")))
    return reduce(DataFrame.unionByName, scored)


def instance_hardness(
    df: DataFrame, key: str, label: str, point: str, folds: int = 5, seed: int = SEED
) -> DataFrame:
    """The common rows that models which never saw them find easiest."""
    rows, zeros, ones = _parts(df, key, label, point)
    if zeros <= ones:
        return rows
    easy = cut_lineage(instance_easiness(rows, key, label, point, folds, seed))
    threshold = exact_quantiles(easy, ["_easy"], [1 - ones / zeros])["_easy"][0]
    kept = easy.where(F.col("_easy") >= threshold).select(key)
    return _rare(rows, label).unionByName(_common(rows, label).join(kept, key, "left_semi"))


# --- Combinations and comparison --------------------------------------------


def smote_enn(
    df: DataFrame, key: str, label: str, point: str, seed: int = SEED, grown: DataFrame | None = None,
    hits: DataFrame | None = None,
) -> DataFrame:
    """SMOTE, then drop every row, of either class, that its neighbours contradict. ``grown`` is what
    SMOTE gave and ``hits`` the neighbours in it, where they are known."""
    grown = cut_lineage(smote(df, key, label, point, seed=seed)) if grown is None else grown
    hits = knn(grown, grown, 3, key, point, label) if hits is None else hits
    against = hits.join(grown.select(key, F.col(label).alias("_own")), key)
    wrong = against.where(F.col("neighbor_label") != F.col("_own")).select(key)
    return grown.join(wrong, key, "left_anti")


def smote_tomek(
    df: DataFrame, key: str, label: str, point: str, seed: int = SEED, grown: DataFrame | None = None,
    hits: DataFrame | None = None,
) -> DataFrame:
    grown = cut_lineage(smote(df, key, label, point, seed=seed)) if grown is None else grown
    return drop_tomek_links(grown, key, label, point, both=True, hits=hits)


class Begun:
    """What several samplers of one training set begin with, worked out once, when first asked for:
    the neighbours of its common rows, SMOTE's rows and the neighbours among those."""

    def __init__(self, train: DataFrame, key: str, label: str, point: str, chosen: Mapping[str, Sampler]) -> None:
        self.train, self.columns, self.key = train, (key, label, point), key
        self.own = {name for name, sampler in chosen.items() if SAMPLERS.get(name) is sampler}
        self.known: dict[str, DataFrame | None] = {}
        self.locks = {name: Lock() for name in ("around", "grown", "among")}

    def _once(self, name: str, make: Callable[[], DataFrame | None]) -> DataFrame | None:
        with self.locks[name]:
            if name not in self.known:
                self.known[name] = make()
            return self.known[name]

    def around(self) -> DataFrame:
        """The three rows nearest to each common row."""
        key, label, point = self.columns
        rows, _, _ = _parts(self.train, *self.columns)
        near = lambda: knn(_common(rows, label), rows, 3, key, point, label)
        return self._once("around", lambda: cut_lineage(near().select(key, "neighbor", "neighbor_label")))

    def grown(self) -> DataFrame:
        return self._once("grown", lambda: cut_lineage(smote(self.train, *self.columns)))

    def among(self) -> DataFrame | None:
        """The three grown rows nearest to each; none where keys repeat, so that a nearest row
        is not the first of three."""
        key, label, point = self.columns

        def make() -> DataFrame | None:
            grown = self.grown()
            if not grown.groupBy(key).count().where("count > 1").isEmpty():
                return None
            hits = knn(grown, grown, 3, key, point, label)
            return cut_lineage(hits.select(key, "neighbor", "neighbor_label", "rank"))

        return self._once("among", make)

    def sampled(self, name: str, sampler: Sampler) -> DataFrame:
        """What the sampler gives for the training set."""
        if name in self.own:
            if name in ("edited_nn", "repeated_edited_nn", "neighbourhood_cleaning"):
                return sampler(self.train, *self.columns, hits=self.around())
            if name == "smote":
                return self.grown()
            if name in ("smote_enn", "smote_tomek"):
                hits = self.among() if self.own >= {"smote_enn", "smote_tomek"} else None
                return sampler(self.train, *self.columns, grown=self.grown(), hits=hits)
        return sampler(self.train, *self.columns)


Sampler = Callable[[DataFrame, str, str, str], DataFrame]

SAMPLERS: dict[str, Sampler] = {
    "none": lambda df, key, label, point: df.select(key, label, point),
    "random_over": random_over,
    "smote": smote,
    "adasyn": adasyn,
    "borderline_smote": borderline_smote,
    "svm_smote": svm_smote,
    "kmeans_smote": kmeans_smote,
    "random_under": random_under,
    "near_miss_1": lambda df, *c: near_miss(df, *c, version=1),
    "near_miss_2": lambda df, *c: near_miss(df, *c, version=2),
    "near_miss_3": lambda df, *c: near_miss(df, *c, version=3),
    "edited_nn": edited_nn,
    "repeated_edited_nn": repeated_edited_nn,
    "condensed_nn": condensed_nn,
    "condensed_nn_in_order": condensed_nn_in_order,
    "one_sided_selection": one_sided_selection,
    "neighbourhood_cleaning": neighbourhood_cleaning,
    "instance_hardness": instance_hardness,
    "smote_enn": smote_enn,
    "smote_tomek": smote_tomek,
}


def resample_counts(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Class sizes before and after."""

    def counts(df: DataFrame, stage: str) -> DataFrame:
        return df.groupBy(F.col(label).cast("int").alias(label)).agg(
            F.count(F.lit(1)).alias("n")
        ).select(F.lit(stage).alias("stage"), label, "n")

    return counts(before, "before").unionByName(counts(after, "after"))


def _forest(label: str) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="_v", labelCol=label, seed=42, maxDepth=5, numTrees=50, featureSubsetStrategy="log2"
    )


#: Penalty of the study's logistic models.
STRENGTH = 1e-3

#: Model kinds of the study: an estimator for a label column, or none for the kind whose models
#: are fitted together.
STUDY_MODELS: dict[str, Callable | None] = {"logistic": None, "forest": _forest}


def resampling_study(
    df: DataFrame,
    key: str,
    label: str,
    point: str,
    samplers: Sequence[str] | Mapping[str, Sampler] = tuple(SAMPLERS),
    folds: int = 10,
    seed: int = SEED,
    threshold: float = 0.5,
    models: Sequence[str] = tuple(STUDY_MODELS),
    parallelism: int = 4,
) -> DataFrame:
    """Held-out metrics per sampler, model and fold, with the class sizes that training saw
    before and after; only training folds are resampled, once for all models. What samplers of a
    fold begin with alike is worked out once.

    Up to ``parallelism`` parts are sampled at a time, as in Spark's own cross validation. The
    logistic models of all parts are fitted together, a job a step for all of them."""
    chosen = samplers if isinstance(samplers, Mapping) else {s: SAMPLERS[s] for s in samplers}
    spark = df.sparkSession
    rows, _, _ = _parts(df, key, label, point)
    dealt = cut_lineage(stratified_folds(rows, key, label, folds, seed))
    parts = [(name, fold) for fold in range(folds) for name in chosen]
    begun = [
        Begun(dealt.where(F.col("fold") != fold).drop("fold"), key, label, point, chosen) for fold in range(folds)
    ]

    def sample(part: tuple[str, int]) -> DataFrame:
        name, fold = part
        return cut_lineage(begun[fold].sampled(name, chosen[name]).select(label, point))

    with ThreadPool(parallelism) as pool:
        grown = pool.map(inheritable_thread_target(spark)(sample), parts)
        numbered = [g.withColumn("_part", F.lit(i)) for i, g in enumerate(grown)]
        together = cut_lineage(reduce(DataFrame.unionByName, numbered).hint("rebalance"))
        scored = []
        if "logistic" in models:
            fitted = fit_many(together, "_part", label, point, STRENGTH)
            by_fold: dict[int, dict[str, np.ndarray]] = {}
            for i, (name, fold) in enumerate(parts):
                if i in fitted:
                    by_fold.setdefault(fold, {})[name] = fitted[i].weights
            judged = scores_of(dealt.select("fold", label, point), "fold", point, by_fold, "sampler", "score")
            scored.append(judged.withColumn("model", F.lit("logistic")))

        def grow(task: tuple[str, int]) -> DataFrame:
            kind, i = task
            name, fold = parts[i]
            model = STUDY_MODELS[kind](label).fit(grown[i].withColumn("_v", array_to_vector(point)))
            test = dealt.where(F.col("fold") == fold).withColumn("_v", array_to_vector(point))
            chance = vector_to_array("probability")[1].alias("score")
            judged = model.transform(test).select("fold", label, F.lit(name).alias("sampler"), chance)
            return judged.withColumn("model", F.lit(kind))

        others = [(kind, i) for kind in models if STUDY_MODELS[kind] for i in range(len(parts))]
        scored += pool.map(inheritable_thread_target(spark)(grow), others)
    scored = cut_lineage(reduce(DataFrame.unionByName, scored))
    by = ["sampler", "model", "fold"]
    sizes = lambda stage: (
        F.count_if(F.col(label) == 0).alias(f"zeros_{stage}"), F.count_if(F.col(label) == 1).alias(f"ones_{stage}")
    )
    names = spark.createDataFrame([(i, *p) for i, p in enumerate(parts)], "_part int, sampler string, fold int")
    after = together.groupBy("_part").agg(*sizes("after")).join(names, "_part").drop("_part")
    held = dealt.groupBy("fold").agg(*sizes("held"))
    whole = dict(zip(("zeros", "ones"), class_counts(dealt, label)))
    before = held.select("fold", *[(F.lit(n) - F.col(f"{c}_held")).alias(f"{c}_before") for c, n in whole.items()])
    counted = rates(confusion(scored, label, "score", threshold, by))
    return (
        counted.join(roc_auc(scored, label, "score", by), by)
        .join(average_precision(scored, label, "score", by), by)
        .join(before, "fold")
        .join(after, ["sampler", "fold"])
    )


def study_summary(study: DataFrame) -> DataFrame:
    """Mean and standard deviation over the folds, per sampler and model."""
    measured = ("auc", "average_precision", "sensitivity", "fpr", "accuracy")
    return study.groupBy("sampler", "model").agg(
        F.count(F.lit(1)).alias("folds"),
        *[f(c).alias(f"{c}_{n}") for c in measured for f, n in ((F.avg, "mean"), (F.stddev_samp, "std"))],
    )
