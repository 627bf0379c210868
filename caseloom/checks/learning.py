"""Queries over preparation, metrics, neighbours, samplers and models."""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from caseloom.checks import sql
from caseloom.checks.fixtures import base, view, with_views
from caseloom.checks.flows import HELD_OUT, build_master, held_out_facts, tables
from caseloom.checks.registry import query, rounded
from caseloom.checks.rows import scratch
from caseloom.operators import logistic, metrics, models, neighbors, prep, resample
from caseloom.operators.boosting import Booster
from caseloom.operators.ranking import random_sample
from caseloom.plans import features as ft
from caseloom.plans import train as tr
from caseloom.session import cut_lineage
from caseloom.sources import tables as io

# Tasks get these functions by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- Imputing, scaling, splitting -------------------------------------------

GAPPED = """g as (select o_orderkey, case when o_orderstatus = 'F' then null else o_totalprice end
    as price, case when o_orderpriority = '1-URGENT' then null else o_custkey::double end as cust
  from orders)"""


def _gapped(spark: SparkSession, folder: str) -> DataFrame:
    cust = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey").cast("double"))
    return base(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("price"),
        cust.alias("cust"),
    )


@query(
    "median_impute",
    f"""with {GAPPED} select o_orderkey,
          round(coalesce(price, (select median(price) from g)), 6) as price,
          coalesce(cust, (select median(cust) from g)) as cust from g""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(prep.median_impute(_gapped(spark, folder), ["price", "cust"]))


@query(
    "standardise",
    """select l_orderkey, l_linenumber,
         round((l_quantity - (select avg(l_quantity) from lineitem))
               / (select stddev_pop(l_quantity) from lineitem), 9) as l_quantity,
         round((l_discount - (select avg(l_discount) from lineitem))
               / (select stddev_pop(l_discount) from lineitem), 9) as l_discount,
         0.0::double as constant
       from lineitem""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = base(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", F.lit(7.0).alias("constant")
    )
    return rounded(prep.standardise(lines, ["l_quantity", "l_discount", "constant"]), 9)


@query(
    "hash_split",
    f"""select o_orderkey, cast({sql.fraction('o_orderkey', 42)} < 0.33 as int) as held_out
        from orders""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return prep.hash_split(base(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 0.33, 42)


@query(
    "stratified_folds",
    f"""select doc_id, toxic, cast((row_number() over (
          partition by toxic order by {sql.digest('doc_id', 37)}, doc_id) - 1) % 10 as int) as fold
        from labels""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    labels = base(spark, folder, "labels").select("doc_id", "toxic")
    return prep.stratified_folds(labels, "doc_id", "toxic", 10, 37)


def _balanced_sql(n: str) -> str:
    return with_views(
        ["target"],
        f"""select patientid, has_long_covid_diag from target where has_long_covid_diag = 1
            union all (select patientid, has_long_covid_diag from target
              where has_long_covid_diag = 0
              order by {sql.digest('patientid', 123)}, patientid limit {n})""",
    )


@query(
    "downsample_to_minority",
    _balanced_sql("(select count(*) from target where has_long_covid_diag = 1)"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return prep.downsample(view(spark, folder, "target"), ft.KEY, ft.LABEL, 123)


@query("downsample_to_size", _balanced_sql("1000"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return prep.downsample(view(spark, folder, "target"), ft.KEY, ft.LABEL, 123, n=1000)


COPIES = f"""
  c as (select count(*) filter (toxic = 0) as zeros, count(*) filter (toxic = 1) as ones from labels),
  n as (select doc_id, toxic, (select (zeros - ones) // ones from c)
          + cast(row_number() over (order by {sql.digest('doc_id', 37)}, doc_id)
                 <= (select (zeros - ones) % ones from c) as int) as copies
        from labels where toxic = 1)"""


@query(
    "oversample_random",
    f"""with {COPIES}
        select doc_id, toxic, 0 as copy from labels
        union all select doc_id, toxic, cast(unnest(range(1, copies + 1)) as int) from n""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    labels = base(spark, folder, "labels").select("doc_id", "toxic")
    return prep.oversample_random(labels, "doc_id", "toxic", 37)


# --- Metrics ----------------------------------------------------------------

SCORED = "s as (select doc_id, quality as y, n_chars::double as x, lang from labels join documents using (doc_id))"


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    documents = base(spark, folder, "documents").select("doc_id", "n_chars", "lang")
    return base(spark, folder, "labels").join(documents, "doc_id").select(
        "doc_id", F.col("quality").alias("y"), F.col("n_chars").cast("double").alias("x"), "lang"
    )


def _auc_sql(score: str, by: str = "") -> str:
    group = f"{by}," if by else ""
    same = f"partition by {by}" if by else ""
    return f"""with {SCORED},
      r as (select {group} y, rank() over ({same} order by {score})
              + (count(*) over (partition by {group} {score}) - 1) / 2.0 as place from s)
      select {group} round((sum(place) filter (y = 1) - sum(y) * (sum(y) + 1) / 2.0)
              / nullif(sum(y) * (count(*) - sum(y)), 0), 9)::double as auc
      from r {'group by ' + by if by else ''}"""


@query("roc_auc", _auc_sql("x"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.roc_auc(_scored(spark, folder), "y", "x"), 9)


@query("roc_auc_hard_labels", _auc_sql("(x >= 2000)"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    hard = _scored(spark, folder).withColumn("x", (F.col("x") >= 2000).cast("int"))
    return rounded(metrics.roc_auc(hard, "y", "x"), 9)


@query("roc_auc_by_group", _auc_sql("x", "lang"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.roc_auc(_scored(spark, folder), "y", "x", ["lang"]), 9)


@query(
    "average_precision",
    f"""with {SCORED},
        g as (select x, sum(y) as pos, count(*) as n from s group by x),
        c as (select pos, sum(pos) over w as hits, sum(n) over w as shown from g
              window w as (order by x desc))
        select round(sum(pos * hits / shown::double) / (select sum(y) from s), 9)::double
          as average_precision from c""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.average_precision(_scored(spark, folder), "y", "x"), 9)


CONFUSION = f"""with {SCORED}, c as (select lang,
      count(*) filter (y = 1 and x >= 2000) as tp, count(*) filter (y = 0 and x >= 2000) as fp,
      count(*) filter (y = 1 and x < 2000) as fn, count(*) filter (y = 0 and x < 2000) as tn
    from s group by lang)"""


@query("confusion_counts", CONFUSION + " select * from c")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(_scored(spark, folder), "y", "x", 2000, ["lang"])


@query(
    "confusion_rates",
    CONFUSION
    + """ select *, tp + fn as positives, fp + tn as negatives,
            round(tp / nullif(tp + fn, 0)::double, 4) as sensitivity,
            round(fp / nullif(fp + tn, 0)::double, 4) as fpr,
            round((tp + tn) / (tp + fp + fn + tn)::double, 9) as accuracy from c""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    counts = metrics.confusion(_scored(spark, folder), "y", "x", 2000, ["lang"])
    return rounded(metrics.rates(counts), 9)


@query(
    "confident_errors",
    f"""with {SCORED}
        (select * from s where y = 0 order by x desc, doc_id limit 20)
        union all (select * from s where y = 1 order by x, doc_id limit 20)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confident_errors(_scored(spark, folder), "doc_id", "y", "x", 20)


RANKED = ("customer", "price", "month", "priority")
SPEARMAN = (
    """with o as (select o_custkey as customer, o_totalprice as price, month(o_orderdate) as month,
         ascii(o_orderpriority) as priority from orders), r as (select """
    + ", ".join(
        f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0 as {c}"
        for c in RANKED
    )
    + " from o), m as ("
    + " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 9) as rho from r"
        for a in RANKED
        for b in RANKED
    )
    + ")"
)


def _spearman(spark: SparkSession, folder: str) -> DataFrame:
    orders = base(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("price"),
        F.month("o_orderdate").alias("month"),
        F.ascii("o_orderpriority").alias("priority"),
    )
    return metrics.spearman(orders, RANKED)


@query("spearman", SPEARMAN + " select * from m")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_spearman(spark, folder), 9)


@query("correlated_pairs", SPEARMAN + " select * from m where a < b and abs(rho) >= 0.005")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.correlated_pairs(_spearman(spark, folder), 0.005), 9)


@query(
    "enrich_test_set",
    with_views(
        ["target"],
        f"""t as (select *, {sql.fraction('patientid', 42)} < 0.3 as held from target
                  where has_long_covid_diag = 1
                  union all select *, {sql.fraction('patientid', 42)} < 0.3 from (
                    select * from target where has_long_covid_diag = 0
                    order by {sql.digest('patientid', 123)}, patientid
                    limit (select count(*) from target where has_long_covid_diag = 1)))
            select patientid, has_long_covid_diag from t where held
            union all (select patientid, has_long_covid_diag from target
              where has_long_covid_diag = 0 and patientid not in (select patientid from t)
              order by {sql.digest('patientid', 7)}, patientid limit 500)""",
    ).replace("\nt as", ",\nt as"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    target = view(spark, folder, "target")
    train, held = prep.split(prep.downsample(target, ft.KEY, ft.LABEL, 123), ft.KEY, 0.3, 42)
    return prep.enrich_test(held, target, train, ft.KEY, ft.LABEL, 500, 7)


# --- Neighbours and samplers ------------------------------------------------

VECTORS = "e as (select vec_id, embedding::double[] as p, cast(label = 0 as int) as y from embeddings)"
COLUMNS = ("vec_id", "y", "embedding")


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    rare = (F.col("label") == 0).cast("int")
    return base(spark, folder, "embeddings").select("vec_id", rare.alias("y"), "embedding")


def _near(
    name: str, ours: str, theirs: str, k: int, order: str = "asc"
) -> str:
    """A table of each row's ``k`` nearest rows in ``theirs``."""
    return f"""{name} as (select a.vec_id, b.vec_id as nb, b.y as nby, list_distance(a.p, b.p) as d
      from {ours} a join {theirs} b on a.vec_id <> b.vec_id
      qualify row_number() over (
        partition by a.vec_id order by list_distance(a.p, b.p) {order}, b.vec_id) <= {k})"""


PAIR = f"{VECTORS}, rare as (select * from e where y = 1), common as (select * from e where y = 0)"


def _knn_sql(order: str) -> str:
    return f"""with {VECTORS}, {_near('h', 'e', 'e', 5, order)}
        select vec_id, nb as neighbor, nby as neighbor_label, round(d, 9) as distance,
          cast(row_number() over (partition by vec_id order by d {order}, nb) as int) as rank from h"""


@query("nearest_neighbours", _knn_sql("asc"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _vectors(spark, folder)
    return rounded(neighbors.knn(vectors, vectors, 5, "vec_id", "embedding", "y"), 9)


@query("nearest_neighbours_by_cells", _knn_sql("asc"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _vectors(spark, folder)
    hits = neighbors.knn(vectors, vectors, 5, *COLUMNS[::2], "y", broadcast_values=0, narrow=1000)
    return rounded(hits, 9)


@query("nearest_neighbours_by_bounds", _knn_sql("asc"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _vectors(spark, folder)
    hits = neighbors.knn(vectors, vectors, 5, *COLUMNS[::2], "y", broadcast_values=0)
    return rounded(hits, 9)


@query(
    "nearest_neighbours_of_decimal_ids",
    f"""with {VECTORS.replace('select vec_id,', 'select cast(vec_id / 4.0 as decimal(12, 2)) as vec_id,')}, {_near('h', 'e', 'e', 2)}
        select vec_id::varchar as vec_id, nb::varchar as neighbor, round(d, 9) as distance from h""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that differ behind the point alone."""
    quarter = (F.col("vec_id") / 4).cast("decimal(12, 2)")
    vectors = _vectors(spark, folder).withColumn("vec_id", quarter)
    hits = neighbors.knn(vectors, vectors, 2, *COLUMNS[::2], "y")
    found = hits.select(F.col("vec_id").cast("string"), F.col("neighbor").cast("string").alias("neighbor"), "distance")
    return rounded(found, 9)


@query("farthest_neighbours", _knn_sql("desc"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _vectors(spark, folder)
    hits = neighbors.knn(vectors, vectors, 5, "vec_id", "embedding", "y", farthest=True)
    return rounded(hits, 9)


def _labelled(df: DataFrame) -> DataFrame:
    return df.select("vec_id", "y")


def _near_miss_sql(pool: str, order: str, pick: str) -> str:
    return f"""with {PAIR}, {pool} {_near('h', 'pool', 'rare', 3, order)},
      m as (select vec_id, avg(d) as d from h group by vec_id)
      select vec_id, y from rare union all
      (select vec_id, 0 from m order by d {pick}, vec_id limit (select count(*) from rare))"""


ALL_COMMON = "pool as (select * from common),"
NEAR_RARE = (
    _near("f", "rare", "common", 3)
    + ", pool as (select * from common where vec_id in (select nb from f)),"
)


@query("near_miss_1", _near_miss_sql(ALL_COMMON, "asc", "asc"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(resample.near_miss(_vectors(spark, folder), *COLUMNS, version=1))


@query("near_miss_2", _near_miss_sql(ALL_COMMON, "desc", "asc"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(resample.near_miss(_vectors(spark, folder), *COLUMNS, version=2))


@query("near_miss_3", _near_miss_sql(NEAR_RARE, "asc", "desc"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(resample.near_miss(_vectors(spark, folder), *COLUMNS, version=3))


def _edited(i: int, source: str) -> str:
    return f"""c{i} as (select * from {source} where y = 0), {_near(f'h{i}', f'c{i}', source, 3)},
      e{i} as (select * from {source}
               where vec_id not in (select vec_id from h{i} where nby = 1))"""


@query("edited_nearest_neighbours", f"with {VECTORS}, {_edited(1, 'e')} select vec_id, y from e1")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(resample.edited_nn(_vectors(spark, folder), *COLUMNS))


ROUNDS = 8


@query(
    "repeated_edited_nearest_neighbours",
    f"""with {VECTORS}, {', '.join(_edited(i + 1, f'e{i}' if i else 'e') for i in range(ROUNDS))},
        settled as (select count(*) = 0 as yes from e{ROUNDS - 1}
                    where vec_id not in (select vec_id from e{ROUNDS}))
        select vec_id, y, (select yes from settled) as settled from e{ROUNDS}""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """All rounds until nothing changes; the SQL has more rounds than that takes."""
    edited = resample.repeated_edited_nn(_vectors(spark, folder), *COLUMNS)
    return _labelled(edited).withColumn("settled", F.lit(True))


def _links(source: str) -> str:
    near = _near("nn as materialized", source, source, 1).replace("materialized as", "materialized", 1)
    # a row that is the nearest of its own nearest has its label beside the latter
    return f"""{near},
      l as materialized (select a.vec_id, a.nb from nn a join nn b on a.nb = b.vec_id and b.nb = a.vec_id
        where b.nby = 0 and a.nby = 1)"""


@query("tomek_links", f"with {VECTORS}, {_links('e')} select vec_id as common, nb as rare from l")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return resample.tomek_links(_vectors(spark, folder), *COLUMNS)


@query(
    "drop_tomek_links",
    f"""with {VECTORS}, {_links('e')}
        select vec_id, y from e where vec_id not in (select vec_id from l)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(resample.drop_tomek_links(_vectors(spark, folder), *COLUMNS))


@query(
    "one_sided_selection",
    f"""with {PAIR},
        seed as (select * from common order by {sql.digest('vec_id', 37)}, vec_id limit 1),
        store as (select * from rare union all select * from seed),
        rest as (select * from common where vec_id not in (select vec_id from seed)),
        {_near('one', 'rest', 'store', 1)},
        kept as (select * from store union all
                 select * from rest where vec_id in (select vec_id from one where nby = 1)),
        {_links('kept')}
        select vec_id, y from kept where vec_id not in (select vec_id from l)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(resample.one_sided_selection(_vectors(spark, folder), *COLUMNS))


@query(
    "neighbourhood_cleaning",
    f"""with {PAIR}, {_near('h', 'common', 'e', 3)}, {_near('r', 'rare', 'e', 3)},
        lost as (select vec_id from r group by vec_id having avg(nby) < 0.5)
        select vec_id, y from e where vec_id not in (select vec_id from h where nby = 1)
          and vec_id not in (select nb from r where nby = 0 and vec_id in (select vec_id from lost))""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(resample.neighbourhood_cleaning(_vectors(spark, folder), *COLUMNS))


@query(
    "condensed_nearest_neighbours",
    f"""with {PAIR} select (select count(*) from rare) as rare, (select count(*) from e) as rows,
          cast(0 as bigint) as misjudged""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Rare rows of the store, rows in and out of it, and common rows outside it misjudged."""
    vectors = _vectors(spark, folder)
    store = cut_lineage(resample.condensed_nn(vectors, *COLUMNS))
    rest = vectors.where("y = 0").join(store.select("vec_id"), "vec_id", "left_anti")
    wrong = neighbors.knn(rest, store, 1, "vec_id", "embedding", "y").where("neighbor_label = 1")
    parts = [
        store.select(F.col("y").alias("rare"), F.lit(1).alias("one"), F.lit(0).alias("bad")),
        rest.select(F.lit(0).alias("rare"), F.lit(1).alias("one"), F.lit(0).alias("bad")),
        wrong.select(F.lit(0).alias("rare"), F.lit(0).alias("one"), F.lit(1).alias("bad")),
    ]
    return reduce(DataFrame.unionByName, parts).agg(
        F.sum("rare").alias("rare"), F.sum("one").alias("rows"), F.sum("bad").alias("misjudged")
    )


def _condensed(i: int) -> str:
    return f"""rest{i} as (select * from common where vec_id not in (select vec_id from store{i})),
      {_near(f'one{i}', f'rest{i}', f'store{i}', 1)},
      store{i + 1} as (select * from store{i} union all select * from rest{i}
        where vec_id in (select vec_id from one{i} where nby = 1))"""


@query(
    "condensed_nearest_neighbours_two_rounds",
    f"""with {PAIR},
        store0 as (select * from rare union all (
          select * from common order by {sql.digest('vec_id', 37)}, vec_id limit 1)),
        {_condensed(0)}, {_condensed(1)}
        select vec_id, y from store2""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(resample.condensed_nn(_vectors(spark, folder), *COLUMNS, rounds=2))


@query(
    "condensed_nearest_neighbours_in_order",
    f"""with recursive {PAIR},
        opening as (select * from rare union all (
          select * from common order by {sql.digest('vec_id', 37)}, vec_id limit 1)),
        others as (select * from common where vec_id not in (select vec_id from opening)),
        {_near('one', 'others', 'opening', 1)},
        wrong as materialized (select o.vec_id, o.p, one.d, one.nb, row_number() over (order by o.vec_id) as turn
          from others o join one using (vec_id) where one.nby = 1),
        helpers as materialized (select a.turn, list(b.turn) filter (b.turn is not null) as turns
          from wrong a left join wrong b on b.turn < a.turn and (list_distance(a.p, b.p) < a.d
            or list_distance(a.p, b.p) = a.d and b.vec_id < a.nb) group by a.turn),
        walk(turn, joined) as (
          select cast(0 as bigint), cast([] as bigint[])
          union all
          select h.turn, case when len(list_intersect(w.joined, coalesce(h.turns, cast([] as bigint[])))) = 0
              then list_append(w.joined, h.turn) else w.joined end
          from walk w join helpers h on h.turn = w.turn + 1),
        last as (select unnest(arg_max(joined, turn)) as turn from walk)
        select vec_id, y from opening
        union all select vec_id, cast(0 as int) from wrong where turn in (select turn from last)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(resample.condensed_nn_in_order(_vectors(spark, folder), *COLUMNS))


def _drawn(key: str, copy: str, what: str) -> str:
    return sql.fraction(f"concat(cast({key} as string), '|', cast({copy} as string), '|{what}')", 37)


def _interpolated(seeds: str, k: int = 5) -> str:
    """``made``: new rows from ``seeds`` (vec_id, p, copies) towards their rare neighbours."""
    return f"""{_near('sn', seeds, 'rare', k)},
      ranked as (select *, row_number() over (partition by vec_id order by d, nb) as r,
                   count(*) over (partition by vec_id) as k from sn),
      c as (select vec_id, p, unnest(range(1, copies + 1)) as copy from {seeds}),
      aimed as (select c.vec_id, c.copy, c.p, ranked.nb from c join ranked
                on c.vec_id = ranked.vec_id
                and ranked.r = floor({_drawn('c.vec_id', 'c.copy', 'neighbor')} * ranked.k) + 1),
      made as (select concat(cast(a.vec_id as varchar), '~', cast(a.copy as varchar)) as vec_id, 1 as y,
        list_transform(list_zip(a.p, n.p),
          lambda z: z[1] + {_drawn('a.vec_id', 'a.copy', 'step')} * (z[2] - z[1])) as p
        from aimed a join rare n on n.vec_id = a.nb)"""


GROWN = """select vec_id, y, round(list_sum(p), 6) as total, round(p[1], 6) as first from (
  select cast(vec_id as varchar) as vec_id, y, p from e union all select vec_id, y, p from made)"""
NEEDED = "(select cast(sum(1 - y) - sum(y) as bigint) from e)"


def _shared_out(seeds: str) -> str:
    return f"""seeds as (select *, {NEEDED} // (select count(*) from {seeds})
        + cast(row_number() over (order by {sql.digest('vec_id', 37)}, vec_id)
               <= {NEEDED} % (select count(*) from {seeds}) as int) as copies from {seeds})"""


def _summed(df: DataFrame) -> DataFrame:
    """Whole points, as their coordinate sum, next to key and label."""
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    first = F.get("embedding", F.lit(0))
    return rounded(df.select("vec_id", "y", total.alias("total"), first.alias("first")))


@query("smote", f"with {PAIR}, {_shared_out('rare')}, {_interpolated('seeds')} {GROWN}")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _summed(resample.smote(_vectors(spark, folder), *COLUMNS))


@query(
    "adasyn",
    f"""with {PAIR}, {_near('h', 'rare', 'e', 5)},
        hard as (select vec_id, avg(1 - nby) as w from h group by vec_id),
        seeds as (select vec_id, p, cast(round_even(w / (select sum(w) from hard) * {NEEDED}, 0)
                    as bigint) as copies from rare join hard using (vec_id)),
        {_interpolated('seeds')} {GROWN}""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _summed(resample.adasyn(_vectors(spark, folder), *COLUMNS))


@query(
    "borderline_smote",
    f"""with {PAIR}, {_near('h', 'rare', 'e', 10)},
        edge as (select * from rare where vec_id in (
          select vec_id from h group by vec_id
          having count(*) filter (nby = 0) >= 5 and count(*) filter (nby = 0) < 10)),
        {_shared_out('edge')}, {_interpolated('seeds')} {GROWN}""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _summed(resample.borderline_smote(_vectors(spark, folder), *COLUMNS))


EVEN = f"""with {PAIR} select (select count(*) from common) as zeros,
  (select count(*) from common) as ones, (select count(*) from rare) as kept,
  cast(0 as bigint) as astray"""


def _on_lines(spark: SparkSession, folder: str, sampler, outward: float = 0.0) -> DataFrame:
    """Class sizes, original rare rows, and made rows not on the line between their two rare
    rows or on what is added to it, ``outward`` of its length."""
    vectors = _vectors(spark, folder)
    grown = cut_lineage(sampler(vectors, *COLUMNS, end="end"))
    rare = vectors.where("y = 1").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").cast("array<double>").alias("p")
    )
    made = grown.where(F.col("vec_id").contains("~")).select(
        F.substring_index("vec_id", "~", 1).alias("seed"), "end", F.col("embedding").alias("made")
    )
    # an end that is no rare row has no point, and what is computed from it is null
    ends = made.join(rare.select(F.col("id").alias("seed"), F.col("p").alias("a")), "seed", "left").join(
        rare.select(F.col("id").alias("end"), F.col("p").alias("b")), "end", "left"
    )
    minus = lambda x, y: F.zip_with(x, y, lambda u, v: u - v)
    total = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u * v), F.lit(0.0), lambda n, u: n + u)
    lines = ends.withColumns({"line": minus("b", "a"), "way": minus("made", "a")})
    share = total("way", "line") / F.greatest(total("line", "line"), F.lit(1e-300))
    off = F.array_max(F.zip_with("way", "line", lambda w, v: F.abs(w - F.col("t") * v)))
    near = (off < 1e-6) & (F.col("t") > -outward - 1e-9) & (F.col("t") < 1 + 1e-9) & (F.col("seed") != F.col("end"))
    wrong = lines.withColumn("t", share).agg(F.count_if(~F.coalesce(near, F.lit(False))).alias("astray"))
    sizes = grown.agg(
        F.count_if(F.col("y") == 0).alias("zeros"),
        F.count_if(F.col("y") == 1).alias("ones"),
        F.count_if((F.col("y") == 1) & ~F.col("vec_id").contains("~")).alias("kept"),
    )
    both = sizes.select("*", F.lit(1).alias("i")).join(wrong.select("*", F.lit(1).alias("i")), "i")
    return both.select("zeros", "ones", "kept", F.coalesce("astray", F.lit(0)).alias("astray"))


@query("svm_smote", EVEN)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _on_lines(spark, folder, resample.svm_smote, outward=0.5)


@query("kmeans_smote", EVEN)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _on_lines(spark, folder, resample.kmeans_smote)


@query(
    "smote_edited",
    f"""with {PAIR}, {_shared_out('rare')}, {_interpolated('seeds')},
        g as (select cast(vec_id as varchar) as vec_id, y, p from e union all select vec_id, y, p from made),
        {_near('h', 'g', 'g', 3)}
        select vec_id, y from g where vec_id not in (
          select h.vec_id from h join g on g.vec_id = h.vec_id where g.y <> h.nby)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(resample.smote_enn(_vectors(spark, folder), *COLUMNS))


@query(
    "smote_tomek",
    f"""with {PAIR}, {_shared_out('rare')}, {_interpolated('seeds')},
        g as (select cast(vec_id as varchar) as vec_id, y, p from e union all select vec_id, y, p from made), {_links('g')}
        select vec_id, y from g where vec_id not in (select vec_id from l)
          and vec_id not in (select nb from l)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(resample.smote_tomek(_vectors(spark, folder), *COLUMNS))


@query(
    "instance_hardness",
    f"""with {PAIR} select (select count(*) from rare) as rare, true as enough,
          cast(0 as bigint) as easier_dropped""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Rare rows, whether as many common ones are kept, and dropped ones easier than a kept one."""
    vectors = _vectors(spark, folder)
    kept = cut_lineage(resample.instance_hardness(vectors, *COLUMNS))
    easy = resample.instance_easiness(
        vectors.withColumn("embedding", F.col("embedding").cast("array<double>")), *COLUMNS
    )
    marked = cut_lineage(
        easy.join(kept.select("vec_id", F.lit(1).alias("in")), "vec_id", "left")
    )
    hardest = marked.where("in = 1").agg(F.min("_easy")).first()[0]
    ones = kept.where("y = 1").count()
    return marked.agg(
        F.lit(ones).cast("bigint").alias("rare"),
        (F.count("in") >= ones).alias("enough"),
        F.count_if(F.col("in").isNull() & (F.col("_easy") > hardest)).alias("easier_dropped"),
    )


@query(
    "resample_counts",
    f"""with {VECTORS}, {_edited(1, 'e')}
        select 'before' as stage, y, count(*) as n from e group by y
        union all select 'after', y, count(*) from e1 group by y""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _vectors(spark, folder)
    return resample.resample_counts(vectors, resample.edited_nn(vectors, *COLUMNS), "y")


STUDIED = ("none", "smote", "near_miss_1")
STUDY_FOLDS = 3


@query(
    "resampling_study",
    f"""with {VECTORS},
        dealt as (select y, cast((row_number() over (partition by y order by {sql.digest('vec_id', 37)}, vec_id) - 1)
                    % {STUDY_FOLDS} as int) as fold from e),
        f as (select cast(i as int) as fold from range({STUDY_FOLDS}) t(i)),
        sized as (select f.fold,
            count(*) filter (d.fold = f.fold and y = 1) as positives,
            count(*) filter (d.fold = f.fold and y = 0) as negatives,
            count(*) filter (d.fold <> f.fold and y = 0) as zeros,
            count(*) filter (d.fold <> f.fold and y = 1) as ones
          from f join dealt d on true group by f.fold)
        select sampler, model, fold, positives, negatives, zeros as zeros_before, ones as ones_before,
          case sampler when 'near_miss_1' then ones else zeros end as zeros_after,
          case sampler when 'smote' then zeros else ones end as ones_after, true as fits
        from sized join (values ('none'), ('smote'), ('near_miss_1')) s(sampler) on true
          join (values ('logistic'), ('forest')) m(model) on true""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Class sizes of every part, and whether its metrics are those of its held-out rows."""
    study = resample.resampling_study(_vectors(spark, folder), *COLUMNS, STUDIED, folds=STUDY_FOLDS)
    fits = (
        (F.col("tp") + F.col("fn") == F.col("positives"))
        & (F.col("fp") + F.col("tn") == F.col("negatives"))
        & F.col("auc").between(0, 1)
        & F.col("average_precision").between(0, 1)
    )
    return study.select(
        "sampler", "model", "fold", "positives", "negatives", "zeros_before", "ones_before", "zeros_after",
        "ones_after", fits.alias("fits"),
    )


@query(
    "resampling_study_summary",
    f"""select sampler, 'logistic' as model, cast({STUDY_FOLDS} as bigint) as folds, true as spread
        from (values {', '.join(f"('{name}')" for name in resample.SAMPLERS)}) s(sampler)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """All samplers; their logistic models are fitted together."""
    study = cut_lineage(
        resample.resampling_study(_vectors(spark, folder), *COLUMNS, folds=STUDY_FOLDS, models=("logistic",))
    )
    means = resample.study_summary(study)
    edges = study.groupBy("sampler", "model").agg(F.min("auc").alias("low"), F.max("auc").alias("high"))
    spread = F.col("auc_mean").between(F.col("low"), F.col("high")) & (
        F.col("auc_std") <= F.col("high") - F.col("low")
    )
    return means.join(edges, ["sampler", "model"]).select("sampler", "model", "folds", spread.alias("spread"))


@query(
    "logistic_models_at_rest",
    f"""with {VECTORS},
        dealt as (select y, cast((row_number() over (partition by y order by {sql.digest('vec_id', 37)}, vec_id) - 1)
                    % 10 as int) as fold from e)
        select f.fold, count(*) as rows, sum(y)::bigint as ones, true as at_rest
        from (select cast(i as int) as fold from range(10) t(i)) f join dealt d on d.fold <> f.fold group by f.fold""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of ten training sets, and whether the penalised loss of each has a slope of 0 where
    its model ended, all fitted together."""
    dealt = prep.stratified_folds(_vectors(spark, folder), "vec_id", "y", 10, resample.SEED)
    rows = cut_lineage(
        dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(9)))).where("part <> fold").drop("fold")
    )
    fitted = logistic.fit_many(rows, "part", "y", "embedding", resample.STRENGTH)
    ends = spark.createDataFrame([(m, f.weights.tolist()) for m, f in fitted.items()], "part int, w array<double>")
    width = len(next(iter(fitted.values())).weights) - 1 if fitted else 0
    points = F.col("embedding").cast("array<double>")
    margin = F.aggregate(
        F.zip_with(points, F.slice("w", 1, width), lambda x, w: x * w), F.get("w", F.lit(width)), lambda a, x: a + x
    )
    judged = rows.join(F.broadcast(ends), "part").withColumn("off", 1 / (1 + F.exp(-margin)) - F.col("y"))
    slopes = [F.avg(F.col("off") * F.get("embedding", F.lit(i))) for i in range(width)]
    spreads = [F.var_samp(F.get("embedding", F.lit(i)).cast("double")) for i in range(width)]
    facts = judged.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("y").alias("ones"), F.avg("off").alias("free"),
        F.array(*slopes).alias("slopes"), F.array(*spreads).alias("spreads"), F.first("w").alias("w"),
    )
    penalty = F.zip_with("spreads", F.slice("w", 1, width), lambda v, w: v * w * resample.STRENGTH)
    most = F.array_max(F.zip_with("slopes", penalty, lambda a, b: F.abs(a + b)))
    return facts.select(
        F.col("part").alias("fold"), "rows", "ones", ((most < 1e-6) & (F.abs("free") < 1e-6)).alias("at_rest")
    )


# --- Models -----------------------------------------------------------------


def _matrix(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """The cleaned, imputed matrix of the derived tables, written once."""
    path = scratch(spark, "matrix")
    master = io.stage(spark, path, lambda: build_master(spark, folder))
    cleaned = ft.clean_matrix(
        master, view(spark, folder, "target"), ft.fit_master_categories(master)
    )
    columns = tr.matrix_columns(cleaned)
    fills = {c: m for c, m in prep.medians(cleaned, columns).items() if m is not None}
    filled = prep.impute(cleaned.select(ft.KEY, ft.LABEL, *fills), fills)
    return io.stage(spark, scratch(spark, "filled"), lambda: filled), list(fills)


def _judged(model, matrix: DataFrame) -> DataFrame:
    scored = models.with_scores(model, matrix)
    return scored.select(ft.KEY, ft.LABEL, "prediction", "p_positive")


RETOLD = with_views(
    ["target"], "select count(*) as rows, cast(0 as bigint) as wrong from target"
)


def _node_values(nodes: pd.DataFrame, forest: bool) -> dict[str, np.ndarray]:
    """The saved nodes of one tree by id: children, splits and what a row that ends there gets."""
    nodes = nodes.set_index("id").sort_index()
    size = int(nodes.index.max()) + 1
    at = nodes.index.to_numpy()
    cuts = [(split["featureIndex"], (*split["leftCategoriesOrThreshold"], np.nan)[0]) for split in nodes["split"]]
    shares = [stats[1] / sum(stats) for stats in nodes["impurityStats"]] if forest else nodes["prediction"]
    held = {"left": nodes["leftChild"], "right": nodes["rightChild"], "value": shares}
    held |= dict(zip(("feature", "threshold"), zip(*cuts)))
    tree = {}
    for name, values in held.items():
        kind = np.float64 if name in ("value", "threshold") else np.int64
        tree[name] = np.full(size, -1, dtype=kind)
        tree[name][at] = np.array(values, dtype=kind)
    return tree


def _walked(tree: dict[str, np.ndarray], points: np.ndarray) -> np.ndarray:
    """What the leaf that each row comes to says: all rows go down a level at a time."""
    node = np.zeros(len(points), dtype=np.int64)
    going = np.flatnonzero(tree["left"][node] >= 0)
    while len(going):
        here = node[going]
        low = points[going, tree["feature"][here]] <= tree["threshold"][here]
        node[going] = np.where(low, tree["left"][here], tree["right"][here])
        going = going[tree["left"][node[going]] >= 0]
    return tree["value"][node]


def _retold(spark: SparkSession, model, matrix: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, and rows whose score is not what the saved tree nodes add up to."""
    path = scratch(spark, "trees")
    model.write().save(path)
    stage = f"{path}/stages/1_{model.stages[1].uid}"
    nodes = spark.read.parquet(f"{stage}/data").select("treeID", "nodeData.*").toPandas()
    forest = "Forest" in model.stages[1].uid
    weights = list(model.stages[1].treeWeights)
    trees = {t: _node_values(g, forest) for t, g in nodes.groupby("treeID")}
    key = ft.KEY

    def tell(batches):
        for batch in batches:
            points = batch[columns].to_numpy(dtype=float)
            total = np.zeros(len(batch))
            for t, tree in trees.items():
                total += _walked(tree, points) * (1.0 if forest else weights[t])
            told = total / len(trees) if forest else np.clip(total, 0.0, 1.0)
            yield pd.DataFrame({key: batch[key], "told": told})

    told = matrix.select(key, *columns).mapInPandas(tell, f"{key} string, told double")
    return _judged(model, matrix).join(told, key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.abs(F.col("told") - F.col("p_positive")) > 1e-9).alias("wrong"),
    )


@query("random_forest_scores", RETOLD)
def _(spark: SparkSession, folder: str) -> DataFrame:
    matrix, columns = _matrix(spark, folder)
    return _retold(spark, models.random_forest(matrix, columns, ft.LABEL), matrix, columns)


@query("boosted_trees_scores", RETOLD)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, and rows whose score is not what the listed nodes of a saved model add up to."""
    matrix, columns = _matrix(spark, folder)
    model = models.boosted_trees(matrix, columns, ft.LABEL)
    path = scratch(spark, "booster")
    model.save(spark, path)
    nodes = Booster.load(spark, path).nodes(spark).toPandas()
    trees = [g.set_index("node").to_dict("index") for _, g in nodes.groupby("tree")]
    key = ft.KEY

    def tell(batches):
        for batch in batches:
            told = []
            for row in batch.to_dict("records"):
                total = 0.5
                for tree in trees:
                    node = tree[0]
                    while node["feature"] is not None:
                        node = tree[node["left" if row[node["feature"]] <= node["threshold"] else "right"]]
                    total += node["weight"]
                told.append(min(max(total, 0.0), 1.0))
            yield pd.DataFrame({key: batch[key], "told": told})

    told = matrix.select(ft.KEY, *columns).repartition(8).mapInPandas(tell, f"{ft.KEY} string, told double")
    return _judged(model, matrix).join(told, ft.KEY).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.abs(F.col("told") - F.col("p_positive")) > 1e-9).alias("wrong"),
    )


def _split_sql(level: str, rows: str, columns: dict[str, int]) -> str:
    """Common table expressions: the best split of every ``path`` of ``rows`` (path, y, g, columns),
    with one row of the leaf weights of its sides."""
    long = " union all ".join(f"select path, {i} as col, {c}::double as v, g from {rows}" for c, i in columns.items())
    soft = "(sign({0}) * greatest(abs({0}) - 1, 0))"
    worth = f"{soft} * {soft} / ({{1}} + 1.0)"
    gain = f"{worth.format('lg', 'lh')} + {worth.format('rg', 'rh')} - {worth.format('tg', 'th')}"
    return f"""{level}_long as ({long}),
    {level}_top as (select col, max(v) as top from {rows.split('_')[0]}_all group by col),
    {level}_total as (select path, sum(g) as tg, count(*) as th from {rows} group by path),
    {level}_sums as (select path, col, v, sum(g) as g, count(*) as h from {level}_long group by path, col, v),
    {level}_none as (select path, col, g as ng, h as nh from {level}_sums where v is null),
    {level}_run as (select path, col, v, sum(g) over w as kg, sum(h) over w as kh from {level}_sums
      where v is not null window w as (partition by path, col order by v)),
    {level}_sides as (select path, col, v, side, tg, th, kg + side * coalesce(ng, 0) as lg, kh + side * coalesce(nh, 0) as lh
      from {level}_run left join {level}_none using (path, col) join {level}_total using (path),
      (values (0), (1)) s(side)),
    {level}_gains as (select *, {gain} as gain from (select *, tg - lg as rg, th - lh as rh from {level}_sides)
      where lh >= 1 and rh >= 1),
    {level} as (select path, col, v, side, gain, {soft.format('lg')} / (lh + 1.0) as lw, {soft.format('rg')} / (rh + 1.0) as rw,
        lh, rh, case when v >= top then 'Infinity'::double else v end as threshold
      from (select *, row_number() over (partition by path order by gain desc, col, v, side) as place from {level}_gains)
      join {level}_top using (col) where place = 1 and gain > 1e-6)"""


#: Columns of few values with gaps, and a label that follows from them in part.
GROWN = "l_quantity", "l_discount", "l_tax"


def _grown_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = base(spark, folder, "lineitem")
    gap = {GROWN[0]: F.col("l_linenumber") == 3, GROWN[1]: F.col("l_partkey") % 7 == 0, GROWN[2]: F.lit(False)}
    late = (F.col("l_quantity") > 30) & (F.col("l_linenumber") != 3) | (F.col("l_discount") < 0.03) & (F.col("l_suppkey") % 4 > 0)
    return lines.select(
        "l_orderkey", "l_linenumber", late.cast("int").alias("y"),
        *[F.when(~gap[c], F.col(c).cast("double")).alias(c) for c in GROWN],
    )


GROWN_SQL = f"""r as (select l_orderkey, l_linenumber,
    ((l_quantity > 30 and l_linenumber != 3) or (l_discount < 0.03 and l_suppkey % 4 > 0))::int as y,
    case when l_linenumber != 3 then l_quantity::double end as l_quantity,
    case when l_partkey % 7 != 0 then l_discount::double end as l_discount, l_tax::double as l_tax from lineitem),
  r_all as ({' union all '.join(f'select {i} as col, {c} as v from r' for i, c in enumerate(GROWN))}),
  r_0 as (select *, '' as path, 0.5 - y as g from r),
  {_split_sql('first', 'r_0', {c: i for i, c in enumerate(GROWN)})},
  r_1 as (select r_0.* exclude (path), case when case col when 0 then l_quantity when 1 then l_discount else l_tax end <= threshold
      or (case col when 0 then l_quantity when 1 then l_discount else l_tax end is null and side = 1) then 'L' else 'R' end as path
    from r_0, first),
  {_split_sql('second', 'r_1', {c: i for i, c in enumerate(GROWN)})},
  leaves as (select case when second.path is null then r_1.path when
      case col when 0 then l_quantity when 1 then l_discount else l_tax end <= threshold
      or (case col when 0 then l_quantity when 1 then l_discount else l_tax end is null and side = 1)
      then r_1.path || 'L' else r_1.path || 'R' end as path, r_1.* exclude (path) from r_1 left join second using (path))"""

GROWN_SETTINGS = {"depth": 2, "rate": 0.3, "rounds": 1, "column_share": 1.0}


def _paths(model: Booster) -> dict[int, str]:
    """How the nodes of the first tree are reached."""
    tree, paths = model.trees[0], {0: ""}
    for i in range(len(tree.column)):
        if tree.column[i] >= 0:
            paths |= {tree.left[i]: paths[i] + "L", tree.right[i]: paths[i] + "R"}
    return paths


@query(
    "booster_first_levels",
    f"""with {GROWN_SQL},
      splits as (select path, col, side, gain, threshold from first union all select path, col, side, gain, threshold from second)
    select path, ['{"','".join(GROWN)}'][col + 1] as feature, round(threshold, 6) as threshold, side = 1 as missing_left,
      round(gain, 6) as gain, cast(null as double) as weight, cast(null as bigint) as rows from splits
    union all
    select path, null, null, null, null,
      round(-0.3 * (sign(sum(g)) * greatest(abs(sum(g)) - 1, 0)) / (count(*) + 1.0), 9), count(*) from leaves group by path""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The splits and leaves of a tree over all lines."""
    rows = _grown_rows(spark, folder)
    model = models.boosted_trees(rows, GROWN, "y", **GROWN_SETTINGS)
    paths = spark.createDataFrame(list(_paths(model).items()), "node int, path string")
    inner = F.col("feature").isNotNull()
    return model.nodes(spark).join(paths, "node").select(
        "path", "feature", F.round("threshold", 6).alias("threshold"), F.when(inner, F.col("missing_left")).alias("missing_left"),
        F.when(inner, F.round("gain", 6)).alias("gain"), F.when(~inner, F.round("weight", 9)).alias("weight"),
        F.when(~inner, F.col("hessian").cast("long")).alias("rows"),
    )


@query(
    "booster_scores_with_gaps",
    f"""with {GROWN_SQL},
      weights as (select path, -0.3 * (sign(sum(g)) * greatest(abs(sum(g)) - 1, 0)) / (count(*) + 1.0) as w from leaves group by path)
    select l_orderkey, l_linenumber, round(least(greatest(0.5 + w, 0), 1), 9) as p_positive from leaves join weights using (path)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of rows as they are, missing values included."""
    rows = _grown_rows(spark, folder)
    model = models.boosted_trees(rows, GROWN, "y", **GROWN_SETTINGS)
    scored = models.with_scores(model, rows)
    return scored.select("l_orderkey", "l_linenumber", F.round("p_positive", 9).alias("p_positive"))


@query(
    "logistic_regression_scores",
    with_views(["target"], "select count(*) as rows, true as at_rest from target"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, and whether the gradient of the penalised loss is near 0 where training ended."""
    matrix, columns = _matrix(spark, folder)
    scaled = cut_lineage(prep.standardise(matrix, columns))
    strength = 1e-3
    model = models.logistic(scaled, columns, ft.LABEL, strength)
    weights = model.stages[1].coefficients.toArray()
    error = F.col("p_positive") - F.col(ft.LABEL)
    slopes = [F.avg(error * F.col(c)).alias(f"g{i}") for i, c in enumerate(columns)]
    spread = [F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)]
    scored = models.with_scores(model, scaled)
    facts = scored.agg(F.count(F.lit(1)).alias("rows"), F.avg(error).alias("g"), *slopes, *spread).first()
    # The penalty acts on the weights of columns of unit spread.
    rest = [facts["g"]] + [
        facts[f"g{i}"] / facts[f"s{i}"] + strength * w * facts[f"s{i}"]
        for i, w in enumerate(weights)
        if facts[f"s{i}"]
    ]
    return scored.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(max(map(abs, rest)) < 1e-3).alias("at_rest")
    )


SHARED_OUT = "select true as ordered, true as shared_out, cast(0 as bigint) as below_zero"


def _ranked(ranking: DataFrame, splits: int) -> DataFrame:
    """Whether ranks follow importance without gaps and importances share out 1, or nothing
    where no tree has a split."""
    whole = 1 if splits else 0
    after = Window.orderBy("rank")
    falls = F.col("importance") <= F.lag("importance", 1, float("inf")).over(after)
    placed = F.col("rank") == F.row_number().over(after)
    return ranking.select("importance", (falls & placed).alias("fits")).agg(
        F.every("fits").alias("ordered"),
        (F.abs(F.sum("importance") - whole) < 1e-9).alias("shared_out"),
        F.count_if(F.col("importance") < 0).alias("below_zero"),
    )


@query("extra_trees_importance", SHARED_OUT)
def _(spark: SparkSession, folder: str) -> DataFrame:
    matrix, columns = _matrix(spark, folder)
    model = models.extra_trees(matrix, columns, ft.LABEL)
    return _ranked(models.rank_importance(model, columns, matrix), model.splits)


#: Columns, trees, levels and columns a node draws of the checked trees.
DRAWN_COLUMNS = "l_quantity", "l_discount", "l_tax", "l_extendedprice"
DRAWN_TREES, DRAWN_NUMBER, DRAWN_SEED = 8, 2, 42


def _drawn_number(what: str) -> str:
    return sql.fraction(f"concat(tree, '|', node, '|', col, '|{what}')", DRAWN_SEED)


def _drawn_level(level: int, rows: str) -> str:
    """Common table expressions: the split of every node of ``rows`` (tree, node, id, y), and
    where its rows come to."""
    bad = "(2.0 * {1} * ({0} - {1}) / {0})"
    gain = f"{bad.format('n', 'ones')} - {bad.format('ln', 'lones')} - {bad.format('(n - ln)', '(ones - lones)')}"
    return f"""long{level} as materialized (select tree, node, y, col, v from {rows} join cells using (id)),
    range{level} as (select tree, node, col, min(v) as low, max(v) as high, count(*) as n, sum(y)::bigint as ones
      from long{level} group by tree, node, col having min(v) < max(v) and sum(y) > 0 and sum(y) < count(*)),
    tried{level} as (select *, low + {_drawn_number('threshold')} * (high - low) as threshold from range{level}
      qualify row_number() over (partition by tree, node order by {_drawn_number('column')}, col) <= {DRAWN_NUMBER}),
    split{level} as materialized (select tree, node, col, threshold, n, ones, {gain} as gain from (
        select tree, node, col, any_value(threshold) as threshold, any_value(n) as n, any_value(ones) as ones,
          count(*) filter (v <= threshold) as ln, coalesce(sum(y) filter (v <= threshold), 0)::bigint as lones
        from tried{level} join long{level} using (tree, node, col) group by tree, node, col)
      qualify row_number() over (partition by tree, node order by gain desc, col) = 1),
    rows{level + 1} as (select tree, 2 * s.node + (c.v > s.threshold)::bigint as node, r.id, r.y
      from {rows} r join split{level} s using (tree, node) join cells c on c.id = r.id and c.col = s.col)"""


@query(
    "extra_trees_first_levels",
    f"""with r as (select row_number() over () as id, *, ((l_quantity > 30) or (l_discount < 0.03 and l_suppkey % 4 > 0))::int as y
        from lineitem),
      cells as materialized ({' union all '.join(f'select id, {i} as col, {c}::double as v from r' for i, c in enumerate(DRAWN_COLUMNS))}),
      rows0 as (select tree, cast(1 as bigint) as node, id, y from r, range({DRAWN_TREES}) t(tree)),
      {_drawn_level(0, 'rows0')}, {_drawn_level(1, 'rows1')}, splits as (select * from split0 union all select * from split1)
    select tree::int as tree, node, ['{"','".join(DRAWN_COLUMNS)}'][col + 1] as feature, round(threshold, 6) as threshold,
      round(gain, 4) as gain, n as rows, ones from splits""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The splits of the first two levels, over all lines."""
    lines = base(spark, folder, "lineitem")
    late = (F.col("l_quantity") > 30) | (F.col("l_discount") < 0.03) & (F.col("l_suppkey") % 4 > 0)
    rows = lines.select(late.cast("int").alias("y"), *DRAWN_COLUMNS)
    model = models.extra_trees(rows, DRAWN_COLUMNS, "y", seed=DRAWN_SEED, trees=DRAWN_TREES, depth=2, columns=DRAWN_NUMBER)
    return model.nodes(spark).where("feature is not null").select(
        "tree", "node", "feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 4).alias("gain"), "rows", "ones"
    )


@query(
    "select_features",
    """select cast(row_number() over (order by f) + 20 as int) as rank, f as feature
       from (values ('earliest_to_covid_diag'), ('latest_to_covid_diag')) v(f)
       union all select cast(i as int), null from range(1, 21) t(i)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of the chosen features; names of the forced ones where they come last."""
    chosen = _selected(spark, folder)
    forced = F.col("feature").isin(*tr.FORCED) & (F.col("rank") > tr.TOP_FEATURES)
    return chosen.select("rank", F.when(forced, F.col("feature")).alias("feature"))


def _selected(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "master")
    master = io.stage(spark, path, lambda: build_master(spark, folder))
    cleaned = ft.clean_matrix(
        master, view(spark, folder, "target"), ft.fit_master_categories(master)
    )
    return tr.select_features(cleaned)[2]


@query("grid_search")
def _(spark: SparkSession, folder: str) -> DataFrame:
    matrix, columns = _matrix(spark, folder)
    return rounded(models.grid_search(matrix, ft.KEY, columns, ft.LABEL))


@query(
    "model_write_and_read",
    with_views(["target"], "select count(*) as rows, cast(0 as bigint) as changed from target"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    matrix, columns = _matrix(spark, folder)
    path = scratch(spark, "model")
    model = models.random_forest(matrix, columns, ft.LABEL)
    model.write().save(path)
    before = _judged(model, matrix)
    after = _judged(PipelineModel.load(path), matrix).select(
        ft.KEY, F.col("p_positive").alias("after")
    )
    return before.join(after, ft.KEY).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("p_positive") != F.col("after")).alias("changed"),
    )


@query("forest_importance_spearman")
def _(spark: SparkSession, folder: str) -> DataFrame:
    matrix, columns = _matrix(spark, folder)
    model = models.random_forest(matrix, columns, ft.LABEL)
    ranking = models.rank_importance(model, columns, matrix).where(F.col("importance") > 0)
    top = [r.feature for r in ranking.orderBy("rank").limit(30).collect()]
    return rounded(metrics.spearman(matrix, [*top, ft.LABEL]))


@query(
    "random_sample_exact",
    f"""select o_orderkey, o_totalprice from orders
        order by {sql.digest('o_orderkey', 5)}, o_orderkey limit 2000""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = base(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return random_sample(orders, "o_orderkey", 2000, 5)


@query("train_with_fitted_vocabularies", HELD_OUT)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return held_out_facts(
        tr.train_on(
            spark, tables(spark, folder), view(spark, folder, "drug_dictionary"),
            scratch(spark, "store"),
        )
    )

