"""Exact nearest (or farthest) neighbours as Spark jobs.

By the counted sizes of the two sides:

* small base: the base is broadcast and the query rows are mapped, without a shuffle;
* few queries: the queries are broadcast and the base is scanned once; each task keeps the
  best for every query, so the base is not moved, whatever its size;
* otherwise equal points are folded into one, so that a point a third of the rows
  share costs one search, and then, in spaces of at most ``NARROW`` coordinates, the
  points are divided into cells around pivots. The triangle inequality says which base
  points can matter to a cell. Where those are few copies of the base, they are sent there,
  and oversized cells are split into blocks of bounded size whose best candidates are
  merged; where they are many, the base stays packed and a cell reads what it needs of it;
* in wider spaces, where that inequality rules out little, blocks of queries meet blocks of
  the base, packed as matrices. A product in single precision bounds the distances; only
  pairs that the bounds leave among the best ``k`` are measured. A task keeps the best ``k``
  of its queries over all the blocks it reads, and nothing else leaves it.

All give the same rows. Ties in distance go to the smaller id.
"""

from __future__ import annotations

import sys
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from caseloom.session import cut_lineage

# Tasks get these functions by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed bounds: coordinates a broadcast base may hold, query and base rows per searched
# block, and cells per search.
BROADCAST_VALUES = 4_000_000
BLOCK_ROWS = 20_000
CELL_ROWS = 5_000
MOST_CELLS = 512
# Coordinates up to which cells are searched.
NARROW = 12
# Coordinates of a packed block and of the base rows a task reads, rows of a tile of distances,
# and copies of the base that may be sent to cells.
BLOCK_VALUES = 262_144
PART_VALUES = 32_000_000
TILE_ROWS = 256
MOST_COPIES = 8


def row_schema(kind: str) -> str:
    return f"id {kind}, label int, point array<double>"


def hit_schema(kind: str) -> str:
    return f"point_id {kind}, neighbor {kind}, neighbor_label int, distance double"


def id_type(df: DataFrame) -> str:
    return df.schema["id"].dataType.simpleString()


class Prepared:
    """Base rows as a matrix in the order of their ids, built once for any number of queries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")  # ids of any type
        self.ids, self.labels, self.points = ids[order], labels[order], points[order]


def columns_of(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return rows["id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["point"])


class Best:
    """The ``k`` best base rows of each query, over base blocks that come in the order of ids.

    A matrix product in single precision narrows the choice, in double precision where that
    leaves too much; the survivors are measured again coordinate by coordinate, because the
    product form loses digits for close points.
    """

    def __init__(self, queries: np.ndarray, k: int, farthest: bool) -> None:
        self.queries, self.k, self.sign = queries, k, -1.0 if farthest else 1.0
        self.own = np.einsum("ij,ij->i", queries, queries)
        # signed distances, in rising order, and places in all base rows seen
        self.reach = np.full((len(queries), k), np.inf)
        self.place = np.full((len(queries), k), -1, dtype=np.int64)
        self.center = queries.mean(axis=0) if len(queries) else 0.0
        moved = queries - self.center
        self.moved_own = np.einsum("ij,ij->i", moved, moved)
        self.most = np.abs(queries).max(initial=0.0)
        ones = np.ones((len(queries), 1))
        with np.errstate(over="ignore"):
            self.single = np.hstack([-2.0 * moved, ones]).astype(np.float32)
        self.seen = 0

    def add(self, base: np.ndarray, places: np.ndarray | None = None) -> None:
        """Take in the next base rows; ``places`` are theirs, if not all that follow the last."""
        if not len(base) or not len(self.queries):
            self.seen += len(base)
            return
        if places is None:
            places = self.seen + np.arange(len(base))
            self.seen += len(base)
        d = base.shape[1]
        moved = base - self.center
        norms = np.einsum("ij,ij->i", moved, moved)
        most = max(self.most, np.abs(base).max())
        radius = np.sqrt(norms.max()) + np.sqrt(self.moved_own.max())
        small = bool(radius < 1e15 and most < 1e100)
        if small:
            known = np.vstack([moved.T, norms]).astype(np.float32)
            # rounding of every term and sum, of the shift, and of numbers too small
            slack = (d + 10) * 7e-8 * (self.moved_own + 2 * norms.max()) + 1e-14 * d * most * radius + d * 1e-36
        for start in range(0, len(self.queries), TILE_ROWS):
            tile = slice(start, start + TILE_ROWS)
            found = None
            if small:
                rough = self.single[tile] @ known
                found = self._left(rough, self.moved_own[tile], slack[tile], tile)
            if found is None or len(found) > rough.size // 20 + 8 * self.k * len(rough):
                norms_here = np.einsum("ij,ij->i", base, base)
                rough = norms_here[None, :] - 2.0 * self.queries[tile] @ base.T
                fine = 1e-9 * (self.own[tile] + norms_here.max()) + 1e-300
                found = self._left(rough, self.own[tile], fine, tile)
            if len(found):
                self._take(*np.divmod(found, len(base)), base, places, tile)

    def _left(self, rough: np.ndarray, own: np.ndarray, slack: np.ndarray, tile: slice) -> np.ndarray:
        """Cells of the tile whose pair may be among the best."""
        if self.sign < 0:
            np.negative(rough, out=rough)
        worst = self.reach[tile, -1]
        limit = worst * np.abs(worst) - self.sign * own + slack * 1.01
        limit += 2e-7 * np.abs(limit) if rough.dtype == np.float32 else 0.0
        if self.k < rough.shape[1] and np.isinf(worst).any():
            kth = np.partition(rough, self.k - 1, axis=1)[:, self.k - 1].astype(np.float64)
            limit = np.minimum(limit, kth + 2.02 * slack + 2e-7 * np.abs(kth))
        return np.flatnonzero(rough <= limit.astype(rough.dtype)[:, None])

    def _take(self, row: np.ndarray, at: np.ndarray, base: np.ndarray, places: np.ndarray, tile: slice) -> None:
        """Measure pairs and keep the best of them; rows of the tile come in order."""
        part, reach = self.queries[tile], np.empty(len(row))
        step = max(1, BLOCK_VALUES // base.shape[1])
        for s in range(0, len(row), step):
            gap = part[row[s : s + step]] - base[at[s : s + step]]
            reach[s : s + step] = self.sign * np.sqrt(np.einsum("ij,ij->i", gap, gap))
        # An equal one that comes later has the larger id.
        held = reach < self.reach[tile, -1][row]
        row, at, reach = row[held], at[held], reach[held]
        if not len(row):
            return
        hit = np.unique(row)
        old = tile.start + hit
        rows = np.concatenate([np.repeat(hit, self.k), row])
        reaches = np.concatenate([self.reach[old].ravel(), reach])
        where = np.concatenate([self.place[old].ravel(), places[at]])
        order = np.lexsort((where, reaches, rows))
        rows = rows[order]
        kept = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < self.k
        self.reach[old] = reaches[order][kept].reshape(-1, self.k)
        self.place[old] = where[order][kept].reshape(-1, self.k)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, place and distance of all that was kept, best first."""
        row, rank = np.nonzero(self.place >= 0)
        return row, self.place[row, rank], self.sign * self.reach[row, rank]


def best_of(
    queries: np.ndarray, known: Prepared, k: int, farthest: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, base position and distance of the ``k`` best base points of each query."""
    best = Best(queries, k, farthest)
    step = max(1, BLOCK_VALUES // max(1, known.points.shape[1]))
    for start in range(0, len(known.points), step):
        best.add(known.points[start : start + step])
    return best.found()


def matrix(points: pd.Series) -> np.ndarray:
    return np.stack(points.to_numpy()).astype(np.float64) if len(points) else np.empty((0, 1))


def hits_frame(
    queries: pd.DataFrame, base: pd.DataFrame | Prepared, k: int, farthest: bool
) -> pd.DataFrame:
    """Best base rows per query row, from two frames of bounded size."""
    known = base if isinstance(base, Prepared) else Prepared(*columns_of(base))
    return _hits(queries["id"].to_numpy(), matrix(queries["point"]), known, k, farthest)


def _hits(ids: np.ndarray, points: np.ndarray, known: Prepared, k: int, farthest: bool) -> pd.DataFrame:
    if not len(ids) or not len(known.ids):
        return pd.DataFrame(
            {
                "point_id": ids[:0],
                "neighbor": ids[:0],
                "neighbor_label": pd.Series(dtype="int32"),
                "distance": pd.Series(dtype="float64"),
            }
        )
    row, place, distance = best_of(points, known, k, farthest)
    return pd.DataFrame(
        {
            "point_id": ids[row],
            "neighbor": known.ids[place],
            "neighbor_label": known.labels[place].astype("int32"),
            "distance": distance,
        }
    )


def _rows(df: DataFrame, key: str, point: str, label: str | None) -> DataFrame:
    """Ids of their own type, labels and points of the rows that take part."""
    rows = df.select(
        F.col(key).alias("id"),
        (F.col(label) if label else F.lit(0)).cast("int").alias("label"),
        F.col(point).cast("array<double>").alias("point"),
    )
    infinite = F.lit(float("inf"))
    whole = F.forall("point", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return rows.where(F.col("id").isNotNull() & F.col("point").isNotNull() & whole)


def _of_width(rows: DataFrame, width: int) -> DataFrame:
    """The rows; a point of another length is an error where it is met."""
    said = F.concat(F.lit(f"a point has not {width} coordinates but "), F.size("point").cast("string"))
    return rows.withColumn("point", F.when(F.size("point") == width, F.col("point")).otherwise(F.raise_error(said)))


def _first_copies(rows: DataFrame, k: int) -> DataFrame:
    """At most ``k`` rows per distinct point, the smallest ids.

    No query can have more than ``k`` neighbours at one point. The rank filter is
    applied within each task before the shuffle, so a crowd of copies stays where it is.
    """
    window = Window.partitionBy("point").orderBy("id")
    return rows.withColumn("_r", F.row_number().over(window)).where(F.col("_r") <= k).drop("_r")


def _merge(hits: DataFrame, k: int, farthest: bool) -> DataFrame:
    """Best ``k`` of the candidates the blocks of a query came up with."""
    by = F.desc("distance") if farthest else F.asc("distance")
    window = Window.partitionBy("point_id").orderBy(by, F.asc("neighbor"))
    return hits.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _broadcast_search(queries: DataFrame, base: DataFrame, k: int, farthest: bool) -> DataFrame:
    """Every query batch against the whole base; the caller has checked the base size.

    A map over the query rows: nothing is shuffled, copies among them included.
    """
    shared = queries.sparkSession.sparkContext.broadcast(columns_of(base.toPandas()))

    def search(batches):
        known = Prepared(*shared.value)
        for batch in batches:
            # One more than asked for, since a row may find itself.
            hits = hits_frame(batch, known, k + 1, farthest)
            others = hits[hits["point_id"] != hits["neighbor"]]
            rank = others.groupby("point_id", sort=False).cumcount() + 1
            yield others.assign(rank=rank.astype("int32"))[rank <= k]

    return queries.mapInPandas(search, hit_schema(id_type(queries)) + ", rank int")


def _scan_search(queries: DataFrame, base: DataFrame, k: int, farthest: bool) -> DataFrame:
    """Few queries against any base: each task keeps its best and only those are moved."""
    asked = queries.toPandas()
    shared = queries.sparkSession.sparkContext.broadcast(columns_of(asked))

    def search(batches):
        ids, _, points = shared.value
        best = None
        for batch in batches:
            hits = _hits(ids, points, Prepared(*columns_of(batch)), k + 1, farthest)
            hits = hits[hits["point_id"] != hits["neighbor"]]
            if best is not None:
                hits = pd.concat([best, hits], ignore_index=True)
            order = ["point_id", "distance", "neighbor"]
            hits = hits.sort_values(order, ascending=[True, not farthest, True], kind="stable")
            best = hits[hits.groupby("point_id", sort=False).cumcount() < k]
        if best is not None:
            yield best

    return _merge(base.mapInPandas(search, hit_schema(id_type(queries))), k, farthest)


def _pivots(queries: DataFrame, count: int, seed: int = 17) -> np.ndarray:
    """Cell centres: query points drawn by the hash of their id."""
    picked = queries.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(count)
    return matrix(picked.toPandas()["point"])


def distances_to(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (
        np.einsum("ij,ij->i", points, points)[:, None]
        + np.einsum("ij,ij->i", pivots, pivots)[None, :]
        - 2.0 * points @ pivots.T
    )
    return np.sqrt(np.maximum(square, 0.0))


class Cells:
    """Cells around pivots: their queries, and which base points can matter to each."""

    def __init__(self, queries: DataFrame, base: DataFrame, k: int, farthest: bool, n: int) -> None:
        spark = queries.sparkSession
        self.kind, self.farthest, self.base = id_type(queries), farthest, base
        pivots = _pivots(queries, min(MOST_CELLS, max(1, ceil(n / CELL_ROWS))))
        shared = spark.sparkContext.broadcast(pivots)

        def assign(batches):
            for batch in batches:
                if len(batch):
                    gap = distances_to(matrix(batch["point"]), shared.value)
                    cell = gap.argmin(axis=1)
                    yield batch.assign(cell=cell, radius=gap[np.arange(len(batch)), cell])

        # Both sides are counted and then joined, so each is worked out once.
        self.placed = cut_lineage(
            queries.mapInPandas(assign, row_schema(self.kind) + ", cell int, radius double")
        )
        cells = self.placed.groupBy("cell").agg(
            F.max("radius").alias("radius"), F.count(F.lit(1)).alias("n")
        )

        def nearest_to_pivots(batches):
            best = None
            for batch in batches:
                if len(batch):
                    gap = distances_to(matrix(batch["point"]), shared.value)
                    gap = np.sort(-gap if farthest else gap, axis=0)[:k]
                    best = gap if best is None else np.sort(np.vstack([best, gap]), axis=0)[:k]
            if best is not None:
                cell = np.tile(np.arange(best.shape[1]), best.shape[0])
                yield pd.DataFrame({"cell": cell, "gap": best.ravel()})

        window = Window.partitionBy("cell").orderBy("gap")
        reach = (
            base.mapInPandas(nearest_to_pivots, "cell int, gap double")
            .withColumn("r", F.row_number().over(window))
            .where(F.col("r") <= k)
            .groupBy("cell")
            .agg(F.max("gap").alias("gap"))
        )
        # At most MOST_CELLS rows of cell facts.
        self.facts = {r.cell: r for r in cells.join(reach, "cell").collect()}

        # A base point is needed in a cell unless k others are surely better for all of it.
        # A small margin covers rounding in the pivot distances.
        self.live = np.array(sorted(self.facts), dtype=np.int64)
        radius = np.array([self.facts[c].radius for c in self.live])
        gap = np.array([self.facts[c].gap for c in self.live])
        self.limit = gap + 2 * radius + 1e-6 * (1.0 + np.abs(gap) + radius)
        self.pivots = pivots[self.live]
        tell = needed_by(self.pivots, self.limit, farthest)
        live = self.live

        def count(batches):
            total = np.zeros(len(live), dtype=np.int64)
            for batch in batches:
                if len(batch):
                    total += tell(matrix(batch["point"])).sum(axis=0)
            yield pd.DataFrame({"cell": live, "n": total})

        counted = base.mapInPandas(count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
        self.sizes = {r.cell: r.n for r in counted.collect() if r.n}

    def sent(self) -> DataFrame:
        """The base rows, once for each cell that needs them."""
        tell, live = needed_by(self.pivots, self.limit, self.farthest), self.live

        def send(batches):
            for batch in batches:
                if len(batch):
                    row, cell = np.nonzero(tell(matrix(batch["point"])))
                    for start in range(0, len(row), CELL_ROWS):
                        some = slice(start, start + CELL_ROWS)
                        yield batch.iloc[row[some]].assign(cell=live[cell[some]])

        return self.base.mapInPandas(send, row_schema(self.kind) + ", cell int")


def needed_by(pivots: np.ndarray, limit: np.ndarray, farthest: bool):
    """Says for points and cells whether a point can matter to a cell."""

    def tell(points: np.ndarray) -> np.ndarray:
        far = distances_to(points, pivots)
        return (-far if farthest else far) <= limit[None, :]

    return tell


def cell_traffic(queries: DataFrame, base: DataFrame, k: int, farthest: bool, n: int) -> dict[str, int]:
    """How many base rows a search by cells sends, and how many cells there are."""
    cells = Cells(queries, base, k, farthest, n)
    return {"cells": len(cells.facts), "base_rows": sum(cells.sizes.values())}


def _cell_search(
    queries: DataFrame, base: DataFrame, k: int, farthest: bool, n: int, size: int, width: int
) -> DataFrame:
    """Search by cells: exact, with no side held whole anywhere."""
    spark, kind = queries.sparkSession, id_type(queries)
    cells = Cells(queries, base, k, farthest, n)
    facts, sizes = cells.facts, cells.sizes
    blocks = spark.createDataFrame(
        [
            (int(c), ceil(facts[c].n / CELL_ROWS), ceil(sizes.get(c, 0) / BLOCK_ROWS))
            for c in facts
        ],
        "cell int, query_blocks int, base_blocks int",
    )
    own_block = F.pmod(F.xxhash64("id"), F.col("query_blocks")).cast("int").alias("query_block")
    if sum(sizes.values()) > MOST_COPIES * size:
        dealt = cells.placed.join(F.broadcast(blocks), "cell").select("cell", own_block, "id", "label", "point")
        return _block_search(dealt, base, k, farthest, n, size, width, cells)

    def spread(df: DataFrame, own: str, other: str, into: str, onto: str) -> DataFrame:
        """Own block by hash of the id, and one copy for each block of the other side."""
        sized = df.join(F.broadcast(blocks), "cell").where((F.col(own) > 0) & (F.col(other) > 0))
        return sized.withColumns(
            {
                into: F.pmod(F.xxhash64("id"), F.col(own)).cast("int"),
                onto: F.explode(F.sequence(F.lit(0), F.col(other) - 1)),
            }
        ).select("cell", into, onto, "id", "label", "point")

    left = spread(cells.placed, "query_blocks", "base_blocks", "query_block", "base_block")
    right = spread(cells.sent(), "base_blocks", "query_blocks", "base_block", "query_block")
    block = ["cell", "query_block", "base_block"]

    def search(ours, theirs):
        return hits_frame(ours, theirs, k, farthest)

    return (
        left.groupBy(*block)
        .cogroup(right.groupBy(*block))
        .applyInPandas(search, hit_schema(kind))
    )


def _packed(rows: DataFrame, most: int, by: list[str]) -> DataFrame:
    """Blocks of at most ``most`` rows that agree in ``by``: a number within the partition, the
    ids, the labels and the points as the bytes of a matrix of doubles."""
    kinds = ", ".join(f"{c} int" for c in by)
    schema = f"number int, {kinds + ', ' if by else ''}ids array<{id_type(rows)}>, labels array<int>, points binary"

    def pack(batches):
        number = 0
        for batch in batches:
            ends = {0, batch.num_rows}
            for c in by:
                values = batch.column(c).to_numpy(zero_copy_only=False)
                ends |= set((np.flatnonzero(values[1:] != values[:-1]) + 1).tolist())
            ends = sorted(ends)
            for low, high in zip(ends, ends[1:]):
                pieces = ceil((high - low) / most)
                cuts = np.linspace(low, high, pieces + 1).astype(int)
                for start, end in zip(cuts, cuts[1:]):
                    some = batch.slice(start, end - start)
                    points = some.column("point").flatten().to_numpy(zero_copy_only=False)
                    cells = [pa.array([number], pa.int32())]
                    cells += [pa.array([some.column(c)[0].as_py()], pa.int32()) for c in by]
                    cells += [one_list(some.column("id")), one_list(some.column("label"))]
                    cells.append(pa.array([points.astype(np.float64).tobytes()], pa.binary()))
                    yield pa.RecordBatch.from_arrays(cells, ["number", *by, "ids", "labels", "points"])
                    number += 1

    return cut_lineage(rows.select("id", "label", "point", *by).mapInArrow(pack, schema))


def one_list(values: pa.Array) -> pa.Array:
    values = pa.concat_arrays([values])  # without the offset of a slice
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _block_search(
    queries: DataFrame, base: DataFrame, k: int, farthest: bool, asked: int, size: int, width: int,
    cells: Cells | None = None,
) -> DataFrame:
    """Every block of queries against every block of the base, or against what its cell needs
    of it. Both sides are written once; no row is sent twice to a shuffle, and a task holds
    a block of each side and the best of its queries."""
    rows = max(1, min(CELL_ROWS, 2 * BLOCK_VALUES // width))
    by = [] if cells is None else ["cell", "query_block"]
    parts = max(1, ceil(asked / (0.9 * rows)))
    ours = queries.repartition(parts, *(by or ["id"]))
    left = _packed(ours.sortWithinPartitions(*by) if by else ours, rows, by)
    base_parts = max(1, ceil(size * width / PART_VALUES))
    # Blocks come in the order of ids, so that an earlier one wins a tie.
    theirs = base.repartition(base_parts, "id").sortWithinPartitions("id")
    right = _packed(theirs, max(1, min(BLOCK_ROWS, BLOCK_VALUES // width)), [])
    tell = None
    if cells is not None:
        pivots, limit, at = cells.pivots, cells.limit, {int(c): i for i, c in enumerate(cells.live)}
        tell = lambda cell: needed_by(pivots[at[cell]][None, :], limit[at[cell]][None], farthest)

    def search(batches):
        number = best = None

        def told():
            row, place, distance = best.found()
            place = pa.array(place)
            yield pa.RecordBatch.from_arrays(
                [
                    own_ids.take(pa.array(row)),
                    pa.concat_arrays(seen_ids).take(place),
                    pa.concat_arrays(seen_labels).take(place),
                    pa.array(distance, pa.float64()),
                ],
                ["point_id", "neighbor", "neighbor_label", "distance"],
            )

        for batch in batches:
            for i in range(batch.num_rows):
                line = batch.slice(i, 1)
                if line.column("q_number")[0].as_py() != number:
                    if best is not None:
                        yield from told()
                    number = line.column("q_number")[0].as_py()
                    own_ids = pa.concat_arrays([line.column("q_ids").flatten()])
                    best = Best(points_of(line.column("q_points"), width), k, farthest)
                    needed = tell(line.column("cell")[0].as_py()) if tell else None
                    seen_ids, seen_labels = [], []
                points = points_of(line.column("points"), width)
                seen_ids.append(pa.concat_arrays([line.column("ids").flatten()]))
                seen_labels.append(line.column("labels").flatten())
                if needed is None:
                    best.add(points)
                else:
                    some = np.flatnonzero(needed(points)[:, 0])
                    best.add(points[some], best.seen + some)
                    best.seen += len(points)
        if best is not None:
            yield from told()

    renamed = left.select(
        F.col("number").alias("q_number"), *by[:1], F.col("ids").alias("q_ids"), F.col("points").alias("q_points")
    )
    met = renamed.hint("shuffle_replicate_nl").join(right.select("ids", "labels", "points"), how="cross")
    return met.mapInArrow(search, hit_schema(id_type(queries)))


def points_of(cell: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(cell[0].as_buffer(), dtype=np.float64).reshape(-1, width)


def bounded_candidates(
    queries: DataFrame, base: DataFrame, k: int, farthest: bool, asked: int, size: int, width: int
) -> DataFrame:
    """Search by bounds: the ``k`` best pairs of each query and part of the base."""
    return _block_search(queries, base, k, farthest, asked, size, width)


def _ids_repeat(rows: DataFrame) -> bool:
    return not rows.groupBy("id").count().where("count > 1").isEmpty()


def _wide_search(
    queries: DataFrame, base: DataFrame, k: int, farthest: bool, asked: int, size: int, width: int
) -> DataFrame:
    """Search by bounds. Where ids repeat, a pair of ids stands for all rows that have them."""
    found = bounded_candidates(queries, base, k, farthest, asked, size, width)
    if not (_ids_repeat(base) or _ids_repeat(queries)):
        return found
    ends = base.select(F.col("id").alias("neighbor"), F.col("label").alias("neighbor_label"), F.col("point").alias("b"))
    starts = queries.select(F.col("id").alias("point_id"), F.col("point").alias("a"))

    def measure(batches):
        for batch in batches:
            if len(batch):
                gap = matrix(batch["a"]) - matrix(batch["b"])
                distance = np.sqrt(np.einsum("ij,ij->i", gap, gap))
                yield batch[["point_id", "neighbor", "neighbor_label"]].assign(distance=distance)

    pairs = found.select("point_id", "neighbor").join(ends, "neighbor").join(starts, "point_id")
    return pairs.mapInPandas(measure, hit_schema(id_type(queries)))


def knn(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    key: str,
    point: str,
    label: str | None = None,
    farthest: bool = False,
    broadcast_values: int = BROADCAST_VALUES,
    narrow: int | None = None,
) -> DataFrame:
    """``(key, neighbor, neighbor_label, distance, rank)``, ``k`` rows per query row.

    A row is never its own neighbour. Ids keep their type. Rows without an id or a point, and
    points with a null, NaN or infinity, take no part; points of different lengths are an error.
    ``broadcast_values`` bounds the coordinates that a broadcast side may hold; where both
    sides are larger, the search goes by cells or, beyond ``narrow`` coordinates, by bounds.
    """
    asked = _rows(queries, key, point, label)
    known = _rows(base, key, point, label)
    stats = known.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("point")).alias("low"), F.max(F.size("point")).alias("d")
    ).first()
    size, width = stats.n, stats.d or 0
    if stats.low != stats.d:
        raise ValueError(f"points have from {stats.low} to {stats.d} coordinates")
    if size:
        asked = _of_width(asked, width)
    if size * width > broadcast_values:
        few = broadcast_values // max(1, width)
        if few and asked.limit(few + 1).count() <= few:
            hits = _scan_search(cut_lineage(asked), known, k, farthest)
            return hits.withColumnRenamed("point_id", key)
        # One copy more than neighbours asked for, since a row finds itself. Both sides
        # are read several times below; their folding shuffles run once.
        known = cut_lineage(_first_copies(known, k + 1))
        size = known.count()
    if size * width <= broadcast_values:
        hits = _broadcast_search(asked, known, k, farthest)
        return hits.withColumnRenamed("point_id", key)

    points = asked.groupBy("point").agg(F.min("id").alias("id"))
    points = cut_lineage(points.select("id", F.lit(0).alias("label"), "point"))
    count = points.count()
    if width > (NARROW if narrow is None else narrow):
        found = _wide_search(points, known, k + 1, farthest, count, size, width)
    else:
        found = _cell_search(points, known, k + 1, farthest, count, size, width)
    # Back from distinct points to rows, one row per point on the right-hand side.
    lists = (
        _merge(found, k + 1, farthest)
        .groupBy("point_id")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        (F.col("distance") * (-1 if farthest else 1)).alias("order"),
                        "neighbor",
                        "neighbor_label",
                    )
                )
            ).alias("hits")
        )
    )
    of_point = points.select(F.col("id").alias("point_id"), "point").join(lists, "point_id")
    own = asked.select("id", "point").join(of_point, "point")
    others = F.slice(F.filter("hits", lambda h: h["neighbor"] != F.col("id")), 1, k)
    return own.select("id", F.posexplode(others).alias("place", "hit")).select(
        F.col("id").alias(key),
        F.col("hit.neighbor").alias("neighbor"),
        F.col("hit.neighbor_label").alias("neighbor_label"),
        F.abs("hit.order").alias("distance"),
        (F.col("place") + 1).alias("rank"),
    )
