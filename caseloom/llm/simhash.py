"""Near-duplicate documents by SimHash.

Method: a fingerprint per text (each of its 64 bits is the majority of that bit over the
hashes of all word shingles), then an exact comparison of distinct fingerprints, tile
against tile, with exclusive-or and bit counts. A fingerprint lies in the tile of its
population counts: one count for each of ``PARTS`` equal parts of the 64 bits. Two
fingerprints within the radius differ in each part by no more bits than they differ in
all, so a pair of tiles whose counts are further apart than the radius is never formed.

Scale: the texts never move; the comparison works on distinct fingerprints, so a group of
copies is one row whatever its size. A tile holds at most ``TILE`` fingerprints (a busier
cell has more tiles). A pair of tiles has a key of its own, so the pairs of one cell go to all
tasks. A tile pair hands on a spanning forest of its links, not all of them,
which leaves every component as it is. Components come from repeated minimum joins on the
links, with lineage cut each round.

Defined cases: a null or empty text, or one of white space alone, has fingerprint 0 and
is linked like any other; a text of fewer words than a shingle is one shingle; repeated
rows get one result row each; a null id is never the smallest, and a component of null
ids alone has a null ``component_id``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from caseloom.llm.arrow import as_bytes, free_name, map_batches
from caseloom.session import cut_lineage

PARTS = 4
TILE = 8192
SEED = 42


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """The majority of each bit over the XXH64 of all shingles, repeats included."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    runs = zip(*(tokens[i:] for i in range(words))) if len(tokens) >= words else [tokens]
    digest, join = xxhash.xxh64_digest, b" ".join
    hashes = b"".join([digest(join(run), SEED) for run in runs])
    votes = np.zeros(64, dtype=np.int64)
    table = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8)
    for start in range(0, len(table), 1 << 16):
        votes += np.unpackbits(table[start : start + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(table)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3
) -> DataFrame:
    """``id``, ``fp``: one row per row of ``docs``; ``fp`` holds the 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, words) for text in as_bytes(batch.column(1))]
            bits = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), bits], ["id", "fp"])

    kind = dict(docs.dtypes)[id_col]
    return map_batches(docs.select(id_col, text_col), run, f"id {kind}, fp long")


def cell_offsets(radius: int, parts: int) -> list[tuple[int, ...]]:
    """Count differences of at most ``radius`` in all; one of each pair of opposites."""
    found = {(0,) * parts}
    for _ in range(radius):
        found |= {
            tuple(v + step * (i == at) for i, v in enumerate(offset))
            for offset in found
            for at in range(parts)
            for step in (-1, 1)
        }
    return sorted(o for o in found if o >= (0,) * parts)


def forest(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """Links of a spanning forest of the pairs within ``radius`` of two tiles."""
    parent = np.arange(len(left) + (0 if same else len(right)))
    shift = 0 if same else len(left)
    links = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    rows = max(1, (1 << 19) // max(1, len(right)))
    for start in range(0, len(left), rows):
        block = left[start : start + rows, None]
        near = np.bitwise_count(block ^ right[None, :]) <= radius
        if same:
            near &= np.arange(len(right))[None, :] > np.arange(start, start + len(block))[:, None]
        i, j = np.nonzero(near)
        while len(i) and (parent != parent[parent]).any():
            parent = parent[parent]
        apart = parent[start + i] != parent[shift + j]
        for i, j in zip(i[apart].tolist(), j[apart].tolist()):
            a, b = root(start + i), root(shift + j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((start + i, j))
    return links


def _tile_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                left = batch.column(0)[i].values.to_numpy().view(np.uint64)
                right = batch.column(1)[i].values.to_numpy().view(np.uint64)
                links = forest(left, right, radius, batch.column(2)[i].as_py())
                if links:
                    at = np.array(links)
                    ends = [pa.array(left[at[:, 0]].view(np.int64)), pa.array(right[at[:, 1]].view(np.int64))]
                    yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    return run


def links_within(fps: DataFrame, radius: int = 2, parts: int = PARTS, tile: int = TILE) -> DataFrame:
    """``a``, ``b``: links that join the same components as all pairs within ``radius``.

    ``fps`` has distinct values in its column ``fp``.
    """
    width = 64 // parts
    counts = [
        F.bit_count(F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << width) - 1)))
        for i in range(parts)
    ]
    placed = fps.select("fp", F.array(*counts).alias("cell"))
    per_cell = placed.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks"))
    tiles = cut_lineage(
        placed.join(per_cell, "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), "blocks").alias("block"))
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    )

    def moved(offset: tuple[int, ...]) -> Column:
        return F.array(*[F.col("cell")[i] + F.lit(v) for i, v in enumerate(offset)])

    # names of pairs first; tiles are brought to a pair by its whole name, so those of one
    # cell are dealt out to all tasks
    here = tiles.select("cell", "block")
    outgoing = here.select(
        F.col("cell").alias("home"),
        F.col("block").alias("from_block"),
        F.explode(F.array(*[moved(o) for o in cell_offsets(radius, parts)])).alias("cell"),
    )
    same_cell = F.col("home") == F.col("cell")
    name = ["home", "from_block", "cell", "block"]
    names = cut_lineage(
        outgoing.join(here, "cell").where(~same_cell | (F.col("from_block") <= F.col("block"))).select(*name)
    )
    left = names.join(tiles.select(F.col("cell").alias("home"), F.col("block").alias("from_block"), F.col("fps").alias("left")), name[:2])
    right = names.join(tiles.select("cell", "block", F.col("fps").alias("right")), name[2:])
    same = same_cell & (F.col("from_block") == F.col("block"))
    # a pair is little to move but much to do: as many tasks as there may be, not as bytes ask for
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = left.repartition(tasks, *name).join(right.repartition(tasks, *name), name)
    pairs = pairs.select("left", "right", same.alias("same"))
    return map_batches(pairs, _tile_links(radius), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest reachable node of every node that has a link.

    Alternates two steps until nothing changes: each node's larger neighbours are linked
    to its smallest neighbour, then each node's smaller neighbours are. Every step is one
    grouped minimum and one join, and the number of links never grows.
    """
    edges = cut_lineage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        edges = cut_lineage(small.select("e.*").where("u <> v").distinct())
        facts = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")
        ).first()
        if facts == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = facts


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """``id``, ``fp`` and ``component``, the smallest id of the texts reachable by links."""
    marked = cut_lineage(fingerprints(docs, id_col, text_col, words))
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("id").alias("smallest")))
    roots = components(links_within(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("smallest").alias("component"))
    of_fp = cut_lineage(rooted.join(named, "root").select("fp", "component"))
    return marked.join(of_fp, "fp").select("id", "fp", "component")


def row_name(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """Names a row by id and text; null ids come last in its order."""
    return F.struct(
        F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key")
    )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """One row of each component: that of the smallest id. All columns of ``docs`` stay.

    Rows are told apart by id and text, so an id with several texts may stay several times,
    once for each group it leads; of rows equal in both one stays.
    """
    named = docs.select(row_name(docs, id_col, text_col).alias("row"), text_col)
    leaders = near_duplicates(named, "row", text_col, words, radius).select("component.*").distinct()
    # one name without nulls on both sides, so that the rows move once for both steps
    key = free_name(docs, "key")
    named = F.concat_ws("|", F.col("text_key").cast("string"), F.col("id").cast("string"), F.col("id").isNull().cast("string"))
    leaders = leaders.select(named.alias(key))
    text_key, own_id = F.xxhash64(text_col).cast("string"), F.col(id_col).cast("string")
    keyed = docs.withColumn(key, F.concat_ws("|", text_key, own_id, F.col(id_col).isNull().cast("string")))
    return keyed.join(leaders, key, "left_semi").dropDuplicates([key]).drop(key)


def fingerprint_hex() -> Column:
    return F.lower(F.lpad(F.hex("fp"), 16, "0"))
