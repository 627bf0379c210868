"""A uniform shuffle of documents into shards of exact size, in DataFrame operations alone.

Method: rows lie in blocks (by a hash of the row and its place in the written table, so equal
rows lie apart). How many rows of each block go to each
shard is drawn first, exactly as a uniform shuffle would have it: the matrix of counts with
the block sizes and the shard sizes as its sums is multivariate hypergeometric. Each block
is then permuted and cut by its row of the matrix, the rows are exchanged, and each shard is
permuted again. Every order of all rows is equally likely (up to the hash), every shard size
is exact: no two differ by more than one.

The matrix is drawn by halving: all blocks together have the shard sizes as their counts;
whenever a range of blocks is cut in two, the left half draws its counts without replacement
from those of the range, shard after shard. Every draw inverts the hypergeometric
distribution function, summed outwards from its mode over 12 standard deviations and more on
either side, beyond which a double holds nothing. The random numbers are hashes of seed,
range and shard, so a task that is run again draws the same.

Scale: texts are read once, for their size and checksum, and never shuffled. A block holds
about ``BLOCK`` rows and a shard is permuted in buckets of about as many, so no task sorts a
whole shard. The matrix has one row per block and is made in one narrow pass per level.

Defined cases: a null text has no bytes (its checksum is that of the empty text); a null id
is a row like any other; repeated rows are all kept and spread like others; an empty table gives no rows; with fewer rows than shards some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from caseloom.session import cut_lineage

BLOCK = 4096
SEED = 20_240_607
MIXED = "array<bigint>"


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 53 random bits, from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _outwards(mode: Column, stop: Column, step: int, total, population, ours, draws) -> Column:
    """Walks from the mode to ``stop`` with the weight of each count, the mode's being 1.

    ``total`` is the sum before the first step and a target; the walk remembers the first
    count at which the sum passes the target (-1: none).
    """
    population, ours, draws = (c.cast("double") for c in (population, ours, draws))

    def walk(acc: Column, k: Column) -> Column:
        k = k.cast("double")
        up = (ours - k + 1) * (draws - k + 1) / (k * (population - ours - draws + k))
        down = (k + 1) * (population - ours - draws + k + 1) / ((ours - k) * (draws - k))
        weight = acc["weight"] * (up if step > 0 else down)
        sum_ = acc["sum"] + weight
        hit = (acc["at"] < 0) & (sum_ > acc["target"])
        return F.struct(
            weight.alias("weight"),
            sum_.alias("sum"),
            F.when(hit, k.cast("long")).otherwise(acc["at"]).alias("at"),
            acc["target"].alias("target"),
        )

    start, target = total
    first = F.struct(
        F.lit(1.0).alias("weight"), start.alias("sum"), F.lit(-1).cast("long").alias("at"), target.alias("target")
    )
    none = F.array().cast(MIXED)
    counts = F.when(
        (stop >= mode + 1) if step > 0 else (stop <= mode - 1), F.sequence(mode + F.lit(step), stop, F.lit(step).cast("long"))
    ).otherwise(none)
    return F.aggregate(counts, first, walk)


def hypergeometric(u: Column, population: Column, ours: Column, draws: Column) -> Column:
    """How many of ``draws`` out of ``population`` fall on ``ours``, for a uniform ``u``."""
    low = F.greatest(F.lit(0).cast("long"), draws + ours - population)
    high = F.least(draws, ours)
    p, n = ours.cast("double") / population, population.cast("double")
    spread = F.sqrt(F.greatest(F.lit(0.0), draws * p * (1 - p) * (n - draws) / F.greatest(n - 1, F.lit(1.0))))
    width = (F.ceil(spread * 12) + 30).cast("long")
    mode = F.floor((draws + 1).cast("double") * (ours + 1) / (population + 2)).cast("long")
    facts = F.struct(
        F.least(F.greatest(mode, low), high).alias("mode"), low.alias("low"), high.alias("high"), width.alias("width"),
        population.alias("population"), ours.alias("ours"), draws.alias("draws"), u.alias("u"),
    )

    def draw(f: Column) -> Column:
        mode, stop_up = f["mode"], F.least(f["high"], f["mode"] + f["width"])
        stop_down = F.greatest(f["low"], f["mode"] - f["width"])
        rest = f["population"], f["ours"], f["draws"]
        never = F.lit(float("inf"))
        up = _outwards(mode, stop_up, 1, (F.lit(0.0), never), *rest)["sum"]
        down = _outwards(mode, stop_down, -1, (F.lit(0.0), never), *rest)["sum"]
        sums = F.struct(up.alias("up"), down.alias("down"))

        def pick(s: Column) -> Column:
            target = f["u"] * (1 + s["up"] + s["down"])
            above = _outwards(mode, stop_up, 1, (F.lit(1.0), target), *rest)["at"]
            below = _outwards(mode, stop_down, -1, (1 + s["up"], target), *rest)["at"]
            return (
                F.when(target < 1, mode)
                .when(target < 1 + s["up"], F.greatest(above, F.lit(0).cast("long")))
                .otherwise(F.when(below < 0, mode).otherwise(below))
            )

        return let(sums, pick)

    return F.when(low >= high, high).otherwise(let(facts, draw))


def split_counts(counts: Column, left: Column, name: Column, seed: int) -> Column:
    """Counts per shard of ``left`` rows drawn without replacement from ``counts``."""
    none = F.array().cast(MIXED)
    start = F.struct(
        F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x).alias("population"),
        left.cast("long").alias("draws"),
        none.alias("out"),
    )

    def step(acc: Column, c: Column) -> Column:
        u = uniform(F.lit(seed), name, F.size(acc["out"]))
        drawn = hypergeometric(u, acc["population"], c, acc["draws"])
        return let(
            drawn,
            lambda x: F.struct(
                (acc["population"] - c).alias("population"),
                (acc["draws"] - x).alias("draws"),
                F.concat(acc["out"], F.array(x)).alias("out"),
            ),
        )

    return F.aggregate(counts, start, step)["out"]


def matrix(sizes: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``block``, ``counts`` (one per shard) from ``block`` (0, 1, ...) and its ``size``."""
    facts = sizes.agg(F.sum("size"), F.count("*")).first()
    rows, blocks = facts[0] or 0, facts[1]
    levels = max(0, blocks - 1).bit_length()
    prefix = sizes.select(
        "block", (F.sum("size").over(Window.orderBy("block")) - F.col("size")).alias("before")
    )
    edges = cut_lineage(
        prefix.unionByName(prefix.sparkSession.range(1).select(F.lit(blocks).cast("long").alias("block"), F.lit(rows).cast("long").alias("before")))
    )
    shard_sizes = [rows // shards + (s < rows % shards) for s in range(shards)]
    nodes = sizes.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("first"),
        F.lit(1 << levels).cast("long").alias("width"),
        F.array(*[F.lit(s).cast("long") for s in shard_sizes]).alias("counts"),
    )
    for _ in range(levels):
        middle = F.least(F.col("first") + F.col("width") / 2, F.lit(blocks)).cast("long")
        near = nodes.withColumn("middle", middle)
        at_first = edges.select(F.col("block").alias("first"), F.col("before").alias("from_row"))
        at_middle = edges.select(F.col("block").alias("middle"), F.col("before").alias("to_row"))
        halves = near.join(at_first, "first").join(at_middle, "middle").withColumn(
            "left", split_counts(F.col("counts"), F.col("to_row") - F.col("from_row"), F.struct("first", "width"), seed)
        )
        right = F.transform(F.arrays_zip("counts", "left"), lambda z: z["counts"] - z["left"])
        half = (F.col("width") / 2).cast("long").alias("width")
        nodes = cut_lineage(
            halves.select(
                F.explode(
                    F.array(
                        F.struct(F.col("first"), half, F.col("left").alias("counts")),
                        F.struct(F.col("middle").alias("first"), half, right.alias("counts")),
                    )
                ).alias("n")
            )
            .select("n.*")
            .where(F.col("first") < blocks)
        )
    return nodes.select(F.col("first").alias("block"), "counts")


def shuffle(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, block: int = BLOCK
) -> DataFrame:
    """``id``, ``size``, ``crc``, ``shard`` and ``slot`` (0, 1, ... within a shard)."""
    content = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(content) + F.lit(16)).cast("long").alias("size"),
        F.crc32(content).alias("crc"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("content_key"),
    )
    # a number for each row of the written table keeps equal rows apart in all three draws
    rows = cut_lineage(rows).withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("id", "size", "crc", F.xxhash64("content_key", "row").alias("key"), "row")
    total = rows.count()
    blocks = max(1, -(-total // block))
    tie = [F.col("key"), F.col("row")]
    mixed = F.xxhash64(F.lit(seed + 1), "key")
    order = Window.partitionBy("block").orderBy("mixed", *tie)
    placed = rows.select("*", F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), mixed.alias("mixed"))
    held = placed.groupBy("block").agg(F.count("*").alias("size"))
    sizes = rows.sparkSession.range(blocks).select(F.col("id").alias("block")).join(held, "block", "left")
    sizes = cut_lineage(sizes.select("block", F.coalesce("size", F.lit(0).cast("long")).alias("size")))
    ends = matrix(sizes, shards, seed).select(
        "block",
        F.aggregate(
            "counts",
            F.array(F.lit(0).cast("long")),
            lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + c)),
        ).alias("ends"),
    )
    numbered = placed.withColumn("rank", F.row_number().over(order)).join(ends, "block")
    # the first shard whose rows of this block end at or behind the rank
    sent = numbered.select(
        "id", "size", "crc", "key", "row",
        F.size(F.filter(F.slice("ends", 2, shards), lambda e: e < F.col("rank"))).alias("shard"),
        F.xxhash64(F.lit(seed + 2), "key", "block").alias("again"),
    )
    buckets = max(1, -(-total // (shards * block)))
    width = F.lit(2.0**53 / buckets)
    sent = cut_lineage(
        sent.withColumn("bucket", F.floor(F.shiftrightunsigned("again", 11).cast("double") / width).cast("int"))
    )
    before = sent.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = before.select(
        "shard", "bucket",
        (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"),
    )
    within = Window.partitionBy("shard", "bucket").orderBy(F.shiftrightunsigned("again", 11), "again", *tie)
    return (
        sent.withColumn("place", F.row_number().over(within) - 1)
        .join(before, ["shard", "bucket"])
        .select("id", "size", "crc", "shard", (F.col("before") + F.col("place")).cast("long").alias("slot"))
    )
