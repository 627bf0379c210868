"""Hot words, cells, rows and long disguises: the same results, in bounded memory, spread over tasks."""

from __future__ import annotations

import random
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from caseloom.llm import contamination, pii, sharding, simhash

# contamination


def segment(texts):
    """The arguments of a search in a segment of these texts."""
    terms = contamination.Terms()
    words = [np.array([terms[w] for w in t.encode().split()], dtype=np.int32) for t in texts]
    import pyarrow as pa

    row = contamination._segment_row(0, [pa.array([i]) for i in range(len(texts))], words, terms).to_pydict()
    return len(texts), np.array(row["lengths"][0], dtype=np.int32), row["terms"][0], row["counts"][0], row["postings"][0]


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_pieces_of_candidates_change_nothing(monkeypatch, slop):
    random.seed(slop)
    words = ["a", "b", "c", "d"]
    texts = [" ".join(random.choices(words, k=random.randint(0, 40))) for _ in range(30)]
    items = [(str(i), " ".join(random.choices(words, k=random.randint(1, 12))).encode()) for i in range(40)]
    phrases = contamination.Phrases(items, 6)
    whole = contamination._search_segment(*segment(texts), phrases, slop)
    monkeypatch.setattr(contamination, "CANDIDATES", 7)
    pieces = contamination._search_segment(*segment(texts), phrases, slop)
    assert {d: (sorted(zip(s[::2], s[1::2])), e, n) for d, (s, e, n) in whole.items()} == {
        d: (sorted(zip(s[::2], s[1::2])), e, n) for d, (s, e, n) in pieces.items()
    }
    for d, text in enumerate(texts):
        want = {i for i, item in items if slop and brute.near(text, item.decode(), slop, 6)}
        assert whole.get(d, ([], set(), set()))[2] == want


def test_common_words_stay_in_bounds(monkeypatch):
    random.seed(0)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(random.choices(words, k=1000)) for _ in range(100)]
    items = [("x", " ".join(random.choices(words, k=4000)).encode())]
    held = segment(texts)
    seen = []
    true = contamination.candidates

    def watched(*args):
        for window, start in true(*args):
            seen.append(len(window))
            yield window, start

    monkeypatch.setattr(contamination, "candidates", watched)
    monkeypatch.setattr(contamination, "CANDIDATES", 50_000)
    tracemalloc.start()
    contamination._search_segment(*held, contamination.Phrases(items, 10), 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(seen) > 5_000_000 and max(seen) == 50_000
    assert peak < 60 << 20  # all at once would take some 500 MB


def test_windows_do_not_reach_into_the_next_list(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c " * 60)], "doc_id long, text string")
    items = spark.createDataFrame([("i", "b " + "z " * 58 + "c")], "item_id string, text string")
    assert contamination.mark(docs, items, window=60, slop=3).where("n_hit > 0 or size(near) > 0").count() == 0


# personal data


@pytest.mark.parametrize("at", [" at ", " AT ", "@", " [at] "])
def test_addresses_of_any_number_of_parts(at):
    random.seed(len(at))
    for parts in [1, 2, 3, 5, 6, 7, 12, 30]:
        for _ in range(6):
            dots = [" dot ", " doT ", " DOT ", "."]
            name = "".join(x + random.choice(dots) for x in ["ab", "c", "d_e", "f9"] * 8)[:0] or random.choice(dots).join(
                random.choice(["ab", "c", "d", "f9"]) for _ in range(parts)
            )
            host = "mail" + "".join(f" dot {random.choice(['xy', 'z', 'com'])}" for _ in range(random.randint(1, parts)))
            text = f"write to {name}{at}{host}, please"
            assert pii.masked(text) == "write to [EMAIL], please", text


def test_probed_texts():
    assert pii.masked("a dot b dot c dot d dot e dot f at mail dot com") == "[EMAIL]"
    assert pii.masked("joe at one dot two dot three dot four dot five dot six dot com") == "[EMAIL]"
    assert pii.masked("j.r.r.t.k.x.y at mail dot com") == "[EMAIL]"
    assert pii.masked("joe at mail doT com") == "[EMAIL]"
    assert pii.masked("10 doT 0 doT 0 doT 1") == "[IP]"
    assert pii.masked("0192 dot 168 dot 0 dot 1") == "[IP]"
    assert pii.masked("look at the dot com boom") == "look at the dot com boom"


def test_long_disguises_take_linear_time():
    def seconds(text):
        begun = time.perf_counter()
        pii.all_spans(text)
        return time.perf_counter() - begun

    for piece in ("a dot ", "a dot b at ", "x.", "1 dot ", "at dot ", "a_"):
        short, long = (min(seconds(piece * n) for _ in range(2)) for n in (20_000, 80_000))
        assert long < 12 * short + 0.5, piece


# near-duplicates


def test_a_busy_cell_goes_to_all_tasks(spark):
    # four set bits in each of four parts: one cell
    random.seed(2)
    found = set()
    while len(found) < 12_000:
        found.add(sum(sum(1 << b for b in random.sample(range(16), 4)) << 16 * p for p in range(4)))
        if len(found) % 3 == 0:  # one with a bit of one part moved, and so within the radius
            near = random.choice(list(found)[:50])
            part = 16 * random.randrange(4)
            bits = [part + b for b in range(16)]
            on = random.choice([b for b in bits if near >> b & 1])
            off = random.choice([b for b in bits if not near >> b & 1])
            found.add(near & ~(1 << on) | 1 << off)
    values = [(v - (1 << 64) if v >> 63 else v,) for v in found]
    fps = spark.createDataFrame(values, "fp long")
    links = simhash.links_within(fps, tile=1000)
    per_task = [r["n"] for r in links.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(per_task) >= 6 and max(per_task) < 0.5 * sum(per_task)
    array = np.array([v for v, in values], dtype=np.int64).view(np.uint64)
    parent = list(range(len(array)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(array)):
        for j in np.flatnonzero(np.bitwise_count(array[i] ^ array[i + 1 :]) <= 2) + i + 1:
            parent[root(i)] = root(int(j))
    want = {}
    for i, (v,) in enumerate(values):
        want.setdefault(root(i), []).append(v)
    want = {frozenset(own) for own in want.values() if len(own) > 1}
    got = {}
    for r in simhash.components(links).collect():
        got.setdefault(r["root"], [r["root"]]).append(r["node"])
    assert {frozenset(own) for own in got.values()} == want


# sharding


def test_equal_rows_are_shuffled_like_others(spark):
    rows, shards = 30_000, 10
    docs = spark.range(rows).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).otherwise("the same").alias("text"),
    )  # a third of all rows are equal
    out = sharding.shuffle(docs.repartition(4), shards, block=1000).cache()
    sizes = out.groupBy("shard").agg(F.count("*").alias("n"), F.count_if(F.col("id").isNull()).alias("equal")).collect()
    assert len(sizes) == shards and {r["n"] for r in sizes} == {rows // shards}
    mean = rows / 3 / shards
    chi = sum((r["equal"] - mean) ** 2 / mean for r in sizes)
    assert chi < 33  # nine degrees of freedom: 1 in 10,000
    # within a shard they stand everywhere, too
    slots = out.where("id is null").groupBy(F.floor(F.col("slot") / 300).alias("s")).count().collect()
    assert len(slots) == 10 and sum((r["count"] - 1000) ** 2 / 1000 for r in slots) < 33
    assert out.select("shard", "slot").distinct().count() == rows


def test_blocks_stay_small_with_equal_rows(spark, monkeypatch):
    docs = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    seen = []
    true = sharding.matrix

    def watched(sizes, *rest):
        seen.extend(r["size"] for r in sizes.collect())
        return true(sizes, *rest)

    monkeypatch.setattr(sharding, "matrix", watched)
    assert sharding.shuffle(docs, 7, block=1000).groupBy("shard").count().count() == 7
    assert len(seen) == 20 and sum(seen) == 20_000 and max(seen) < 2 * 1000 and min(seen) > 500
