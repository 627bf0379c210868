"""The best documents for each query text, by no-random-access (NRA) reads of an inverted index.

Method: the documents are cut into segments, and each segment stores its postings. For a
query every term's postings are read in the order of their impact (what the term adds to a
document's score), the highest first, all lists side by side. A document met so far has a
lower bound, what was read of it, and an upper bound, which adds for every list in which it
was not met the impact at which that list now stands. Reading goes on until no other
document can come among the best ``k``, the order among them holds, ties by id included, and
their scores are whole. No list is ever asked for a certain document.

Scores are whole numbers. With N documents that have a term, L terms in all of them, n terms
in a document, df documents with a term and tf occurrences of it in a document:
``w = floor(1000 * ln((2N+2) / (2df+1)))``, ``m = 75 + 25*n*N div L`` and
``w * (1000000000*tf div (1000*tf + 12*m))``, summed over the query's terms, repeats included.

Scale: an index segment is made by one task and holds about ``SEGMENT_TOKENS`` terms of
whole documents, so no task holds more whatever the partition, and no text moves. Queries
are broadcast in blocks of at most about ``BLOCK_BYTES`` of text (measured, copies removed);
a larger query table means more passes over the index, never a larger broadcast. Each task
hands on at most ``k`` documents a query, having raised its threshold from segment to
segment. No group has a frequent term, a copied text or a hot document as its key.

Defined cases: null texts have no terms; a document without terms counts neither in N nor in
results; a query without terms, or whose terms no document has, gets no rows; equal rows of
the query table are one query, an id with different texts is several; equal rows of the
documents are several documents; null document ids come last among ties; empty tables give
no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from caseloom.llm.arrow import as_bytes, map_batches
from caseloom.llm.contamination import Terms, pack, unpack, words_of
from caseloom.session import cut_lineage

SEGMENT_TOKENS = 2_000_000
BLOCK_BYTES = 1 << 20
#: Postings read of each list in the first round; every further round reads four times as many.
FIRST_READ = 256


def _segment(ids: list[pa.Array], words: list[np.ndarray], terms: Terms) -> pa.RecordBatch:
    """One row: documents in the order of their ids, postings term after term."""
    ids = pa.concat_arrays(ids)
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy().astype(np.int64)
    words = [words[i] for i in order.tolist()]
    lengths = np.fromiter(map(len, words), dtype=np.int32, count=len(words))
    keys = np.concatenate(words).astype(np.int64) << 32 | np.repeat(np.arange(len(words)), lengths)
    keys, times = np.unique(keys, return_counts=True)
    counts = np.bincount(keys >> 32, minlength=len(terms)).astype(np.int32)
    docs = keys & 0xFFFFFFFF
    gaps = np.diff(docs, prepend=0)
    first = (np.cumsum(counts) - counts)[counts > 0]
    gaps[first] = docs[first]
    return pa.RecordBatch.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))),
            pa.array([lengths.tobytes()], pa.binary()),
            pa.array([b" ".join(terms)], pa.binary()),
            pa.array([counts.tobytes()], pa.binary()),
            pa.array([pack(gaps)], pa.binary()),
            pa.array([pack(times)], pa.binary()),
            pa.array([int((lengths > 0).sum())], pa.int64()),
            pa.array([int(lengths.sum(dtype=np.int64))], pa.int64()),
        ],
        ["ids", "lengths", "terms", "counts", "docs", "times", "n_docs", "n_words"],
    )


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS
) -> DataFrame:
    """The postings of every term: one row per segment of whole documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, terms, held = [], [], Terms(), 0
        for batch in batches:
            for i, text in enumerate(as_bytes(batch.column(1))):
                found = words_of(text)
                if ids and held + len(found) > segment_tokens:
                    yield _segment(ids, words, terms)
                    ids, words, terms, held = [], [], Terms(), 0
                words.append(np.fromiter(map(terms.__getitem__, found), np.int32, len(found)))
                ids.append(batch.column(0).slice(i, 1))
                held += len(found) + 1
        if ids:
            yield _segment(ids, words, terms)

    kind = dict(docs.dtypes)[id_col]
    schema = (
        f"ids array<{kind}>, lengths binary, terms binary, counts binary, docs binary, times binary, "
        "n_docs long, n_words long"
    )
    return map_batches(docs.select(id_col, text_col), run, schema)


class Queries:
    """The queries of one block: for each its id and its terms with their repeats."""

    def __init__(self, items: list[tuple[object, bytes]]) -> None:
        terms = Terms()
        self.items = []
        for name, text in items:
            repeats = Counter(terms[w] for w in words_of(text))
            self.items.append(
                (name, np.fromiter(repeats, np.int64, len(repeats)), np.fromiter(repeats.values(), np.int64, len(repeats)))
            )
        self.terms = list(terms)


class Segment:
    """The postings of one segment that a block of queries needs."""

    def __init__(self, row: dict, terms: list[bytes]) -> None:
        number = dict(zip(row["terms"].as_py().split(b" "), range(1 << 62)))
        local = np.array([number.get(t, -1) for t in terms], dtype=np.int64)
        del number
        self.lengths = np.frombuffer(row["lengths"].as_py(), dtype=np.int32).astype(np.int64)
        counts = np.frombuffer(row["counts"].as_py(), dtype=np.int32).astype(np.int64)
        self.df = np.where(local >= 0, counts[local] if len(counts) else 0, 0)
        self.row, self.local, self.counts = row, local, counts

    def lists(self, m: np.ndarray, w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """For each term its documents and impacts, in falling order of impact, ties by document."""
        counts = self.counts
        ends = np.cumsum(counts)
        steps, times = unpack(self.row["docs"].as_py()), unpack(self.row["times"].as_py())
        walked = np.cumsum(steps)
        found: list[tuple[np.ndarray, np.ndarray] | None] = []
        for term, (at, size) in enumerate(zip(self.local.tolist(), self.df.tolist())):
            if at < 0 or not size or not w[term]:
                found.append(None)
                continue
            part = slice(int(ends[at] - size), int(ends[at]))
            docs = walked[part] - (walked[part.start] - steps[part.start])
            tf = times[part]
            impact = w[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[docs]))
            order = np.argsort(-impact, kind="stable")
            found.append((docs[order], impact[order]))
        return found


def nra(
    lists: list[tuple[np.ndarray, np.ndarray]], count: int, k: int, threshold: int = 0, first: int = FIRST_READ
) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``k`` best documents, their scores, and how many postings were read.

    ``lists`` hold documents (below ``count``) and impacts in falling order. Documents that
    score 0, or less than ``threshold``, are left out. Equal scores are in the order of the
    documents' numbers.
    """
    lower = np.zeros(count, dtype=np.int64)
    read_docs: list[np.ndarray] = []
    read_lists: list[np.ndarray] = []
    stands = np.array([impact[0] for _, impact in lists], dtype=np.int64)
    depth, size, reads = 0, first, 0
    while True:
        for i, (docs, impact) in enumerate(lists):
            if depth < len(docs):
                some = docs[depth : depth + size]
                lower[some] += impact[depth : depth + size]  # a list has a document once
                read_docs.append(some)
                read_lists.append(np.full(len(some), i, dtype=np.int32))
                reads += len(some)
                stands[i] = impact[min(depth + size, len(docs)) - 1] if depth + size < len(docs) else 0
        depth, size = depth + size, size * 4
        ended = not stands.any()
        open_sum = int(stands.sum())
        met = np.flatnonzero(lower)
        if not len(met):
            return met, met, reads
        # the best so far, and what stands last among them
        if len(met) > k:
            kth = np.partition(lower[met], len(met) - k)[len(met) - k]
        else:
            kth = 1
        kth = max(int(kth), threshold, 1)
        best = met[lower[met] >= kth]
        best = best[np.lexsort((best, -lower[best]))][:k]
        if ended:
            return best, lower[best], reads
        if open_sum >= kth:
            continue  # a document that was not met yet may still come in
        missing = np.full(count, open_sum, dtype=np.int64)
        all_docs, all_lists = np.concatenate(read_docs), np.concatenate(read_lists)
        np.subtract.at(missing, all_docs, stands[all_lists])
        if missing[best].any():
            continue  # a score among the best is not whole
        upper = lower + missing
        last = (int(lower[best[-1]]), int(best[-1])) if len(best) == k else (kth - 1, count)
        rivals = met[(upper[met] > last[0]) | (upper[met] == last[0]) & (met < last[1])]
        if np.isin(rivals, best).all():
            return best, lower[best], reads


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i] for name in batch.schema.names}


def document_frequencies(index: DataFrame, queries: Queries) -> np.ndarray:
    """In how many documents each term of the queries stands."""
    shared = index.sparkSession.sparkContext.broadcast(queries.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            for row in _rows(batch):
                total += Segment(row, shared.value).df
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["term", "df"])

    found = map_batches(index.select("lengths", "terms", "counts"), run, "term long, df long")
    df = np.zeros(len(queries.terms), dtype=np.int64)
    for row in found.groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]
    return df


def search_block(index: DataFrame, queries: Queries, n_docs: int, n_words: int, k: int) -> DataFrame:
    """``item``, ``id`` and ``score``: from each task the documents that may be among the ``k`` best."""
    df = document_frequencies(index, queries)
    w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
    shared = index.sparkSession.sparkContext.broadcast((queries, w))
    kind = dict(index.dtypes)["ids"].removeprefix("array<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, w = shared.value
        # of each query the scores found so far in this task, the best k of them
        reached = [np.zeros(0, dtype=np.int64) for _ in queries.items]
        for batch in batches:
            for row in _rows(batch):
                segment = Segment(row, queries.terms)
                m = 75 + 25 * segment.lengths * n_docs // n_words
                lists = segment.lists(m, w)
                items, docs, scores = [], [], []
                for i, (_, terms, repeats) in enumerate(queries.items):
                    own = [
                        (lists[t][0], lists[t][1] * r) for t, r in zip(terms.tolist(), repeats.tolist()) if lists[t]
                    ]
                    if not own:
                        continue
                    least = int(reached[i][-1]) if len(reached[i]) == k else 0
                    best, score, _ = nra(own, len(m), k, least)
                    reached[i] = -np.sort(-np.concatenate((reached[i], score)))[:k]
                    items.append(np.full(len(best), i))
                    docs.append(best)
                    scores.append(score)
                if docs:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(items)),
                            row["ids"].values.take(pa.array(np.concatenate(docs))),
                            pa.array(np.concatenate(scores)),
                        ],
                        ["item", "id", "score"],
                    )

    return map_batches(index.drop("n_docs", "n_words"), run, f"item long, id {kind}, score long")


def query_blocks(
    items: DataFrame, id_col: str, text_col: str, block_bytes: int
) -> Iterator[list[tuple[object, bytes]]]:
    """The queries, copies removed, in blocks of about ``block_bytes`` of text."""
    rows = items.select(F.col(id_col).alias("item"), F.col(text_col).cast("binary").alias("text"))
    rows = cut_lineage(rows.where("text is not null").distinct())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    for b in range(blocks):
        some = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        yield [(r["item"], bytes(r["text"])) for r in some]


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
    segment_tokens: int = SEGMENT_TOKENS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``id`` and ``score``: each query's ``k`` best documents."""
    spark = docs.sparkSession
    index = cut_lineage(build_index(docs, id_col, text_col, segment_tokens))
    facts = index.agg(F.sum("n_docs"), F.sum("n_words")).first()
    n_docs, n_words = facts[0] or 0, facts[1] or 0
    doc_kind, item_kind = dict(docs.dtypes)[id_col], dict(items.dtypes)[item_id_col]
    result = None
    for block in query_blocks(items, item_id_col, item_text_col, block_bytes) if n_words else ():
        found = search_block(index, Queries(block), n_docs, n_words, k)
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], f"item long, item_id {item_kind}")
        named = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "id", "score")
        result = named if result is None else result.unionByName(named)
    if result is None:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, id {doc_kind}, score long")
    return result
