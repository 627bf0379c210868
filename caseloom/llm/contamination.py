"""Benchmark decontamination over a positional inverted index.

Method: the training texts are cut into segments of whole documents, and each segment
stores, for every term, the list of its positions (delta-coded). A test phrase is looked
up by starting from the list of its rarest term in the segment, moved by the term's place
in the phrase, and intersecting it with the moved lists of the other terms, rarest first.
With a tolerance of 0 this gives exact phrases; with a tolerance of ``slop`` words it gives
proximity matches: a start at which every word of the phrase has an occurrence within
``slop`` words of its place.

Scale: building moves no text; a segment is made by one task and holds about
``SEGMENT_TOKENS`` tokens, so no task holds more whatever the partition. A search looks into
``CANDIDATES`` places at a time, however frequent the words of a phrase are. The test set is
broadcast in blocks of at most about ``BLOCK_BYTES`` of text (measured, copies removed),
one pass over the stored index for each, so a larger test set means more passes and never
a larger broadcast. Nothing is grouped by passage, so a passage that a third of all
documents share is no hot key.

Defined cases: a null text has no words; an item without words matches nothing; a null
item id is left out of the listed ids, but its windows still hit; repeated rows of either
table give the same marks for every copy; with an empty test set nothing is hit; an empty
document table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.taskcontext import TaskContext

from caseloom.llm.arrow import as_bytes, free_name, map_batches
from caseloom.session import cut_lineage

SEGMENT_TOKENS = 2_000_000
BLOCK_BYTES = 2 << 20
#: Places of rarest terms that are looked into at a time.
CANDIDATES = 500_000
#: Positions left free between documents; no proximity match of up to 3 words crosses them.
GAP = 8
LARGEST_SLOP = 3

_letters = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII digits, ASCII letters (made small) and other code points above 127."""
    return (text or b"").translate(_letters).split()


class Terms(dict):
    """Numbers terms in the order in which they are first seen."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def pack(values: np.ndarray) -> bytes:
    """Small numbers in few bytes: seven bits a byte, the high bit says that more follow."""
    sizes = np.ones(len(values), dtype=np.int64)
    for bits in (7, 14, 21, 28):
        sizes += values >= 1 << bits
    ends = np.cumsum(sizes)
    out = np.zeros(ends[-1] if len(ends) else 0, dtype=np.uint8)
    at, left, rest = ends - sizes, sizes, values.astype(np.uint32)
    while len(rest):
        out[at] = (rest & 127) | np.where(left > 1, 128, 0)
        more = left > 1
        at, left, rest = at[more] + 1, left[more] - 1, rest[more] >> np.uint32(7)
    return out.tobytes()


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    values = (raw[starts] & 127).astype(np.int64)
    at, shift = np.flatnonzero(starts < ends), 7
    while len(at):
        place = starts[at] + shift // 7
        values[at] |= (raw[place] & 127).astype(np.int64) << shift
        at, shift = at[place < ends[at]], shift + 7
    return values


def _segment_row(number: int, ids: list, words: list[np.ndarray], terms: Terms) -> pa.RecordBatch:
    lengths = np.array([len(w) for w in words], dtype=np.int32)
    starts = document_starts(lengths)
    term = np.concatenate(words) if words else np.zeros(0, dtype=np.int32)
    place = np.arange(len(term)) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
    key = np.sort(term.astype(np.int64) << 32 | place)
    counts = np.bincount(term, minlength=len(terms)).astype(np.int32)
    place = key & 0xFFFFFFFF
    gaps = np.diff(place, prepend=0)
    first = np.cumsum(counts) - counts
    gaps[first] = place[first]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays(ids)),
            pa.array([lengths.tolist()], pa.list_(pa.int32())),
            pa.array([b" ".join(terms)], pa.binary()),
            pa.array([counts.tobytes()], pa.binary()),
            pa.array([pack(gaps)], pa.binary()),
        ],
        ["segment", "ids", "lengths", "terms", "counts", "postings"],
    )


def document_starts(lengths: np.ndarray) -> np.ndarray:
    """The first position of each document of a segment."""
    room = lengths.astype(np.int64) + GAP
    return np.cumsum(room) - room + GAP


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS
) -> DataFrame:
    """The postings: one row per segment of whole documents.

    ``terms`` holds the segment's terms, ``counts`` how often each occurs, ``postings``
    their positions one term after the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() << 32) - 1
        ids, words, terms, held = [], [], Terms(), 0
        for batch in batches:
            for i, text in enumerate(as_bytes(batch.column(1))):
                found = words_of(text)
                if ids and held + len(found) + GAP > segment_tokens:
                    yield _segment_row(number := number + 1, ids, words, terms)
                    ids, words, terms, held = [], [], Terms(), 0
                words.append(np.fromiter(map(terms.__getitem__, found), np.int32, len(found)))
                ids.append(batch.column(0).slice(i, 1))
                held += len(found) + GAP
        if ids:
            yield _segment_row(number + 1, ids, words, terms)

    kind = dict(docs.dtypes)[id_col]
    schema = f"segment long, ids array<{kind}>, lengths array<int>, terms binary, counts binary, postings binary"
    return map_batches(docs.select(id_col, text_col), run, schema)


class Phrases:
    """Distinct windows of the items of one block, as places in a list of their terms."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int) -> None:
        terms, rows, owners = Terms(), {}, []
        for name, text in items:
            found = [terms[w] for w in words_of(text)]
            for start in range(max(1, len(found) - window + 1) if found else 0):
                run = tuple(found[start : start + window])
                at = rows.setdefault(run, len(rows))
                if at == len(owners):
                    owners.append(set())
                if name is not None:
                    owners[at].add(name)
        self.terms = list(terms)
        self.lengths = np.array([len(r) for r in rows], dtype=np.int64)
        self.rows = np.full((len(rows), window), -1, dtype=np.int64)
        for at, run in enumerate(rows):
            self.rows[at, : len(run)] = run
        self.owners = [sorted(o) for o in owners]


def candidates(
    keys: np.ndarray, span: int, lead: np.ndarray, first: np.ndarray, size: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Window and start by the postings of each window's rarest term, about ``CANDIDATES`` at a time.

    ``lead`` is that term's place in the window, ``first`` and ``size`` say where its list
    lies. A list of more is handed out in pieces, so memory does not depend on the words.
    """
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, total, CANDIDATES):
        at = np.arange(begin, min(begin + CANDIDATES, total))
        window = np.searchsorted(ends, at, side="right")
        posting = first[window] + at - (ends[window] - size[window])
        yield window, keys[posting] % span - lead[window]


def confirmed(
    keys: np.ndarray, span: int, term: np.ndarray, order: np.ndarray, lengths: np.ndarray,
    window: np.ndarray, start: np.ndarray, slop: int, since: int,
) -> tuple[np.ndarray, np.ndarray]:
    """The windows and starts that the lists of all terms confirm, from rank ``since`` on.

    Each list, moved by its term's place, keeps the starts with a posting within ``slop``.
    """
    for rank in range(since, term.shape[1]):
        here = lengths[window] > rank
        if not here.any():
            break
        w, s = window[here], start[here]
        place = order[w, rank]
        base = term[w, place] * span
        aim = base + s + place
        at = np.searchsorted(keys, np.maximum(aim - slop, base))
        found = at < len(keys)
        found[found] = keys[at[found]] <= aim[found] + slop
        keep = np.ones(len(window), dtype=bool)
        keep[here] = found
        window, start = window[keep], start[keep]
    return window, start


def intersect(
    keys: np.ndarray, span: int, term: np.ndarray, order: np.ndarray, lengths: np.ndarray,
    first: np.ndarray, count: np.ndarray, slop: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Window and start of every match.

    ``keys`` are the postings as term * span + position, in order. ``term`` has a window's
    terms, ``order`` their places from the rarest on; the rarest list gives the candidates
    and each further list, moved by its term's place, keeps those it confirms. Starts that
    lie within ``slop`` of a candidate are tried for candidates that the lists confirm twice
    as loosely, as any such start asks for.
    """
    rows = np.arange(len(term))
    lead = order[:, 0]
    moves = np.arange(-slop, slop + 1)
    windows, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for window, start in candidates(keys, span, lead, first[rows, lead], count[rows, lead]):
        if slop:
            window, start = confirmed(keys, span, term, order, lengths, window, start, 2 * slop, 1)
            window, start = np.repeat(window, len(moves)), (start[:, None] + moves).ravel()
        keep = start >= 0
        window, start = window[keep], start[keep]
        window, start = confirmed(keys, span, term, order, lengths, window, start, slop, 1)
        windows.append(window)
        starts.append(start)
    return np.concatenate(windows), np.concatenate(starts)


def _search_segment(
    ids: int, lengths: np.ndarray, terms: bytes, counts: bytes, postings: bytes, phrases: Phrases, slop: int
) -> dict[int, tuple[list[int], set[str], set[str]]]:
    """Per document of the segment with a match: its hit spans, exact items, near items."""
    number = dict(zip(terms.split(b" "), range(1 << 62)))
    local = np.array([number.get(t, -1) for t in phrases.terms], dtype=np.int64)
    del number
    starts = document_starts(lengths)
    # room behind the last word for a window that would reach beyond it
    span = int(lengths.sum()) + GAP * (ids + 2) + phrases.rows.shape[1]
    freq = np.frombuffer(counts, dtype=np.int32).astype(np.int64)
    ends = np.cumsum(freq)
    firsts = ends - freq
    total = np.cumsum(unpack(postings))
    base = np.where(firsts > 0, total[firsts - 1], 0)
    keys = total - np.repeat(base, freq) + np.repeat(np.arange(len(freq)) * span, freq)

    real = phrases.rows >= 0
    term = np.where(real, local[phrases.rows], -1)
    possible = ((term >= 0) | ~real).all(axis=1)
    which = np.flatnonzero(possible)
    term, real, size = term[which], real[which], phrases.lengths[which]
    count = np.where(real, freq[term], np.int64(1) << 60)
    order = np.argsort(count, axis=1, kind="stable")
    found: dict[int, tuple[list[int], set[str], set[str]]] = {}
    if not len(which):
        return found
    for kind, tolerance in ((2, slop), (1, 0)):
        if kind == 2 and not slop:
            continue
        window, start = intersect(keys, span, term, order, size, firsts[term], count, tolerance)
        if tolerance:  # a start may lie in the free room before its document
            doc = np.searchsorted(starts, start + tolerance, side="right") - 1
        else:
            doc = np.searchsorted(starts, start, side="right") - 1
        for d, w in set(zip(doc.tolist(), which[window].tolist())):
            found.setdefault(d, ([], set(), set()))[kind].update(phrases.owners[w])
        if kind == 1 and len(start):
            at = np.argsort(start, kind="stable")
            begin, end = start[at], start[at] + size[window[at]]
            end = np.maximum.accumulate(end)
            new = np.append(True, begin[1:] > end[:-1])
            begin, end = begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
            doc = np.searchsorted(starts, begin, side="right") - 1
            for d, b, e in zip(doc.tolist(), (begin - starts[doc]).tolist(), (end - starts[doc]).tolist()):
                found.setdefault(d, ([], set(), set()))[0].extend((b, e))
    return found


def search(index: DataFrame, phrases: Phrases, slop: int) -> DataFrame:
    """``segment``, ``ordinal``, ``spans`` (start, end, ...), ``items``, ``near`` of documents with a match."""
    shared = index.sparkSession.sparkContext.broadcast(phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                lengths = np.array(row["lengths"].as_py(), dtype=np.int32)
                found = _search_segment(
                    len(lengths), lengths, row["terms"].as_py(), row["counts"].as_py(),
                    row["postings"].as_py(), shared.value, slop,
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["segment"].as_py()] * len(found), pa.int64()),
                        pa.array(list(found), pa.int32()),
                        pa.array([f[0] for f in found.values()], pa.list_(pa.int32())),
                        pa.array([sorted(f[1]) for f in found.values()], pa.list_(pa.string())),
                        pa.array([sorted(f[2]) for f in found.values()], pa.list_(pa.string())),
                    ],
                    ["segment", "ordinal", "spans", "items", "near"],
                )

    schema = "segment long, ordinal int, spans array<int>, items array<string>, near array<string>"
    return map_batches(index.select("segment", "lengths", "terms", "counts", "postings"), run, schema)


def phrase_blocks(bench: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> Iterator[Phrases]:
    """The test set, copies removed, in blocks of about ``block_bytes`` of text."""
    items = bench.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    items = cut_lineage(items.where("text is not null").distinct())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        yield Phrases([(r["item"], bytes(r["text"])) for r in rows], window)


def _covered(spans):
    """How many words a list of (start, end, start, end, ...) covers, overlaps counted once."""
    pairs = F.array_sort(
        F.transform(
            F.sequence(F.lit(0), (F.size(spans) / 2).cast("int") - 1),
            lambda i: F.struct(F.get(spans, i * 2).alias("b"), F.get(spans, i * 2 + 1).alias("e")),
        )
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum"))
    total = F.aggregate(
        pairs,
        zero,
        lambda acc, p: F.struct(
            F.greatest(acc["end"], p["e"]).alias("end"),
            (acc["sum"] + F.greatest(F.lit(0), p["e"] - F.greatest(acc["end"], p["b"]))).alias("sum"),
        ),
    )
    return F.when(F.size(spans) > 0, total["sum"]).otherwise(F.lit(0).cast("long"))


def mark(
    docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10, slop: int = 2,
    segment_tokens: int = SEGMENT_TOKENS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_words``, ``n_hit``, ``items``, ``near``.

    ``items`` are the ids (as strings, in order) of the items with a window that occurs in
    the text, ``near`` of those with a proximity match.
    """
    if not 0 <= slop <= LARGEST_SLOP:
        raise ValueError(f"slop goes up to {LARGEST_SLOP}")
    index = cut_lineage(build_index(docs, id_col, text_col, segment_tokens))
    hits = None
    for phrases in phrase_blocks(bench, item_id_col, item_text_col, window, block_bytes):
        found = search(index, phrases, slop)
        hits = found if hits is None else hits.unionByName(found)
    every = index.select("segment", F.posexplode(F.arrays_zip("ids", "lengths")).alias("ordinal", "d"))
    every = every.select("segment", "ordinal", F.col("d.ids").alias("id"), F.col("d.lengths").cast("long").alias("n_words"))
    if hits is None:
        none = F.array().cast("array<string>")
        return every.select("id", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"), none.alias("near"))
    merged = hits.groupBy("segment", "ordinal").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
    )
    none = F.array().cast("array<string>")
    return every.join(merged, ["segment", "ordinal"], "left").select(
        "id",
        "n_words",
        F.coalesce(_covered(F.col("spans")), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("near", none).alias("near"),
    )


def remove_contaminated(
    docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters
) -> DataFrame:
    """The rows of ``docs`` in which no window of the test set occurs, with all their columns."""
    key = free_name(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64(text_col))
    named = keyed.select(F.struct(F.col(id_col).alias("id"), F.col(key).alias("text_key")).alias("row"), text_col)
    marked = mark(named, bench, "row", text_col, **parameters)
    bad = marked.where("n_hit > 0").select(F.col("id.id").alias("bad_id"), F.col("id.text_key")).distinct()
    same = keyed[id_col].eqNullSafe(bad["bad_id"]) & (keyed[key] == bad["text_key"])
    return keyed.join(bad, same, "left_anti").drop(key)
