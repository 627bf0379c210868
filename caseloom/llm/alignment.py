"""Alignment of two tokenizers over the same texts.

Method: both sides cut the same bytes, so a token is a range of bytes. Per batch of texts,
``pandas.merge_asof`` over keys of document and byte finds for the start of each token the
token of the other side that covers it. Both directions together give every pair of tokens
that overlap. A pair that ends at the same byte is a link, and the links cut a text into
groups, the smallest stretches that both sides cover with whole tokens.

Side A is a byte-level BPE of the tokenizers library, side B a sentencepiece model. Both see
a space and the text, special tokens are plain text. A worker encodes each word once while
it stays in its store. Texts whose tokens do not spell the text, byte for byte, on both
sides (a look-alike of the space, a normalising model) have no tokens.

Counts over the corpus: texts are taken in blocks of about ``BLOCK_BYTES``. A block keeps,
for each text, numbers of its distinct id pairs and how often each is linked, and hands on
one row per distinct pair. Those are summed over blocks, each B id's highest sum is
taken, and the sums go back to the blocks that asked. So no text moves, a pair of frequent
words is one row per block, and nothing is broadcast but the two vocabularies.

Defined cases: null and empty texts have no tokens, zeros and an empty listing; rows of
equal id stay apart; repeated rows count as often as they stand there; an empty table gives
no rows; a text is never cut, so a long one makes a block of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.taskcontext import TaskContext

from caseloom.llm.arrow import map_batches
from caseloom.llm.bpe import Bpe
from caseloom.llm.contamination import pack, unpack
from caseloom.session import cut_lineage

BLOCK_BYTES = 8 << 20
#: Characters that are tokens in memory at a time (a longer text alone).
RUN = 1 << 19
#: Rows of a batch that are Python objects at a time.
ROWS = 500
KEPT = 300_000
LARGEST_FILE = 64 << 20
#: How sentencepiece writes a space (fixed value).
SPACE = "▁"

#: Spaces and the word behind them.
_words = re.compile(" *[^ ]+| +").findall


class Pieces(dict):
    """The ids of words with their spaces, worked out when first asked for."""

    def __init__(self, model) -> None:
        super().__init__()
        self.model, self.space = model, model.piece_to_id(SPACE)

    def __missing__(self, word: str) -> bytes:
        # the model puts a space before what it is given
        ids = self.model.encode(word[1:]) if len(word) > 1 else [self.space]
        self[word] = made = np.array(ids, dtype=np.int32).tobytes()
        return made


class PieceSide:
    """A sentencepiece model."""

    def __init__(self, content: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        plain = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.all_bytes = np.frombuffer(b"".join(plain), dtype=np.uint8)
        self.sizes = np.fromiter(map(len, plain), dtype=np.int64, count=len(plain))
        self.starts = np.cumsum(self.sizes) - self.sizes
        # No piece goes on behind a word's end, and the text stays as it is: words are apart.
        odd = "a  b\tc\n d Ａ ﬁ é "
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces) and (
            "".join(self.model.encode(odd, out_type=str)) == SPACE + odd.replace(" ", SPACE)
            or b"".join(plain[i] for i in self.model.encode(odd)) == (" " + odd).encode()
        )
        self.known = Pieces(self.model)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that begin with a space, four bytes each."""
        if not self.apart:
            found = self.model.encode([t[1:] for t in texts], num_threads=1)
            return [np.array(ids, dtype=np.int32).tobytes() for ids in found]
        if len(self.known) > KEPT:
            self.known.clear()
        get = self.known.__getitem__
        return [b"".join(map(get, _words(text))) for text in texts]


class Tokens(NamedTuple):
    """One side's tokens of a run of texts, one text behind the other.

    ``count`` is per text; ``start`` and ``end`` are places in the bytes of the whole run.
    """

    ids: np.ndarray
    count: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _cut(side: Bpe | PieceSide, texts: list[str]) -> tuple[Tokens, np.ndarray]:
    """The tokens of a run, and for each text whether they spell it."""
    lists = side.encode_batch(texts)
    ids = np.frombuffer(b"".join(lists), dtype=np.int32)
    count = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)) // 4
    sizes = side.sizes[ids]
    end = np.cumsum(sizes)
    total = int(end[-1]) if len(end) else 0
    place = np.arange(total) + np.repeat(side.starts[ids] - end + sizes, sizes)
    spelled = side.all_bytes[place].tobytes()
    ends = np.concatenate(([0], end))[np.cumsum(np.concatenate(([0], count)))].tolist()
    right = [spelled[b:e] == t.encode() for b, e, t in zip(ends, ends[1:], texts)]
    return Tokens(ids, count, end - sizes, end), np.array(right, dtype=bool)


class Run(NamedTuple):
    """A run of texts on both sides, with the pairs of tokens that overlap."""

    a: Tokens
    b: Tokens
    over_a: np.ndarray
    over_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def _keys(tokens: Tokens) -> np.ndarray:
    """Document and byte of each token's start, in one number."""
    doc = np.repeat(np.arange(len(tokens.count)), tokens.count)
    first = np.concatenate(([0], np.cumsum(tokens.count)[:-1])) if len(tokens.count) else tokens.count
    begin = tokens.start[np.minimum(first, max(0, len(tokens.start) - 1))] if len(tokens.start) else first
    return doc << 32 | (tokens.start - np.repeat(begin, tokens.count))


class Aligner:
    def __init__(self, content_a: str, content_b: bytes) -> None:
        file = json.loads(content_a)
        file["added_tokens"] = []
        self.a, self.b = Bpe(json.dumps(file)), PieceSide(content_b)
        tops = len(self.a.sizes), len(self.b.sizes)
        self.tops = tops
        self.written = [
            b"%d%s" % (i, mark)
            for top, marks in zip(tops, ((b",", b"|"), (b",", b";", b"")))
            for mark in marks
            for i in range(top)
        ]

    def run(self, texts: list[str]) -> Run:
        """Tokens and overlaps of texts, none of which is empty."""
        spaced = [" " + t for t in texts]
        (a, right_a), (b, right_b) = _cut(self.a, spaced), _cut(self.b, spaced)
        right = right_a & right_b
        if not right.all():
            # the others are cut once more, and keep their place with no tokens
            some = [t for t, ok in zip(spaced, right) if ok]
            a, b = _cut(self.a, some)[0], _cut(self.b, some)[0]
            spread = np.zeros((2, len(texts)), dtype=np.int64)
            spread[0, right], spread[1, right] = a.count, b.count
            a, b = a._replace(count=spread[0]), b._replace(count=spread[1])
        left = pd.DataFrame({"at": _keys(a), "a": np.arange(len(a.ids))})
        other = pd.DataFrame({"at": _keys(b), "b": np.arange(len(b.ids))})
        cover_a = pd.merge_asof(left, other, on="at")["b"].to_numpy(dtype=np.int64)
        cover_b = pd.merge_asof(other, left, on="at")["a"].to_numpy(dtype=np.int64)
        # pairs that begin together are found from both sides
        new = np.flatnonzero(a.start[cover_b] != b.start) if len(b.ids) else cover_b
        over_a = np.concatenate((np.arange(len(a.ids)), cover_b[new]))
        over_b = np.concatenate((cover_a, new))
        order = np.lexsort((over_b, over_a))
        over_a, over_b = over_a[order], over_b[order]
        same = a.end[over_a] == b.end[over_b]
        return Run(a, b, over_a, over_b, over_a[same], over_b[same])

    def groups(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        """The group of each token of A and of B, numbered through the run."""
        ends = run.a.end[run.link_a]
        return np.searchsorted(ends, run.a.end), np.searchsorted(ends, run.b.end)

    def listings(self, run: Run) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for each text: the ids of its groups in order."""
        of_a, of_b = self.groups(run)
        links = len(run.link_a)
        in_a, in_b = np.bincount(of_a, minlength=links), np.bincount(of_b, minlength=links)
        before_b, upto_a = np.cumsum(in_b) - in_b, np.cumsum(in_a)
        top_a, top_b = self.tops
        last_a, last_b = np.zeros(len(run.a.ids), bool), np.zeros(len(run.b.ids), np.int64)
        last_a[run.link_a] = True
        last_b[run.link_b] = 1
        closing = np.cumsum(run.b.count)[run.b.count > 0] - 1
        last_b[closing] = 2
        codes = np.empty(len(run.a.ids) + len(run.b.ids), dtype=np.int64)
        codes[np.arange(len(of_a)) + before_b[of_a]] = run.a.ids + top_a * last_a
        codes[np.arange(len(of_b)) + upto_a[of_b]] = 2 * top_a + run.b.ids + top_b * last_b
        parts = list(map(self.written.__getitem__, codes.tolist()))
        ends = np.cumsum(run.a.count + run.b.count).tolist()
        return [b"".join(parts[s:e]) for s, e in zip([0, *ends], ends)]


@lru_cache(maxsize=2)
def _aligner(content_a: str, content_b: bytes) -> Aligner:
    """One aligner per pair of vocabularies and Python worker."""
    return Aligner(content_a, content_b)


def _contents(path_a: str, path_b: str) -> tuple[str, bytes]:
    """Both vocabulary files; their size bounds what is broadcast."""
    for path in (path_a, path_b):
        if Path(path).stat().st_size > LARGEST_FILE:
            raise ValueError(f"{path} is larger than {LARGEST_FILE} bytes")
    return Path(path_a).read_text(), Path(path_b).read_bytes()


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of a batch, about ``RUN`` characters at a time; no text is cut."""
    for start in range(0, batch.num_rows, ROWS):
        some = batch.slice(start, ROWS)
        begin, texts, held = 0, [], 0
        for text in some.column(1).to_pylist():
            if texts and held + len(text or "") > RUN:
                yield some.column(0).slice(begin, len(texts)), texts
                begin, texts, held = begin + len(texts), [], 0
            texts.append(text or "")
            held += len(texts[-1])
        if texts:
            yield some.column(0).slice(begin, len(texts)), texts


def _per_text(values: np.ndarray, doc: np.ndarray, base: np.ndarray, count: int) -> pa.ListArray:
    """A list per text of places in it."""
    ends = np.searchsorted(doc, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array((values - base[doc]).astype(np.int32)))


ALIGNED = (
    "a_ids array<int>, a_ends array<int>, a_groups array<int>, b_ids array<int>, b_ends array<int>, "
    "b_groups array<int>, over_a array<int>, over_b array<int>"
)


def _aligned(aligner: Aligner, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    full = np.flatnonzero([bool(t) for t in texts])
    run = aligner.run([texts[i] for i in full])
    groups = aligner.groups(run)
    columns = []
    links = run.link_a
    for tokens, group, of_link in ((run.a, groups[0], run.link_a), (run.b, groups[1], run.link_b)):
        doc = np.repeat(full, tokens.count)
        place = np.concatenate(([0], np.cumsum(tokens.count)))[:-1]
        first = np.zeros(len(texts), dtype=np.int64)
        first[full] = tokens.start[np.minimum(place, len(tokens.start) - 1)] if len(tokens.start) else 0
        link_doc = doc[of_link]
        base = np.searchsorted(link_doc, np.arange(len(texts)))
        none = np.zeros(len(texts), dtype=np.int64)
        columns += [
            _per_text(tokens.ids, doc, none, len(texts)),
            _per_text(tokens.end, doc, first, len(texts)),
            _per_text(group, doc, base, len(texts)),
        ]
    over_doc = np.repeat(full, run.a.count)[run.over_a]
    for tokens, over in ((run.a, run.over_a), (run.b, run.over_b)):
        base = np.zeros(len(texts), dtype=np.int64)
        base[full] = np.cumsum(tokens.count) - tokens.count
        columns.append(_per_text(over, over_doc, base, len(texts)))
    names = [part.split()[0] for part in ALIGNED.split(", ")]
    return pa.RecordBatch.from_arrays([ids, *columns], ["id", *names])


def align(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id`` and, for each text, the tokens of both sides and how they lie on each other.

    ``a_ids``, ``a_ends`` (byte behind each token, of the space and the text), ``a_groups``
    (number of its group) and the same for B; ``over_a`` and ``over_b`` are the places, in
    these lists, of the tokens of every overlapping pair.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_contents(path_a, path_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        for batch in batches:
            for ids, texts in _runs(batch):
                yield _aligned(aligner, ids, texts)

    kind = dict(docs.dtypes)[id_col]
    return map_batches(docs.select(id_col, text_col), run, f"id {kind}, {ALIGNED}")


class Block:
    """What is kept of some texts: figures of each, and their linked id pairs."""

    def __init__(self) -> None:
        self.ids, self.figures, self.digests, self.keys, self.docs, self.held = [], [], [], [], [], 0

    def add(self, aligner: Aligner, ids: pa.Array, texts: list[str]) -> None:
        full = np.flatnonzero([bool(t) for t in texts])
        run = aligner.run([texts[i] for i in full])
        figures = np.zeros((len(texts), 3), dtype=np.int64)
        doc = np.repeat(full, run.a.count)[run.link_a]
        figures[full, 0], figures[full, 1] = run.a.count, run.b.count
        figures[:, 2] = np.bincount(doc, minlength=len(texts))
        digests = [""] * len(texts)
        for i, listing in zip(full.tolist(), aligner.listings(run)):
            if listing:
                digests[i] = hashlib.sha256(listing).hexdigest()
        before = sum(map(len, self.digests))
        self.ids.append(ids)
        self.figures.append(figures)
        self.digests.append(digests)
        # one row per text and pair: the pair's times in the text
        pairs = run.a.ids[run.link_a].astype(np.int64) << 32 | run.b.ids[run.link_b]
        self.keys.append(pairs)
        self.docs.append((doc + before).astype(np.int32))
        self.held += sum(map(len, texts))

    def row(self, number: int) -> pa.RecordBatch:
        figures = np.concatenate(self.figures)
        pairs, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        totals = np.bincount(at, minlength=len(pairs))
        in_doc, times = np.unique(np.concatenate(self.docs).astype(np.int64) << 32 | at, return_counts=True)
        doc, at = in_doc >> 32, in_doc & 0xFFFFFFFF
        sizes = np.bincount(doc, minlength=len(figures))
        steps = np.diff(at, prepend=0)
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        steps[first] = at[first]
        whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                whole(pa.concat_arrays(self.ids)),
                *[whole(pa.array(figures[:, i])) for i in range(3)],
                whole(pa.array([d for some in self.digests for d in some], pa.string())),
                whole(pa.array(sizes.astype(np.int32))),
                pa.array([pack(steps)], pa.binary()),
                pa.array([pack(times)], pa.binary()),
                whole(pa.array(pairs)),
                whole(pa.array(totals)),
            ],
            ["block", "ids", "n_a", "n_b", "n_links", "digests", "sizes", "steps", "times", "pairs", "totals"],
        )


def _blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(_contents(path_a, path_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        number, block = TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            for ids, texts in _runs(batch):
                block.add(aligner, ids, texts)
                if block.held > block_bytes:
                    yield block.row(number)
                    number, block = number + 1, Block()
        if block.ids:
            yield block.row(number)

    kind = dict(docs.dtypes)[id_col]
    schema = (
        f"block long, ids array<{kind}>, n_a array<long>, n_b array<long>, n_links array<long>, "
        "digests array<string>, sizes array<int>, steps binary, times binary, pairs array<long>, totals array<long>"
    )
    return map_batches(docs.select(id_col, text_col), run, schema)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a block's pairs, summed for each of its texts."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            sizes = row["sizes"].values.to_numpy()
            doc = np.repeat(np.arange(len(sizes)), sizes)
            steps, times = unpack(row["steps"].as_py()), unpack(row["times"].as_py())
            walked = np.cumsum(steps)
            begin = np.cumsum(sizes) - sizes
            full = sizes > 0
            back = np.zeros(len(sizes), dtype=np.int64)
            back[full] = walked[begin[full]] - steps[begin[full]]
            at = walked - back[doc]
            pairs = row["pairs"].values.to_numpy()
            count, best = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=bool)
            if len(pairs):
                place = np.searchsorted(pairs, row["pair"].values.to_numpy())
                count[place] = row["count"].values.to_numpy()
                best[place] = row["best"].values.to_numpy(zero_copy_only=False)
            sums, hits = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
            if len(at):
                sums[full] = np.add.reduceat(count[at] * times, begin[full])
                hits[full] = np.add.reduceat(best[at] * times, begin[full])
            kept = ["ids", "n_a", "n_b", "n_links", "digests"]
            yield pa.RecordBatch.from_arrays(
                [*[row[name].values for name in kept], pa.array(hits), pa.array(sums)],
                ["id", "n_a", "n_b", "n_links", "groups_sha256", "n_best", "count_sum"],
            )


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair`` (A id * 2**32 + B id), ``count`` over the corpus, and whether it is its B id's ``best``."""
    counts = (
        blocks.select(F.explode(F.arrays_zip("pairs", "totals")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.totals").alias("count"))
    )
    counts = cut_lineage(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    tops = counts.groupBy("b").agg(F.max("count").alias("top"))
    return counts.join(tops, "b").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def summarise(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: how its tokens line up, against the counts of all texts.

    ``id``, ``n_a``, ``n_b``, ``n_links`` (as many as groups), ``n_best`` (links whose id pair
    is the most frequent of its B id), ``count_sum`` (frequencies of the links' pairs) and
    ``groups_sha256`` of the listing of the groups.
    """
    blocks = cut_lineage(_blocks(docs, path_a, path_b, id_col, text_col, block_bytes))
    asked = blocks.select("block", F.explode("pairs").alias("pair"))
    answers = (
        asked.join(pair_counts(blocks), "pair")
        .groupBy("block")
        .agg(*[F.collect_list(c).alias(c) for c in ("pair", "count", "best")])
    )
    joined = blocks.drop("totals").join(answers, "block", "left")
    kind = dict(docs.dtypes)[id_col]
    schema = (
        f"id {kind}, n_a long, n_b long, n_links long, groups_sha256 string, n_best long, count_sum long"
    )
    return map_batches(joined, _sums, schema)
