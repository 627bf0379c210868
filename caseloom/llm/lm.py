"""Language-model scores of texts: context-tree weighting over bytes, and a word baseline.

Method: every byte (and a zero byte that ends the text) is eight binary decisions. Each
decision has a context tree over the ``depth`` bytes before it, one tree per prefix of the
byte. A node holds how often 0 and 1 followed its context in the training texts; its
Krichevsky-Trofimov estimate is mixed half and half with the product over its children, for
all depths. The frozen trees give each next bit the probability that the whole mixture
assigns, so a text's score is the sum of ``log10`` over its bits, and its code length per
byte follows. What has no count in training is still scored (its nodes predict one half).

The baseline is an add-a-half unigram model over words.

Scale: the trees are tables. Rows of byte strings of length ``depth + 1`` with their counts
are summed by Spark, the trees are built upwards by one grouped sum per depth and read
downwards by one join per depth; nothing is collected or broadcast by hand. Texts are held
in blocks of about ``BLOCK_BYTES`` (compressed, whole texts). A block asks for each
distinct word and byte string once, so a frequent one makes one row per block, not one per
use; the answers come back as one row per block and meet the block in one join.

Defined cases: a null text is an empty one: it has the end token alone; a null training
condition means held out; repeated rows count again and get one result row each; without
training rows all counts are 0 and every bit costs one bit; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.taskcontext import TaskContext

from caseloom.llm.arrow import as_bytes, chunks, map_batches
from caseloom.session import cut_lineage

DEPTH = 4
#: A byte string and the bits of a node's byte fit into a long.
LARGEST_DEPTH = 6
BLOCK_BYTES = 16 << 20
#: The token that ends a text; no word is empty.
END = b""


def blocks_of(docs: DataFrame, training: Column, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """``block``, ``ids``, ``train``, ``sizes`` and ``data``: whole texts, compressed together."""

    def pack(number: int, ids: list[pa.Array], train: list[bool], texts: list[bytes]) -> pa.RecordBatch:
        data = pa.compress(b"".join(texts), codec="zstd", asbytes=True)
        whole = pa.array([0, len(texts)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays(whole, pa.concat_arrays(ids)),
                pa.ListArray.from_arrays(whole, pa.array(train, pa.bool_())),
                pa.ListArray.from_arrays(whole, pa.array([len(t) for t in texts], pa.int32())),
                pa.array([data], pa.binary()),
            ],
            ["block", "ids", "train", "sizes", "data"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() << 32) - 1
        ids, train, texts, held = [], [], [], 0
        for batch in batches:
            marks = batch.column(2).to_pylist()
            for i, text in enumerate(as_bytes(batch.column(1))):
                text = text or b""
                if ids and held + len(text) > block_bytes:
                    yield pack(number := number + 1, ids, train, texts)
                    ids, train, texts, held = [], [], [], 0
                ids.append(batch.column(0).slice(i, 1))
                train.append(bool(marks[i]))
                texts.append(text)
                held += len(text)
        if ids:
            yield pack(number + 1, ids, train, texts)

    kind = dict(docs.dtypes)[id_col]
    schema = f"block long, ids array<{kind}>, train array<boolean>, sizes array<int>, data binary"
    return map_batches(docs.select(id_col, text_col, training.alias("train")), run, schema)


def unpack(row: dict) -> tuple[list[bytes], np.ndarray]:
    """The texts of a block, and which of them train."""
    sizes = row["sizes"].values.to_numpy()
    ends = np.cumsum(sizes.astype(np.int64))
    data = pa.decompress(row["data"].as_py(), int(ends[-1]), codec="zstd", asbytes=True)
    texts = [data[b:e] for b, e in zip((ends - sizes).tolist(), ends.tolist())]
    return texts, row["train"].values.to_numpy(zero_copy_only=False)


class Numbered(dict):
    """Numbers keys in the order in which they are first seen."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


def token_numbers(texts: list[bytes]) -> Iterator[tuple[Numbered, np.ndarray]]:
    """For each text the block's words so far, and the numbers of its tokens, the end last."""
    known = Numbered()
    for text in texts:
        words = text.lower().split()
        words.append(END)
        yield known, np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def ask_tokens(blocks: DataFrame) -> DataFrame:
    """``token``, ``block``, ``at`` (its number in the block) and ``n``, its training count there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                texts, train = unpack(row)
                counts, known = np.zeros(1 << 10, dtype=np.int64), {}
                for i, (known, numbers) in enumerate(token_numbers(texts)):
                    if len(known) > len(counts):
                        counts = np.concatenate((counts, np.zeros(len(known), dtype=np.int64)))
                    if train[i]:
                        np.add.at(counts, numbers, 1)
                tokens, number = list(known), row["block"].as_py()
                for start in range(0, len(tokens), 50_000):
                    some = tokens[start : start + 50_000]
                    at = np.arange(start, start + len(some))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(some, pa.binary()),
                            pa.array(np.full(len(some), number)),
                            pa.array(at.astype(np.int32)),
                            pa.array(counts[at]),
                        ],
                        ["token", "block", "at", "n"],
                    )

    return map_batches(blocks, run, "token binary, block long, at int, n long")


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i] for name in batch.schema.names}


def byte_strings(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of the texts with the ``depth`` before it, as one number, and its text.

    Before a text stand zero bytes, behind it the zero byte that ends it.
    """
    gap = bytes(depth)
    raw = np.frombuffer(gap + gap.join([*texts, b""]), dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(sizes + depth) - sizes
    strings = np.zeros(len(raw) - depth, dtype=np.int64)
    for back in range(depth, -1, -1):
        strings |= raw[depth - back : len(raw) - back].astype(np.int64) << (8 * back)
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    place = np.arange(len(text)) + np.repeat(begins - depth - np.cumsum(sizes + 1) + sizes + 1, sizes + 1)
    return strings[place], text


class Places:
    """Finds byte strings in a list of distinct ones, by an open hash table."""

    def __init__(self, strings: np.ndarray) -> None:
        bits = max(4, (4 * len(strings)).bit_length())
        self.strings, self.shift, self.last = strings, np.uint64(64 - bits), (1 << bits) - 1
        self.table = np.full(1 << bits, -1, dtype=np.int32)
        left = np.arange(len(strings), dtype=np.int32)
        slots = self.slot(strings)
        while len(left):
            free = self.table[slots] < 0
            self.table[slots[free]] = left[free]  # of several, the last one has it
            lost = self.table[slots] != left
            left, slots = left[lost], (slots[lost] + 1) & self.last

    def slot(self, strings: np.ndarray) -> np.ndarray:
        return (strings.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, strings: np.ndarray) -> np.ndarray:
        """Places of strings that are all in the list."""
        slots = self.slot(strings)
        found = self.table[slots]
        missed = np.flatnonzero(self.strings[found] != strings)
        slots = slots[missed]
        while len(missed):
            slots = (slots + 1) & self.last
            found[missed] = self.table[slots]
            lost = self.strings[found[missed]] != strings[missed]
            missed, slots = missed[lost], slots[lost]
        return found


def distinct_strings(texts: list[bytes], depth: int) -> np.ndarray:
    """The distinct byte strings of a block, sorted."""
    found = [np.unique(byte_strings(some, depth)[0]) for _, some in chunks(texts)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def ask_strings(blocks: DataFrame, depth: int) -> DataFrame:
    """``string``, ``block`` and ``n``, its training count there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                texts, train = unpack(row)
                distinct = distinct_strings(texts, depth)
                places, counts = Places(distinct), np.zeros(len(distinct), dtype=np.int64)
                for start, some in chunks(texts):
                    strings, text = byte_strings(some, depth)
                    used = train[start : start + len(some)][text]
                    counts += np.bincount(places.find(strings[used]), minlength=len(distinct))
                number = row["block"].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct), pa.array(np.full(len(distinct), number)), pa.array(counts)],
                    ["string", "block", "n"],
                )

    return map_batches(blocks, run, "string long, block long, n long")


def log_gamma(x: Column) -> Column:
    """The natural logarithm of the gamma function, for x of at least one half."""
    shift = 7
    y = x + F.lit(float(shift))
    product = x
    for i in range(1, shift):
        product = product * (x + F.lit(float(i)))
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + series - F.log(product)


def kt_log(zeros: Column, ones: Column) -> Column:
    """The log probability that a Krichevsky-Trofimov estimator gives such counts, in any order."""
    return (
        log_gamma(zeros + F.lit(0.5)) + log_gamma(ones + F.lit(0.5))
        - log_gamma(zeros + ones + F.lit(1.0)) - F.lit(math.log(math.pi))
    )


def decisions(strings: DataFrame, *keep: str) -> DataFrame:
    """Eight rows per string: ``node`` (context and the byte's bits so far) and ``bit``."""
    levels = F.explode(F.array(*[F.lit(j) for j in range(8)])).alias("j")
    prefix = F.expr("shiftleft(1, j) | shiftright(cast(string & 255 as int), 8 - j)")
    bit = F.expr("shiftright(cast(string & 255 as int), 7 - j) & 1")
    return strings.select("string", *keep, levels).select(
        *keep,
        "string",
        (F.shiftright("string", 8) * 256 + prefix).alias("node"),
        bit.alias("bit"),
    )


def bit_predictions(strings: DataFrame, depth: int) -> DataFrame:
    """``node`` and ``p1``, the mixture's probability of a 1, for every node of full depth."""
    leaf = decisions(strings, "n").groupBy("node").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).cast("double").alias("zeros"),
        F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).cast("double").alias("ones"),
    )
    one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    level = cut_lineage(leaf.withColumn("log_w", kt_log(F.col("zeros"), F.col("ones"))))
    levels = [level.select("node", one.alias("k1"))]
    for d in range(depth - 1, -1, -1):
        span = 1 << (8 * d)
        shorter = (F.shiftright("node", 8) % span * 256 + F.col("node") % 256).cast("long")
        merged = level.groupBy(shorter.alias("node")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_w").alias("children")
        )
        kt = kt_log(F.col("zeros"), F.col("ones"))
        # the share of the node's own estimate in the mixture
        level = merged.withColumn("kt", kt).withColumn(
            "own", 1 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("children") - F.col("kt")))))
        )
        high, low = F.greatest("kt", "children"), F.least("kt", "children")
        level = cut_lineage(
            level.withColumn("log_w", F.lit(math.log(0.5)) + high + F.log1p(F.exp(low - high)))
            .select("node", "zeros", "ones", "log_w", "own", one.alias("k1"))
        )
        levels.append(level.select("node", "own", "k1"))
    # downwards: what is settled so far of the probability, and the share still open
    top = levels.pop().select(
        F.col("node").alias("up"), (F.col("own") * F.col("k1")).alias("done"), (1 - F.col("own")).alias("open")
    )
    for d in range(1, depth + 1):
        span = 1 << (8 * (d - 1))
        shorter = (F.shiftright("node", 8) % span * 256 + F.col("node") % 256).cast("long")
        joined = levels.pop().withColumn("up", shorter).join(top, "up")
        if d == depth:
            return joined.select("node", (F.col("done") + F.col("open") * F.col("k1")).alias("p1"))
        top = joined.select(
            F.col("node").alias("up"),
            (F.col("done") + F.col("open") * F.col("own") * F.col("k1")).alias("done"),
            (F.col("open") * (1 - F.col("own"))).alias("open"),
        )
    raise ValueError("depth has to be 1 or more")


def string_scores(strings: DataFrame, depth: int) -> DataFrame:
    """``string`` and ``log_p``: log10 of the last byte's probability behind the others."""
    p1 = bit_predictions(strings, depth)
    return (
        decisions(strings)
        .join(p1, "node")
        .groupBy("string")
        .agg(F.sum(F.log10(F.when(F.col("bit") == 1, F.col("p1")).otherwise(1 - F.col("p1")))).alias("log_p"))
    )


def _scorer(depth: int):
    """Scores the texts of blocks that carry their answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                texts, train = unpack(row)
                counts = np.zeros(len(row["token_at"]), dtype=np.int64)
                counts[row["token_at"].values.to_numpy()] = row["token_n"].values.to_numpy()
                logs, seen = np.log10(counts + 0.5), counts > 0
                n_tokens, n_known, words = [], [], []
                for _, numbers in token_numbers(texts):
                    n_tokens.append(len(numbers))
                    n_known.append(int(seen[numbers].sum()))
                    words.append(float(logs[numbers].sum()))
                strings = row["strings"].values.to_numpy()
                places, log_p = Places(strings), row["log_ps"].values.to_numpy()
                scores = []
                for _, some in chunks(texts):
                    found, text = byte_strings(some, depth)
                    scores.append(np.bincount(text, weights=log_p[places.find(found)], minlength=len(some)))
                yield pa.RecordBatch.from_arrays(
                    [
                        row["ids"].values,
                        pa.array(train),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array(n_tokens, pa.int64()),
                        pa.array(n_known, pa.int64()),
                        pa.array(words, pa.float64()),
                        pa.array(np.concatenate(scores)),
                    ],
                    ["id", "train", "n_bytes", "n_tokens", "n_known", "word_logs", "score"],
                )

    return run


def score(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    depth: int = DEPTH,
) -> DataFrame:
    """``id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``bits_per_byte``.

    ``depth`` is the number of bytes of context, from 1 to ``LARGEST_DEPTH``.
    """
    if not 1 <= depth <= LARGEST_DEPTH:
        raise ValueError(f"depth has to be from 1 to {LARGEST_DEPTH}")
    blocks = cut_lineage(blocks_of(docs, training, id_col, text_col, block_bytes))

    by_token = Window.partitionBy("token")
    asked = ask_tokens(blocks).select(
        "block", "at", "n",
        F.sum("n").over(by_token).alias("c"),
        F.row_number().over(by_token.orderBy("block")).alias("first"),
    )
    tokens = cut_lineage(
        asked.groupBy("block").agg(
            F.collect_list("at").alias("token_at"),
            F.collect_list("c").alias("token_n"),
            F.sum("n").alias("tokens"),
            F.sum(((F.col("first") == 1) & (F.col("c") > 0)).cast("long")).alias("kinds"),
        )
    )
    facts = tokens.agg(F.sum("tokens"), F.sum("kinds")).first()
    total, kinds = facts[0] or 0, facts[1] or 0

    wanted = cut_lineage(ask_strings(blocks, depth))
    scored = string_scores(cut_lineage(wanted.groupBy("string").agg(F.sum("n").alias("n"))), depth)
    strings = (
        wanted.select("string", "block")
        .join(scored, "string")
        .groupBy("block")
        .agg(F.collect_list("string").alias("strings"), F.collect_list("log_p").alias("log_ps"))
    )
    joined = blocks.join(tokens.select("block", "token_at", "token_n"), "block").join(strings, "block")
    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, train boolean, n_bytes long, n_tokens long, n_known long, word_logs double, score double"
    found = map_batches(joined, _scorer(depth), schema)
    per_token = math.log10(total + 0.5 * (kinds + 1))
    return found.select(
        "id",
        "train",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("word_logs") - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        "score",
        (-F.col("score") * F.lit(math.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
