"""Text quality by logistic regression on hashed word n-grams, trained online.

Method: words (runs of letters and digits, and runs of signs) and pairs of neighbouring
words are hashed to ``1 << BITS`` features; a feature's value is its share among the text's
features, times ``SCALE``. The weights come from follow-the-regularised-leader updates, one
labelled text after the other, with L1 and L2 regularisation and a learning rate of its own
for every weight. A score is the sparse dot product with the weights through the logistic
function.

Scale: scoring is one pass over whole texts without a shuffle; the broadcast weights have a
fixed size (``8 << BITS`` bytes). Training reads a sample of labelled rows bounded by
``sample`` (drawn by a hash of the id), in one task: the updates are sequential.

Defined cases: a null or empty text has no features and is scored by the bias alone; a
label that is null is left out; different labels of a document count one by one, and of
several texts with one id the smallest trains; repeated documents get one result row each; without labelled rows every score is 0.5; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from caseloom.llm.arrow import as_bytes, chunks, map_batches
from caseloom.llm.hashing import Run, find_words, pairs
from caseloom.session import cut_lineage

BITS = 18
SCALE = 30.0
SAMPLE = 8_000
EPOCHS = 3

_kinds = np.array(
    [0 if b in (0, 9, 10, 11, 12, 13, 32) else 1 if chr(b).isalnum() or b >= 128 else 2 for b in range(256)],
    dtype=np.uint8,
)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, and the text of each."""
    words = find_words(Run.of(texts), _kinds)
    both, text = pairs(words)
    shift = np.uint64(64 - BITS)
    where = np.concatenate((words.text, text))
    return (np.concatenate((words.hash, both)) >> shift).astype(np.int64), where


def shares(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of each text, their shares of its features, and where each text begins."""
    found, where = features(texts)
    key, counts = np.unique(where << BITS | found, return_counts=True)
    text = key >> BITS
    total = np.bincount(where, minlength=len(texts))
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    return (key & ((1 << BITS) - 1)).astype(np.int32), (counts / total[text]).astype(np.float32), cut


class Ftrl:
    """Follow-the-regularised-leader, proximal, with a rate for each weight."""

    def __init__(self, size: int, alpha=0.3, beta=1.0, l1=0.05, l2=0.5) -> None:
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        active = np.abs(z) > self.l1
        return np.where(active, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0.0)

    def update(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        """One text: distinct features ``at`` with their values."""
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
        g = (p - label) * values
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "label") -> np.ndarray:
    """The weights, the bias last, from the rows of ``labelled`` in the order of ``turn``."""
    one = labelled.select("turn", F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]] = []
        bias = 1 << BITS
        for batch in batches:
            labels = batch.column(2).to_pylist()
            for start, texts in chunks(as_bytes(batch.column(1))):
                held.append((*shares(texts), labels[start : start + len(texts)]))
        model = Ftrl(bias + 1)
        for _ in range(EPOCHS):
            for at, values, cut, own in held:
                for i, label in enumerate(own):
                    one = slice(cut[i], cut[i + 1])
                    model.update(
                        np.append(at[one], bias), np.append(SCALE * values[one].astype(np.float64), 1.0), label
                    )
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().tobytes()], pa.binary())], ["weights"])

    trained = map_batches(one.repartition(1).sortWithinPartitions("turn", "label", "text"), run, "weights binary")
    rows = [np.frombuffer(r["weights"]) for r in trained.collect()]
    return next((w for w in rows if len(w)), np.zeros((1 << BITS) + 1))


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """Labelled texts, about ``sample`` of them at most, with ``turn``, the order to train in."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")
    )
    turn = F.shiftrightunsigned(F.xxhash64(F.lit(8), F.col("id")), 11)
    known = cut_lineage(known.distinct().withColumn("turn", turn))
    share = min(1.0, sample / max(1, known.count()))
    drawn = cut_lineage(known.where(F.col("turn") < int(share * 2**53)))
    short = drawn.count() <= 2 * sample
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Labels drawn in a number that was checked go to the texts, which then stay in place.
    found = texts.join(F.broadcast(drawn) if short else drawn, "id")
    return found.groupBy("id", "label", "turn").agg(F.min("text").alias("text"))


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``score`` (the probability of label 1) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for _, texts in chunks(as_bytes(batch.column(1))):
                made.append(scores(texts, shared.value))
            flat = np.concatenate(made) if made else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(flat)], ["id", "score"])

    kind = dict(docs.dtypes)[id_col]
    return map_batches(docs.select(id_col, text_col), run, f"id {kind}, score double")


def scores(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    found, where = features(texts)
    total = np.bincount(where, weights=weights[found], minlength=len(texts))
    count = np.bincount(where, minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(SCALE * total / np.maximum(count, 1) + weights[-1], -35, 35)))


def classify(
    docs: DataFrame, labels: DataFrame, label_col: str, training, id_col: str = "doc_id",
    text_col: str = "text", sample: int = SAMPLE,
) -> DataFrame:
    """``id`` and ``score`` of all texts, learnt from labels of rows for which ``training`` (a condition) holds."""
    known = sampled(docs.where(training), labels.where(training), id_col, text_col, label_col, sample)
    return score(docs, train(known), id_col, text_col)
