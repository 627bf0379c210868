"""Quality rules: exact counts per text, and a calibrated classifier behind fixed thresholds.

Method: a logistic regression on hashed word n-grams (one and two words) and character
n-grams (four bytes) is trained on labelled rows with mini-batches and one learning rate
per weight (AdaGrad). Its scores are calibrated to probabilities with a line fitted by
logistic regression on labelled rows left out of training. Texts are scored in Arrow
batches; a text is kept if no counted rule fails and its probability reaches ``KEEP``;
between ``DOUBT`` and ``KEEP`` it is marked as doubtful, and dropped like those below.

The counted rules: too few words (``FEWEST``), or more than ``REPEATED`` percent of the
words lie in a run of five words that occurs twice or more in the text.

Scale: one pass over whole texts without a shuffle; the broadcast weights have a fixed size.
Training reads at most about ``sample`` labelled rows, drawn by a hash of the id.

Defined cases: a null or empty text has no words, so it fails; a null label is left out;
different labels of a document count one by one, and of several texts with one id the
smallest trains; repeated documents get one result row each; without labelled rows of both kinds the classifier keeps everything; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from caseloom.llm.arrow import as_bytes, chunks, map_batches
from caseloom.llm.classifier import sampled
from caseloom.llm.hashing import Run, Words, find_words, mixed, pairs

FEWEST = 10
REPEATED = 20
KEEP = 0.5
DOUBT = 0.2
BITS = 18
SAMPLE = 8_000
EPOCHS = 6
RUN = 5
SYMBOLS = b"#*$%&|<>"

_spaces = (9, 10, 11, 12, 13, 32)
_words = np.array([0 if b in _spaces else 1 for b in range(256)], dtype=np.uint8)
_tokens = np.array(
    [0 if b in (0, *_spaces) else 1 if chr(b).isalnum() or b >= 128 else 2 for b in range(256)], dtype=np.uint8
)
_symbol = np.array([b in SYMBOLS for b in range(256)], dtype=np.uint8)
#: Code points begin at every byte but those that continue one.
_letter = np.array([b not in _spaces and not 128 <= b < 192 for b in range(256)], dtype=np.uint8)


def repeated_words(words: Words, texts: int) -> np.ndarray:
    """Per text, the words in runs of ``RUN`` words found twice or more in it, first included."""
    n = len(words.hash)
    out = np.zeros(texts, dtype=np.int64)
    if n < RUN:
        return out
    starts = np.flatnonzero(words.text[: n - RUN + 1] == words.text[RUN - 1 :])
    key = mixed(words.text[starts].astype(np.uint64))
    with np.errstate(over="ignore"):
        for k in range(RUN):
            key = mixed(key * np.uint64(5) + words.hash[starts + k])
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return out
    # equal keys are checked word by word
    left, right = starts[order[:-1][same]], starts[order[1:][same]]
    true = np.ones(len(left), dtype=bool)
    for k in range(RUN):
        true &= words.hash[left + k] == words.hash[right + k]
    hit = np.zeros(n + RUN, dtype=bool)
    for k in range(RUN):
        hit[left[true] + k] = True
        hit[right[true] + k] = True
    return np.bincount(words.text[hit[:n]], minlength=texts)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counted facts of some texts."""
    run = Run.of(texts)
    words = find_words(run, _words)
    n_words = np.bincount(words.text, minlength=len(texts))
    n_repeat = repeated_words(words, len(texts))
    return {
        "n_words": n_words,
        "word_chars": run.sums(_letter[run.raw]),
        "n_symbols": run.sums(_symbol[run.raw]),
        "n_dup_lines": np.array([repeated_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": n_repeat,
        "base_failed": (n_words < FEWEST) | (100 * n_repeat > REPEATED * n_words),
    }


@dataclass
class Model:
    """Weights of both kinds of features, and the calibration line."""

    words: np.ndarray
    chars: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    @staticmethod
    def empty() -> Model:
        return Model(np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0)


def word_features(run: Run) -> tuple[np.ndarray, np.ndarray]:
    words = find_words(run, _tokens)
    both, text = pairs(words)
    where = np.concatenate((words.text, text))
    return (np.concatenate((words.hash, both)) >> np.uint64(64 - BITS)).astype(np.int64), where


def char_features(run: Run) -> np.ndarray:
    """A feature for every byte: the hash of it and the three behind it."""
    raw = np.concatenate((run.raw, np.zeros(3, dtype=np.uint8))).astype(np.uint32)
    four = raw[:-3] | raw[1:-2] << np.uint32(8) | raw[2:-1] << np.uint32(16) | raw[3:] << np.uint32(24)
    with np.errstate(over="ignore"):
        return (four * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def raw_scores(texts: list[bytes], model: Model) -> np.ndarray:
    """The mean weight of a text's word features and of its character features, and the bias."""
    run = Run.of(texts)
    found, where = word_features(run)
    count = np.maximum(np.bincount(where, minlength=len(texts)), 1)
    of_words = np.bincount(where, weights=model.words[found], minlength=len(texts)) / count
    of_chars = run.sums(model.chars[char_features(run)]) / np.maximum(run.ends - run.begins, 1)
    return of_words + of_chars + model.bias


def _sparse(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of each text (characters behind words), their shares among its word
    or its character features, and where each text begins."""
    run = Run.of(texts)
    found, where = word_features(run)
    chars = char_features(run).astype(np.int64) + (1 << BITS)
    inside = np.repeat(np.arange(len(texts)), run.ends - run.begins)
    place = np.arange(len(inside)) + inside  # one byte stands behind each text
    key = np.concatenate((where * (2 << BITS) + found, inside * (2 << BITS) + chars[place]))
    key, counts = np.unique(key, return_counts=True)
    text, at = key // (2 << BITS), key % (2 << BITS)
    totals = np.stack((np.bincount(where, minlength=len(texts)), run.ends - run.begins))
    share = (counts / totals[(at >> BITS), text]).astype(np.float32)
    return at.astype(np.int32), share, np.searchsorted(text, np.arange(len(texts) + 1))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


Rows = list[tuple[np.ndarray, np.ndarray]]


def fit(rows: Rows, labels: np.ndarray, rate: float = 4.0, batch: int = 8) -> np.ndarray:
    """Weights, the bias last, by AdaGrad over mini-batches, both labels weighing the same."""
    size = (2 << BITS) + 1
    weights, squares = np.zeros(size), np.full(size, 1e-6)
    share = np.array([0.5 / max(1, (labels == v).sum()) for v in (0, 1)]) * len(labels)
    for _ in range(EPOCHS):
        for start in range(0, len(rows), batch):
            some = rows[start : start + batch]
            bias = np.full(len(some), size - 1, dtype=np.int32)
            at = np.concatenate([*(a for a, _ in some), bias])
            values = np.concatenate([*(v for _, v in some), np.ones(len(some))]).astype(np.float64)
            own = np.repeat(np.arange(len(some)), [len(a) for a, _ in some])
            own = np.concatenate((own, np.arange(len(some))))
            p = _logistic(np.bincount(own, weights=weights[at] * values, minlength=len(some)))
            y = labels[start : start + batch]
            error = (p - y) * share[y] / len(some)
            distinct, place = np.unique(at, return_inverse=True)
            g = np.bincount(place, weights=error[own] * values, minlength=len(distinct))
            squares[distinct] += g * g
            weights[distinct] -= rate * g / np.sqrt(squares[distinct])
    return weights


def calibrate(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the line that turns scores into log odds, by Newton steps.

    The targets are drawn in a little from 0 and 1, so a perfect split has a finite slope.
    """
    ones, zeros = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = max(float(np.abs(scores).max()), 1e-9)
    x = np.stack([scores / scale, np.ones(len(scores))])
    line = np.zeros(2)
    for _ in range(50):
        p = _logistic(line @ x)
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        line -= np.clip(np.linalg.solve(hessian, x @ (p - target) + 1e-6 * line), -5, 5)
    return float(line[0] / scale), float(line[1])


def train(labelled: DataFrame) -> Model:
    """The classifier from ``turn``, ``text``, ``label``; every fourth turn calibrates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, held_labels, kept = [], [], [], []
        for batch in batches:
            turns, marks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for start, texts in chunks(as_bytes(batch.column(1))):
                at, share, cut = _sparse(texts)
                for i in range(len(texts)):
                    row = at[cut[i] : cut[i + 1]], share[cut[i] : cut[i + 1]]
                    if turns[start + i] % 4 == 3:
                        kept.append(row)
                        held_labels.append(marks[start + i])
                    else:
                        rows.append(row)
                        labels.append(marks[start + i])
        labels, held_labels = np.array(labels, dtype=np.int64), np.array(held_labels, dtype=np.int64)
        if len(set(labels.tolist())) < 2:
            return
        weights = fit(rows, labels)
        slope, offset = 1.0, 0.0
        if len(set(held_labels.tolist())) == 2:
            held = np.array([weights[at] @ v.astype(np.float64) + weights[-1] for at, v in kept])
            slope, offset = calibrate(held, held_labels)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.tobytes()], pa.binary()), pa.array([slope]), pa.array([offset])],
            ["weights", "slope", "offset"],
        )

    one = labelled.select("turn", "text", "label").repartition(1).sortWithinPartitions("turn", "label", "text")
    found = map_batches(one, run, "weights binary, slope double, offset double").collect()
    if not found:
        return Model.empty()
    weights, size = np.frombuffer(found[0]["weights"]), 1 << BITS
    return Model(weights[:size], weights[size : 2 * size], float(weights[-1]), found[0]["slope"], found[0]["offset"])


FACTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, verdict string"


def judged(texts: list[bytes], model: Model) -> list[pa.Array]:
    """The columns of ``FACTS`` for some texts."""
    facts = counts(texts)
    probability = _logistic(model.slope * raw_scores(texts, model) + model.offset)
    verdict = np.where(facts["base_failed"], "fails", np.where(probability >= KEEP, "keep", np.where(probability >= DOUBT, "doubt", "reject")))
    return [*map(pa.array, facts.values()), pa.array(probability), pa.array(verdict.tolist(), pa.string())]


def judge(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, the counted facts, ``probability`` and ``verdict`` (keep, doubt, reject, fails)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["id", *(f.split(" ")[0] for f in FACTS.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in chunks(as_bytes(batch.column(1))):
                columns = [batch.column(0).slice(start, len(texts)), *judged(texts, shared.value)]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = dict(docs.dtypes)[id_col]
    return map_batches(docs.select(id_col, text_col), run, f"id {kind}, {FACTS}")


def keep(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose verdict is ``keep``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in chunks(as_bytes(batch.column(at))):
                verdict = judged(texts, shared.value)[-1]
                kept = pa.array([v == "keep" for v in verdict.to_pylist()], pa.bool_())
                yield batch.slice(start, len(texts)).filter(kept)

    return map_batches(docs, run, docs.schema)


def labelled(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
    text_col: str = "text", sample: int = SAMPLE,
) -> DataFrame:
    """About ``sample`` labelled texts at most, ready for ``train``."""
    return sampled(docs, labels, id_col, text_col, label_col, sample)
