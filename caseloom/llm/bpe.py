"""Byte-level BPE: text to token ids and back.

Method: a word is an array of part ids with the rank of each adjacent pair beside it. The
lowest rank is looked for, the boundary it stands at is deleted, and the ranks of its two
neighbours are refreshed, until no adjacent pair has a rank. Words met for the first time
in a batch are worked on together, one array row per word, so each step is a handful of
numpy calls for thousands of words. A word of more than ``SHORT`` bytes goes through a
heap with the same order (lowest rank, then leftmost), since scanning it again and again
would take time in the square of its length.

The vocabulary file (a byte-level BPE of the tokenizers library) is read by the driver and
broadcast; its size is a property of the file and checked. Each Python worker keeps the
ids of words it has met, and starts afresh beyond ``KEPT`` of them.

Defined cases: a null text is an empty one and has no ids; special tokens that occur in a
text get their own id, as in the library; repeated rows get one result row each; an empty
table gives no rows. Decoding replaces bytes that are no UTF-8 as the library does.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from caseloom.llm.arrow import map_batches

#: The splitting rule of byte-level BPE (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHORT = 64
#: Words are worked on in arrays of these widths.
WIDTHS = [next(w for w in (4, 6, 8, 10, 12, 16, 24, 32, SHORT) if n <= w) for n in range(SHORT + 1)]
KEPT = 350_000
#: Rows of a batch that are Python objects at a time.
ROWS = 500
LARGEST_FILE = 64 << 20
NO_RANK = np.int32(2**31 - 1)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def latin_pattern() -> str:
    """``PATTERN`` for characters up to 255, their classes written out.

    The standard library's ``re`` has no classes of letters and numbers, but is several
    times as fast. Letters come first here, which changes nothing: no alternative for
    them can begin where another one does, but for a space.
    """
    latin = [chr(c) for c in range(256)]
    letter, number, space = (
        re.escape("".join(c for c in latin if regex.fullmatch(kind, c))) for kind in (r"\p{L}", r"\p{N}", r"\s")
    )
    return (
        rf" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{space}{letter}{number}]+"
        rf"|[{space}]+(?![^{space}])|[{space}]+"
    )


class Bpe:
    """Encoder and decoder for one vocabulary file's text."""

    def __init__(self, content: str) -> None:
        file = json.loads(content)
        model, letters = file["model"], byte_letters()
        pre = file["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or file["normalizer"]:
            raise ValueError("not a byte-level BPE vocabulary without a normaliser")
        if pre["add_prefix_space"] or not pre["use_regex"] or model.get("ignore_merges"):
            raise ValueError("this splitting rule is not supported")
        vocab = model["vocab"]
        byte_of = {letter: byte for byte, letter in letters.items()}
        self.special = {t["content"]: np.int32(t["id"]).tobytes() for t in file["added_tokens"]}
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        bytes_of = [b""] * size
        for token, i in vocab.items():
            bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in special.items():
            bytes_of[i] = token.encode()
        self.all_bytes = np.frombuffer(b"".join(bytes_of), dtype=np.uint8)
        self.sizes = np.fromiter(map(len, bytes_of), dtype=np.int64, count=size)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.first = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {
            (vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        keys = np.array([a << 32 | b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(2**63 - 1))
        self.ranks = np.append(order.astype(np.int32), NO_RANK)
        self.merged = np.array([new for _, new in self.merges.values()], dtype=np.int32)
        self._split_any = regex.compile(PATTERN).findall
        self._split_latin = re.compile(latin_pattern()).findall
        self.find_special = (
            regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
            if self.special
            else None
        )
        self.known: dict[str, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of adjacent parts; -1 stands for no part."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (right >= 0), self.ranks[at], NO_RANK)

    def _merge_rows(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids of words of at most ``width`` bytes, all worked on together."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), dtype=np.uint8)
        parts = self.first[raw.reshape(-1, width)]
        parts[np.arange(width) >= lengths[:, None]] = -1
        parts = np.hstack([parts, np.full((len(words), 1), -1, dtype=np.int32)])
        rank = self._rank(parts[:, :-1], parts[:, 1:])
        alive = np.arange(len(words))
        done, sizes, ids = [], [], []
        while len(alive):
            best = rank.argmin(axis=1)
            rows = np.arange(len(alive))
            lowest = rank[rows, best]
            over = lowest == NO_RANK
            if over.any():
                ended = parts[over]
                done.append(alive[over])
                sizes.append((ended >= 0).sum(axis=1))
                ids.append(ended[ended >= 0])
                going = ~over
                alive, best, lowest = alive[going], best[going], lowest[going]
                parts, rank, rows = parts[going], rank[going], rows[: len(alive)]
                continue
            # the boundary behind ``best`` goes, and with it one column of every row
            parts[rows, best] = self.merged[lowest]
            keep = np.ones(parts.shape, dtype=bool)
            keep[rows, best + 1] = False
            parts = parts[keep].reshape(len(alive), -1)
            keep = np.ones(rank.shape, dtype=bool)
            keep[rows, best] = False
            rank = np.hstack([rank[keep].reshape(len(alive), -1), np.full((len(alive), 1), NO_RANK, np.int32)])
            rank = rank[:, : max(1, parts.shape[1] - 1)]
            inner = best + 1 < parts.shape[1]
            r, b = rows[inner], best[inner]
            rank[r, b] = self._rank(parts[r, b], parts[r, b + 1])
            r, b = rows[best > 0], best[best > 0] - 1
            rank[r, b] = self._rank(parts[r, b], parts[r, b + 1])
        made = np.concatenate(ids).tobytes()
        ends = np.cumsum(np.concatenate(sizes)) * 4
        found: list[bytes] = [b""] * len(words)
        for i, start, end in zip(np.concatenate(done).tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
            found[i] = made[start:end]
        return found

    def _merge_long(self, word: bytes) -> bytes:
        """The same for one long word, with a heap and linked neighbours."""
        parts = self.first[np.frombuffer(word, dtype=np.uint8)].tolist()
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        merges = self.merges
        heap = [
            (merges[pair][0], i, *pair) for i, pair in enumerate(zip(parts, parts[1:])) if pair in merges
        ]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = merges[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else -1
                if y >= 0 and (pair := (parts[x], parts[y])) in merges:
                    heapq.heappush(heap, (merges[pair][0], x, *pair))
        return np.array([p for p in parts if p >= 0], dtype=np.int32).tobytes()

    def learn(self, words: Iterable[str]) -> None:
        """Work out the ids of new words."""
        by_width: dict[int, list[str]] = {}
        for word in words:
            size = len(word) if word.isascii() else len(word.encode())
            by_width.setdefault(WIDTHS[size] if size <= SHORT else 0, []).append(word)
        for width, group in by_width.items():
            if width:
                for start in range(0, len(group), 1 << 13):
                    some = group[start : start + (1 << 13)]
                    self.known.update(zip(some, self._merge_rows([w.encode() for w in some], width)))
            else:
                self.known.update((w, self._merge_long(w.encode())) for w in group)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each."""
        split = [self._pieces(text) for text in texts]
        known = self.known
        new = set().union(*split).difference(known, self.special)
        if len(known) + len(new) > KEPT:
            known.clear()
            new = set().union(*split).difference(self.special)
        self.learn(new)
        known.update(self.special)
        get = known.__getitem__
        return [b"".join(map(get, pieces)) for pieces in split]

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._split_any(text)
        return self._split_latin(text)

    def _pieces(self, text: str) -> list[str]:
        """Words, and the special tokens between them.

        No word equals a special token: what surrounds it in a text is split apart from
        it, and a text that holds it anywhere is cut there first.
        """
        if self.find_special is None or not (found := list(self.find_special.finditer(text))):
            return self.split(text)
        pieces, end = [], 0
        for match in found:
            pieces += self.split(text[end : match.start()])
            pieces.append(match[0])
            end = match.end()
        return pieces + self.split(text[end:])

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of consecutive runs of ids; ``ends`` are the places where each ends."""
        sizes = self.sizes[ids]
        done = np.concatenate(([0], np.cumsum(sizes)))
        place = np.arange(done[-1]) + np.repeat(self.starts[ids] - done[:-1], sizes)
        raw = self.all_bytes[place]
        cuts = done[np.concatenate(([0], ends))]
        data = raw.tobytes()
        begins = raw[cuts[:-1][cuts[:-1] < len(raw)]]
        try:
            data.decode()
            whole = not ((begins >= 128) & (begins < 192)).any()
        except UnicodeDecodeError:
            whole = False
        if whole:
            return pa.Array.from_buffers(
                pa.string(), len(ends), [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data)]
            )
        texts = [data[a:b].decode("utf-8", errors="replace") for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        return pa.array(texts, pa.string())


@lru_cache(maxsize=2)
def bpe(content: str) -> Bpe:
    """One encoder per vocabulary and Python worker."""
    return Bpe(content)


def _content(path: str) -> str:
    """The vocabulary file's text; its size bounds what is broadcast."""
    file = Path(path)
    if file.stat().st_size > LARGEST_FILE:
        raise ValueError(f"{path} is larger than {LARGEST_FILE} bytes")
    return file.read_text()


def _runs(texts: list, size: int = 1 << 21) -> Iterator[list]:
    """Consecutive texts of about ``size`` characters or ids; none is cut."""
    run, held = [], 0
    for text in texts:
        run.append(text)
        held += len(text)
        if held > size:
            yield run
            run, held = [], 0
    if run:
        yield run


def _lists(coded: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, coded)]) // 4
    flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(coded))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)


def _encoded(batch: pa.RecordBatch, coder: Bpe) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """Ids of rows and of their texts, a few texts at a time."""
    for start in range(0, batch.num_rows, ROWS):
        some, at = batch.slice(start, ROWS), 0
        for texts in _runs([t or "" for t in some.column(1).to_pylist()]):
            yield some.column(0).slice(at, len(texts)), _lists(coder.encode_batch(texts))
            at += len(texts)


def _decoded(lists: pa.ListArray, coder: Bpe) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    texts = coder.decode_batch(lists.flatten().to_numpy(), np.cumsum(sizes))
    if lists.null_count:
        return pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string()))
    return texts


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``ids`` (array of int) of every text."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(_content(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(vocabulary.value)
        for batch in batches:
            for rows, lists in _encoded(batch, coder):
                yield pa.RecordBatch.from_arrays([rows, lists], ["id", "ids"])

    kind = dict(docs.dtypes)[id_col]
    return map_batches(docs.select(id_col, text_col), run, f"id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``id``, ``ids`` and ``text``, the text that the ids stand for; null ids stay null."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(_content(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(vocabulary.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                texts = _decoded(some.column(1), coder)
                yield pa.RecordBatch.from_arrays([*some.columns, texts], ["id", "ids", "text"])

    kind = dict(encoded.dtypes)["id"]
    return map_batches(encoded.select("id", "ids"), run, f"id {kind}, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``decode`` of ``encode``, in one pass and one Python worker per task."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(_content(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(vocabulary.value)
        for batch in batches:
            for rows, lists in _encoded(batch, coder):
                yield pa.RecordBatch.from_arrays([rows, lists, _decoded(lists, coder)], ["id", "ids", "text"])

    kind = dict(docs.dtypes)[id_col]
    return map_batches(docs.select(id_col, text_col), run, f"id {kind}, ids array<int>, text string")
