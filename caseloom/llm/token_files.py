"""Token files: one concatenated id array, with Elias-Fano coded document boundaries.

Method: documents are put in order of their id and cut into blocks of about ``BLOCK_IDS``
token ids. A block holds its ids one behind the other, two bytes each where the vocabulary
allows it and else four, and the ends of its documents as an Elias-Fano code: of each end
the low bits stand in an array of fixed width, the high bits are counted in unary in a bit
vector. ``select`` finds the i-th one bit from sampled counts and one popcount per byte, so
an offset is read without a table of 64-bit numbers, in about 2 + log2(ids per document)
bits a document. Where a block starts in the whole array is the sum over the blocks before
it, taken when files are read.

A file set is a Parquet folder with one row per block, written by Spark's committer, so a
lost executor leaves no half file. Ids come from the tokenizers library. White space
between words never takes part in a token of this vocabulary, so a worker encodes each
piece of text once while it stays in its store, which is emptied beyond ``KEPT`` pieces.

Scale: one range shuffle of the texts by id; a task holds one block. Only the sums of the
blocks are put in order in one place.

Defined cases: a null text is an empty one and has the end id alone; null ids come first;
rows with equal ids are ordered by a hash of their text, repeated rows stay; an empty table
makes an empty file set, which reads as no rows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.taskcontext import TaskContext

from caseloom.llm.arrow import as_bytes, map_batches
from caseloom.session import checkpoint_dir

BLOCK_IDS = 2_000_000
KEPT = 500_000
LARGEST_FILE = 64 << 20
#: Up to so many blocks (of 16 bytes each) their starts are broadcast; beyond, joined.
MOST_STARTS = 500_000
#: Bytes of the bit vector per sampled count.
SAMPLE = 64


class EliasFano:
    """A non-decreasing list of numbers, readable at any place."""

    def __init__(self, count: int, width: int, low: bytes, high: bytes) -> None:
        self.count, self.width, self.low = count, width, low
        self.high = np.frombuffer(high, dtype=np.uint8)
        ones = np.bitwise_count(self.high).astype(np.int64)
        self.samples = np.concatenate(([0], np.cumsum(np.add.reduceat(ones, range(0, len(ones), SAMPLE))))) if len(ones) else np.zeros(1, np.int64)

    @staticmethod
    def encode(values: np.ndarray, top: int) -> EliasFano:
        """``values`` in order, none above ``top``."""
        count = len(values)
        width = max(0, (top // max(1, count)).bit_length() - 1)
        values = values.astype(np.uint64)
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        at = (values >> np.uint64(width)).astype(np.int64) + np.arange(count)
        high = np.zeros((top >> width) + count + 1, dtype=np.uint8)
        high[at] = 1
        return EliasFano(count, width, low, np.packbits(high, bitorder="little").tobytes())

    def select(self, wanted: np.ndarray) -> np.ndarray:
        """The places of the one bits with these numbers (from 0) in the bit vector."""
        group = np.searchsorted(self.samples, wanted, side="right") - 1
        left = wanted - self.samples[group]
        byte = group * SAMPLE
        going = np.ones(len(wanted), dtype=bool)
        while going.any():
            ones = np.where(going, np.bitwise_count(self.high[np.minimum(byte, len(self.high) - 1)]), 0).astype(np.int64)
            going &= left >= ones
            left = np.where(going, left - ones, left)
            byte = np.where(going, byte + 1, byte)
        place, seen = np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=np.int64)
        for bit in range(8):
            one = (self.high[byte] >> bit) & 1
            place = np.where((one == 1) & (seen == left), bit, place)
            seen += one
        return byte * 8 + place

    def values(self, at: np.ndarray) -> np.ndarray:
        """The numbers at these places."""
        if not len(at):
            return np.zeros(0, dtype=np.int64)
        high = (self.select(at) - at) << self.width
        if not self.width:
            return high
        raw = np.frombuffer(self.low + bytes(9), dtype=np.uint8)
        bit = at[:, None] * self.width + np.arange(self.width)
        bits = (raw[bit >> 3] >> (bit & 7)) & 1
        return high | (bits.astype(np.int64) << np.arange(self.width)).sum(axis=1)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


#: The vocabulary's own splitting rule (fixed value), as the file has it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Words:
    """Encodes texts piece by piece, by the tokenizers library, each piece once.

    A text of characters up to 255 needs no composing: it is put in small letters and cut
    here by the file's own rule, so only the model has to be asked. Other texts are cut at
    white space, and their words, like all texts that may hold a special token, go through
    the whole library.
    """

    def __init__(self, content: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        rules = json.loads(content)
        steps = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
        cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if steps != ["NFC", "Replace", "Lowercase"] or cuts[0].get("pattern") != {"Regex": SPLIT}:
            raise ValueError("white space may take part in tokens of this vocabulary")
        latin = [chr(c) for c in range(256)]
        letter, number, space = (
            re.escape("".join(c for c in latin if regex.fullmatch(kind, c))) for kind in (r"\p{L}", r"\p{N}", r"\s")
        )
        # letters come first, which changes nothing: no alternative for them begins with one
        rule = f"[{letter}]+|[{number}]|'(?:[stmd]|re|ve|ll)|[^{space}{letter}{number}]+"
        self.split = re.compile(rule).findall
        top = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if top <= 1 << 16 else "<u4")
        self.letters = byte_letters()
        self.known = Pieces()
        # the bare model, to be asked for many pieces in one text
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        vocab, suffix = self.tokenizer.get_vocab(with_added_tokens=False), rules["model"]["end_of_word_suffix"]
        if not suffix or any(c not in vocab or c + suffix not in vocab for c in self.letters):
            raise ValueError("this vocabulary does not mark the ends of its words")
        self.ends = np.zeros(top, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True

    def ids(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > KEPT:
            self.known.clear()
        get = self.known.__getitem__
        coded = []
        for data in texts:
            text = data.decode("utf-8", errors="replace")
            if "<|" in text or not _is_latin(text):
                coded.append(list(map(get, data.split())))
            else:
                coded.append(list(map(get, self.split(text.lower()))))
        self._fill()
        return [b"".join(pieces) for pieces in coded]

    def _fill(self) -> None:
        """Ids for the pieces met for the first time, into the places kept for them."""
        known, new = self.known, self.known.take_new()
        pieces = [p for p in new if type(p) is str]
        made = dict.fromkeys(new, b"")
        for start in range(0, len(pieces), 256):
            some = pieces[start : start + 256]
            found = self.model.encode_batch_fast([" ".join(map(self._written, some))], add_special_tokens=False)
            ids = np.array(found[0].ids, dtype=self.dtype)
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize).tolist()
            raw = ids.tobytes()
            made.update(zip(some, [raw[b:e] for b, e in zip([0, *cuts], cuts)], strict=True))
        words = [w for w in new if type(w) is bytes]
        if words:
            texts = [w.decode("utf-8", errors="replace") for w in words]
            for word, e in zip(words, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                made[word] = np.array(e.ids, dtype=self.dtype).tobytes()
        for piece, ids in made.items():
            known[piece].extend(ids)
            known[piece] = ids

    def _written(self, piece: str) -> str:
        """A piece as the vocabulary spells it."""
        if piece.isascii() and piece.isprintable():
            return piece
        return "".join(map(self.letters.__getitem__, piece.encode()))


class Pieces(dict):
    """The ids of pieces; a new one gets an empty place, to be filled with others."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, key) -> bytearray:
        self[key] = place = bytearray()
        self.new.append(key)
        return place

    def take_new(self) -> list:
        new, self.new = self.new, []
        return new


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def words(content: str) -> Words:
    """One encoder per vocabulary and Python worker."""
    return Words(content)


def _block_row(part: int, seq: int, ids: list[pa.Array], ends: list[int], payload: list[bytes], dtype: np.dtype) -> pa.RecordBatch:
    top = ends[-1]
    code = EliasFano.encode(np.array(ends, dtype=np.int64), top)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([seq], pa.int32()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays(ids)),
            pa.array([top], pa.int64()),
            pa.array([dtype.itemsize], pa.int32()),
            pa.array([code.width], pa.int32()),
            pa.array([code.low], pa.binary()),
            pa.array([code.high.tobytes()], pa.binary()),
            pa.array([b"".join(payload)], pa.binary()),
        ],
        ["part", "seq", "doc_ids", "n_ids", "id_bytes", "low_bits", "low", "high", "ids"],
    )


def write(
    docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS,
) -> str:
    """Encode ``docs`` into a file set and return its path (a new one in the shared folder)."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    file = Path(vocabulary)
    if file.stat().st_size > LARGEST_FILE:
        raise ValueError(f"{vocabulary} is larger than {LARGEST_FILE} bytes")
    content = spark.sparkContext.broadcast(file.read_text())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = words(content.value)
        end = np.array([end_id], dtype=coder.dtype).tobytes()
        part, seq, ids, ends, payload, held = TaskContext.get().partitionId(), 0, [], [], [], 0
        for batch in batches:
            texts = [t or b"" for t in as_bytes(batch.column(1))]
            for at in range(0, len(texts), 500):
                for i, coded in enumerate(coder.ids(texts[at : at + 500])):
                    coded += end
                    size = len(coded) // coder.dtype.itemsize
                    if ids and held + size > block_ids:
                        yield _block_row(part, seq, ids, ends, payload, coder.dtype)
                        seq, ids, ends, payload, held = seq + 1, [], [], [], 0
                    held += size
                    ids.append(batch.column(0).slice(at + i, 1))
                    ends.append(held)
                    payload.append(coded)
        if ids:
            yield _block_row(part, seq, ids, ends, payload, coder.dtype)

    kind = dict(docs.dtypes)[id_col]
    schema = (
        f"part int, seq int, doc_ids array<{kind}>, n_ids long, id_bytes int, low_bits int, "
        "low binary, high binary, ids binary"
    )
    ordered = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("id", "tie")
        .sortWithinPartitions("id", "tie")
    )
    map_batches(ordered.drop("tie"), run, schema).write.mode("errorifexists").parquet(path)
    return path


def _read(spark: SparkSession, path: str, column: str, kind: str, of_ids) -> DataFrame:
    """``id``, ``start``, ``n_tokens`` and what ``of_ids`` makes of each document's ids."""
    blocks = spark.read.parquet(path)
    order = Window.orderBy("part", "seq")
    starts = blocks.select("part", "seq", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("start"))
    if starts.count() <= MOST_STARTS:
        starts = F.broadcast(starts)
    blocks = blocks.join(starts, ["part", "seq"])
    names = ["doc_ids", "start", "id_bytes", "low_bits", "low", "high", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs = batch.column(0)[i].values
                start, size, width, low, high, raw = (batch.column(c)[i].as_py() for c in range(1, 7))
                code = EliasFano(len(docs), width, low, high)
                ids = np.frombuffer(raw, dtype=f"<u{size}")
                for at in range(0, len(docs), 5000):
                    some = np.arange(at, min(at + 5000, len(docs)))
                    ends = code.values(some)
                    first = code.values(np.array([at - 1]))[0] if at else 0
                    begins = np.concatenate(([first], ends[:-1]))
                    made = [of_ids(ids[b:e]) for b, e in zip(begins.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [docs.slice(at, len(some)), pa.array(begins + start), pa.array(ends - begins), pa.array(made)],
                        ["id", "start", "n_tokens", column],
                    )

    element = dict(blocks.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")
    return map_batches(blocks.select(*names), run, f"id {element}, start long, n_tokens long, {column} {kind}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``start``, ``n_tokens`` and ``ids`` (array of int) of every document."""
    return _read(spark, path, "ids", "array<int>", lambda ids: ids.astype(np.int32))


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``start``, ``n_tokens`` and ``crc``: of the ids as little-endian 32-bit numbers."""
    return _read(spark, path, "crc", "long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))
