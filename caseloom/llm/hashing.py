"""Words of many texts at once, as numbers: one pass of numpy over the bytes of a run.

A word's hash is a polynomial of its bytes in 64-bit arithmetic, read off one running sum
over the whole run, so no word becomes a Python object. Words of over ``LONG`` bytes are
hashed with xxhash, since polynomials of long texts can be made to meet.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import xxhash

LONG = 200
_base = 0x9E3779B97F4A7C15 | 1
_inverse = pow(_base, -1, 1 << 64)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        made = [np.full(size, b, dtype=np.uint64) for b in (_base, _inverse)]
        for powers in made:
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)
    return made[0], made[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; the length is rounded up and kept."""
    return _powers(max(1 << 20, 1 << (size - 1).bit_length()))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all their bits."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


@dataclass
class Run:
    """Some texts, one behind the other with a zero byte after each."""

    raw: np.ndarray
    begins: np.ndarray
    ends: np.ndarray

    @staticmethod
    def of(texts: list[bytes]) -> Run:
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        raw = np.frombuffer(b"\0".join([*texts, b""]), dtype=np.uint8)
        begins = np.cumsum(lengths + 1) - lengths - 1
        return Run(raw, begins, begins + lengths)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of ``values`` (one per byte) in each text."""
        total = np.concatenate(([0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)))
        return total[self.ends] - total[self.begins]


@dataclass
class Words:
    """The words of a run: where they begin and end, their hash, and their text's number."""

    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text: np.ndarray


def find_words(run: Run, kinds: np.ndarray) -> Words:
    """Maximal runs of bytes of one kind; ``kinds`` gives each byte's kind, 0 is none.

    The zero byte behind a text has to be of kind 0, or words may cross texts; a zero byte
    inside a text is then none of a word's bytes either, unless ``inside`` says so.
    """
    kind = kinds[run.raw]
    kind[run.ends] = 0
    before = np.concatenate((np.zeros(1, dtype=kind.dtype), kind[:-1]))
    change = np.flatnonzero(kind != before)
    begin = change[kind[change] != 0]
    after = np.concatenate((kind[1:], np.zeros(1, dtype=kind.dtype)))
    end = np.flatnonzero((kind != after) & (kind != 0)) + 1
    power, inverse = powers(len(run.raw) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate(([np.uint64(0)], np.cumsum((run.raw.astype(np.uint64) + np.uint64(1)) * power[: len(run.raw)])))
        hashes = mixed((total[end] - total[begin]) * inverse[begin])
    for i in np.flatnonzero(end - begin > LONG).tolist():
        hashes[i] = xxhash.xxh64_intdigest(run.raw[begin[i] : end[i]].tobytes())
    text = np.searchsorted(run.begins, begin, side="right") - 1
    return Words(begin, end, hashes, text)


def pairs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each two neighbouring words of a text."""
    same = words.text[1:] == words.text[:-1]
    with np.errstate(over="ignore"):
        both = mixed(words.hash[:-1] * np.uint64(3) + words.hash[1:])
    return both[same], words.text[:-1][same]
