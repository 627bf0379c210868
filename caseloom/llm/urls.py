"""Allow and block verdicts for URLs from a list of hosts and paths.

Method: each listed entry (host and path prefix, ``example.com/en/``) is a 64-bit xxhash
key in a sorted array on disk, with the full strings in a second file. Tasks memory-map
both, so all workers of a machine share one copy. A URL is probed with every host suffix
and path prefix of a length that the list has; all probes of a batch go through one
vectorised binary search, and a hit counts only when the stored string is equal, whatever
the keys say. The longest entry that fits decides; a URL that none fits is allowed.

Scale: URLs are not shuffled. The list is cut by key into shards of about
``SHARD`` entries, each sent to the executors as a file of bounded size and probed in one
pass; the passes follow each other inside one stage, so the list may be of any length.

Defined cases: a null URL, or one without ``://``, has an empty host and path and fits no
entry; repeated rows get one result row each; entries that are null are left out, of equal
entries with different verdicts ``block`` wins; empty tables give no rows (URLs) or allow
all (list).
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from caseloom.llm.arrow import map_batches
from caseloom.session import cut_lineage

SHARD = 1_000_000
SEED = 42
DEFAULT = "allow"

_lower = {c: c + 32 for c in range(65, 91)}


def host_and_path(url: str | None) -> tuple[str, str]:
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    stop = min((i for i in (rest.find("?", end), rest.find("#", end)) if i >= 0), default=len(rest))
    return rest[:end].translate(_lower), rest[end:stop]


def write_shard(prefix: str, entries: list[tuple[str, str]]) -> list[str]:
    """The sorted key array (8 bytes a key) and, in its order, the strings: the files' paths."""
    texts = [(entry.encode(), verdict) for entry, verdict in entries]
    keys = np.array([xxhash.xxh64_intdigest(t, SEED) for t, _ in texts], dtype=np.uint64)
    order = np.argsort(keys, kind="stable")
    lengths = np.array([len(texts[i][0]) for i in order], dtype=np.int64)
    hosts = {e.partition("/")[0].count(".") + 1 for e, _ in entries}
    paths = {len(e) - e.index("/") if "/" in e else 0 for e, _ in entries}
    parts = {
        "keys": keys[order].tobytes(),
        "ends": np.concatenate(([0], np.cumsum(lengths))).astype(np.int64).tobytes(),
        "blocked": bytes(texts[i][1] == "block" for i in order),
        "text": b"".join(texts[i][0] for i in order),
        "shape": json.dumps([sorted(hosts), sorted(paths)]).encode(),
    }
    for part, data in parts.items():
        Path(f"{prefix}-{part}").write_bytes(data)
    return [f"{prefix}-{part}" for part in parts]


class Shard:
    """One memory-mapped shard."""

    def __init__(self, prefix: str) -> None:
        self.keys = np.memmap(f"{prefix}-keys", dtype=np.uint64, mode="r")
        self.ends = np.memmap(f"{prefix}-ends", dtype=np.int64, mode="r")
        self.text = np.memmap(f"{prefix}-text", dtype=np.uint8, mode="r")
        self.blocked = np.memmap(f"{prefix}-blocked", dtype=np.uint8, mode="r")
        self.labels, self.prefixes = json.loads(Path(f"{prefix}-shape").read_text())

    def probes(self, host: str, path: str) -> list[bytes]:
        """Host suffixes and path prefixes of the lengths that the shard has."""
        if not host:
            return []
        parts = host.rsplit(".", max(self.labels))
        tails = [".".join(parts[-n:]) for n in self.labels if n < len(parts)]
        tails += [host] if len(parts) in self.labels else []
        return [(t + path[:n]).encode() for t in tails for n in self.prefixes if n <= len(path)]

    def find(self, probes: list[bytes]) -> np.ndarray:
        """The place of each probe in the shard, or -1."""
        wanted = np.array([xxhash.xxh64_intdigest(p, SEED) for p in probes], dtype=np.uint64)
        first = np.searchsorted(self.keys, wanted, side="left")
        last = np.searchsorted(self.keys, wanted, side="right")
        found = np.full(len(probes), -1)
        for i in np.flatnonzero(first < last).tolist():
            for at in range(first[i], last[i]):
                if self.text[self.ends[at] : self.ends[at + 1]].tobytes() == probes[i]:
                    found[i] = at
                    break
        return found

    def entry(self, at: int) -> str:
        return self.text[self.ends[at] : self.ends[at + 1]].tobytes().decode()


def _probe(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = [Shard(SparkFiles.get(name)) for name in names]
        for batch in batches:
            split = [host_and_path(u) for u in batch.column(1).to_pylist()]
            best: list[tuple[int, str, str]] = [(-1, "", DEFAULT)] * len(split)
            for shard in shards:
                probes = [shard.probes(h, p) for h, p in split]
                owner = np.repeat(np.arange(len(split)), [len(p) for p in probes])
                found = shard.find([p for own_probes in probes for p in own_probes])
                hit = found >= 0
                for i, at in zip(owner[hit].tolist(), found[hit].tolist()):
                    entry = shard.entry(at)
                    if len(entry) > best[i][0]:
                        best[i] = (len(entry), entry, "block" if shard.blocked[at] else "allow")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h for h, _ in split], pa.string()),
                    pa.array([p for _, p in split], pa.string()),
                    pa.array([rule if n >= 0 else None for n, rule, _ in best], pa.string()),
                    pa.array([verdict for _, _, verdict in best], pa.string()),
                ],
                ["id", "host", "path", "rule", "verdict"],
            )

    return run


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", shard: int = SHARD
) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule`` and ``verdict`` of every URL.

    ``rules`` has the columns ``entry`` (host, then a path prefix that starts with a slash)
    and ``verdict`` (``allow`` or ``block``).
    """
    spark = pages.sparkSession
    known = rules.where("entry is not null and verdict is not null")
    known = cut_lineage(known.groupBy("entry").agg(F.max("verdict").alias("verdict")))
    count = -(-known.count() // shard)
    # Built beside the driver; Spark hands the files to every executor.
    home, names = tempfile.mkdtemp(prefix="urls-"), []
    for i in range(count):
        rows = known.where(F.pmod(F.xxhash64("entry"), F.lit(count)) == i).collect()
        if not rows:
            continue
        names.append(f"urls-{uuid.uuid4().hex}")
        for file in write_shard(f"{home}/{names[-1]}", [(r["entry"], r["verdict"]) for r in rows]):
            spark.sparkContext.addFile(file)
    kind = dict(pages.dtypes)[id_col]
    schema = f"id {kind}, host string, path string, rule string, verdict string"
    return map_batches(pages.select(id_col, url_col), _probe(names), schema)
