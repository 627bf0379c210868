"""Token alignment against both libraries and the plainest comparison of byte ranges."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from caseloom.llm import alignment
from test_llm import ROWS, SCHEMA, bag, docs, nothing  # noqa: F401

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MORE = [
    (30, "a  b   c    \n  d "), (31, " "), (32, "   "), (33, "▁"), (34, "a▁ b"), (35, "Ａ ﬁ ① é"), (36, "\x00 \x1c"),
    (37, "<s> </s><unk> <0x41> <|endoftext|>"), (38, "मनीष 漢字仮名 😀😀"), (39, "x" * 3000 + " y"),
]
PATHS = (A, B)


@pytest.fixture(scope="module")
def letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@pytest.fixture(scope="module")
def cut(letters):
    """Both sides' ids and the bytes of each token, or nothing."""
    left = Tokenizer.from_file(A)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=B)

    def run(text):
        if not text:
            return [], []
        a = [(i, bytes(letters[c] for c in left.id_to_token(i))) for i in left.encode(" " + text, add_special_tokens=False).ids]
        b = [
            (i, bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode())
            for i in right.encode(text)
        ]
        raw = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == raw == b"".join(t for _, t in b) else ([], [])

    return run


def ranges(tokens):
    found, at = [], 0
    for i, raw in tokens:
        found.append((i, at, at + len(raw)))
        at += len(raw)
    return found


def summaries(texts, cut):
    """The rows of ``summarise`` for texts by id."""
    links, counts, listings, sizes = {}, Counter(), {}, {}
    for key, text in texts:
        a, b = map(ranges, cut(text))
        ends = {e: i for i, _, e in b}
        links[key] = [(i, ends[e]) for i, _, e in a if e in ends]
        counts.update(links[key])
        sizes[key] = len(a), len(b)
        groups, sides = [], [iter(a), iter(b)]
        for end in sorted(set(ends) & {e for _, _, e in a}):
            inside = [[], []]
            for side, own in zip(sides, inside):
                for i, _, e in side:
                    own.append(str(i))
                    if e == end:
                        break
            groups.append(",".join(inside[0]) + "|" + ",".join(inside[1]))
        listings[key] = ";".join(groups)
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [
        (
            key, *sizes[key], len(links[key]), sum(counts[p] == best[p[1]] for p in links[key]),
            sum(counts[p] for p in links[key]),
            hashlib.sha256(listings[key].encode()).hexdigest() if sizes[key][0] else "",
        )
        for key, _ in texts
    ]


def rows_of(df):
    return df.select("id", "n_a", "n_b", "n_links", "n_best", "count_sum", "groups_sha256").collect()


def test_against_both_libraries(spark, cut):
    rows = list({key: (key, text) for key, text in ROWS if key is not None}.values()) + MORE
    df = spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id")
    wanted = summaries(rows, cut)
    assert bag(tuple(r) for r in rows_of(alignment.summarise(df, *PATHS))) == bag(wanted)
    # the same from blocks of a few texts, and from one
    assert bag(tuple(r) for r in rows_of(alignment.summarise(df, *PATHS, block_bytes=40))) == bag(wanted)
    assert sum(w[1] == 0 for w in wanted) >= 3  # null, empty, look-alikes of the space


def test_given_texts(spark, small, cut):
    df = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = bag(tuple(r) for r in rows_of(alignment.summarise(df, *PATHS, block_bytes=50_000)))
    assert got == bag(summaries(rows, cut))


def test_random_texts(spark, cut):
    random.seed(3)
    signs = ["a", "b", "the", " ", "  ", "\n", "é", "漢", "1", "😀", "don't", "\t", ".", "ing", "́", "▁"]
    rows = [(i, "".join(random.choices(signs, weights=[9] * 15 + [0.2], k=random.randint(0, 60)))) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert bag(tuple(r) for r in rows_of(alignment.summarise(df, *PATHS))) == bag(summaries(rows, cut))


def test_repeated_rows_count_each_time(spark, cut):
    rows = [(i % 2, "one text for all rows") for i in range(50)]
    got = rows_of(alignment.summarise(spark.createDataFrame(rows, SCHEMA).repartition(4), *PATHS))
    assert len(got) == 50
    assert all(r["count_sum"] == 50 * r["n_links"] and r["n_best"] == r["n_links"] > 0 for r in got)


def test_overlaps_and_groups(spark, cut):
    rows = [(i, t) for i, t in enumerate(["don't stop  now", "", None, "mañana 漢字", "▁", "Internationalisierungsstrategie"])]
    found = {r["id"]: r for r in alignment.align(spark.createDataFrame(rows, SCHEMA), *PATHS).collect()}
    assert len(found) == len(rows)
    for key, text in rows:
        a, b = map(ranges, cut(text))
        row = found[key]
        assert row["a_ids"] == [i for i, _, _ in a] and row["a_ends"] == [e for _, _, e in a]
        assert row["b_ids"] == [i for i, _, _ in b] and row["b_ends"] == [e for _, _, e in b]
        overlaps = [(i, j) for i, (_, s, e) in enumerate(a) for j, (_, t, f) in enumerate(b) if s < f and t < e]
        assert list(zip(row["over_a"], row["over_b"])) == overlaps
        shared = sorted({e for _, _, e in a} & {e for _, _, e in b})
        assert row["a_groups"] == [sum(end < e for end in shared) for _, _, e in a]
        assert row["b_groups"] == [sum(end < e for end in shared) for _, _, e in b]


def test_clashing_columns_and_empty_tables(spark, docs, nothing):  # noqa: F811
    assert alignment.summarise(docs, *PATHS).count() == len(ROWS)
    assert alignment.align(docs, *PATHS).count() == len(ROWS)
    assert alignment.summarise(nothing, *PATHS).count() == alignment.align(nothing, *PATHS).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], SCHEMA)
    assert bag(tuple(r) for r in rows_of(alignment.summarise(blank, *PATHS))) == bag((i, 0, 0, 0, 0, 0, "") for i in (1, 2))
