"""Every operator against the shortest way to its result, on small and awkward tables."""

from __future__ import annotations

import math
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from caseloom.llm import bpe, classifier, contamination, lm, pii, quality, sharding, simhash, token_files, urls  # noqa: E402
from caseloom.llm.queries import LLM_QUERIES, LLM_SQL  # noqa: E402
from harness import connect, differences  # noqa: E402

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

PROSE = (
    "the quick brown fox jumps over the lazy dog while seven small birds sing in a tall green tree "
    "and nobody in the village below has any idea why they do so every single morning"
)
#: Ids, texts: nulls, empty and blank texts, copies, near copies, long texts and odd characters.
ROWS = [
    (1, PROSE),
    (2, PROSE),
    (3, PROSE.upper()),
    (4, PROSE.replace("tall", "tall,")),
    (5, None),
    (6, ""),
    (7, " \n\t "),
    (8, "word"),
    (9, "two words"),
    (10, "x" * 70_000),
    (11, "a b c d e " * 9_000),
    (12, "line one is here\nline one is here\n\nline two is here\nline one is here"),
    (13, "é\u200b漢字 😀 ½² \x00\x1c don't <|endoftext|> x"),
    (14, "mail jane.doe@example.org or +49 151 2345 6789, host 10.0.0.255 not 10.0.0.256, card 4111 1111 1111 1111"),
    (15, PROSE[:90]),
    (None, "a row without an id"),
    (None, "a row without an id"),
    (16, "### $$$ %%% &&& *** " * 12),
    (16, "### $$$ %%% &&& *** " * 12),
    (-5, "negative ids are ids too"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    """The rows with further columns whose names the operators use themselves."""
    plain = spark.createDataFrame(ROWS, SCHEMA)
    return plain.select(
        F.lit("x").alias("id"), F.lit(1.5).alias("score"), F.lit(None).cast("string").alias("lang"), "doc_id", "text",
        F.length("text").cast("long").alias("n_chars"), F.lit(0).alias("fp"), F.lit(True).alias("kept"),
        F.lit("k").alias("Key0"), F.lit(3).alias("segment"), F.lit(1).alias("block"),
    ).repartition(3, "text")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(rows):
    return sorted(map(repr, rows))


# contamination


ITEMS = [
    (10, " ".join(PROSE.split()[3:18])),
    (2, "Quick brown"),
    (30, "no such words anywhere near"),
    (4, None),
    (5, "!!"),
    (None, "lazy dog while"),
    (10, " ".join(PROSE.split()[3:18])),
    (77, "word"),
]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("limits", [{}, {"segment_tokens": 40}, {"block_bytes": 30}])
def test_contamination(docs, bench, limits):
    got = contamination.mark(docs, bench, **limits).collect()
    ours = [
        (r["id"], r["n_words"], r["n_hit"], len(r["items"]), brute.sha(",".join(r["items"])), r["n_hit"] > 0) for r in got
    ]
    assert bag(ours) == bag((d, *brute.contamination(t, ITEMS)) for d, t in ROWS)


def test_proximity(spark, bench):
    words = PROSE.split()[3:13]
    texts = [
        (1, " ".join(words)),
        (2, " ".join([*words[:4], "extra", *words[4:]])),
        (3, " ".join([*words[:4], "extra", "more", *words[4:7], "and", "again", "far", *words[7:]])),
        (4, " ".join([words[1], words[0], *words[2:]])),
        (5, " ".join(reversed(words))),
        (6, " ".join(words[:9])),
        (7, " ".join(words[1:] + words[:1])),
    ]
    items = [(1, " ".join(words))]
    got = contamination.mark(
        spark.createDataFrame(texts, SCHEMA).coalesce(1), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {r["id"]: bool(r["near"]) for r in got.collect()} == {d: brute.near(t, items[0][1]) for d, t in texts}


def test_contamination_empty(docs, bench, nothing):
    empty = nothing.withColumnRenamed("doc_id", "item_id")
    assert contamination.mark(nothing, bench).count() == 0
    assert {r["n_hit"] for r in contamination.mark(docs, empty).collect()} == {0}
    kept = contamination.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    clean = [(d, t) for d, t in ROWS if not brute.contamination(t, ITEMS)[4]]
    assert bag((r["doc_id"], r["text"]) for r in kept.collect()) == bag(clean)


def test_numbers_pack():
    rnd = random.Random(1)
    values = np.array([rnd.randrange(1 << rnd.randrange(1, 32)) for _ in range(5000)], dtype=np.int64)
    assert (contamination.unpack(contamination.pack(values)) == values).all()
    assert len(contamination.unpack(contamination.pack(values[:0]))) == 0


# personal data


def test_personal_data(docs):
    got = pii.find(docs).collect()
    ours = [(r["id"], [tuple(s) for s in r["base"]]) for r in got]
    assert bag(ours) == bag((d, brute.personal(t)) for d, t in ROWS)
    assert all(set(map(tuple, r["base"])) <= set(map(tuple, r["spans"])) for r in got)


def test_plain_spans_of_random_texts():
    rnd = random.Random(2)
    pieces = ["a", "@", ".", "1", "22", "255", "+", "-", " ", "(", ")", "b.c", "x@y", "4111 1111 1111 1111", "\n", "é", "_", "+1 555", "999.1"]
    for _ in range(3000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(30)))
        order = {k: i for i, k in enumerate(pii.KINDS)}
        assert sorted(pii.plain_spans(text), key=lambda s: (s[1], order[s[0]])) == brute.personal(text), text


DISGUISED = [
    ("mail john.doe (at) example [dot] com now", "email", "john.doe (at) example [dot] com"),
    ("reach jane at example dot org today", "email", "jane at example dot org"),
    ("jane&#64;example.org", "email", "jane&#64;example.org"),
    ("jоhn@еxample.com", "email", "jоhn@еxample.com"),
    ("jo\u200bhn@exam\u200dple.com", "email", "jo\u200bhn@exam\u200dple.com"),
    ("card " + "four " + "one " * 15, "card", ("four " + "one " * 15).strip()),
    ("call plus four nine one five one two three four five six seven eight!", "phone", "plus four nine one five one two three four five six seven eight"),
    ("ip one nine two dot one six eight dot one dot one yes", "ip", "one nine two dot one six eight dot one dot one"),
    ("at １９２.168.0.1 here", "ip", "１９２.168.0.1"),
    ("+４9 151 23\u200b45678", "phone", "+４9 151 23\u200b45678"),
    ("from 192.l68.O.1 again", "ip", "192.l68.O.1"),
    ("card 4lll llll llll llll", "card", "4lll llll llll llll"),
    ("mail jane (at) example dot org", "email", "jane (at) example dot org"),
    ("JANE AT EXAMPLE DOT ORG", "email", "JANE AT EXAMPLE DOT ORG"),
]


@pytest.mark.parametrize("text, kind, span", DISGUISED)
def test_disguises(text, kind, span):
    base, added = pii.all_spans(text)
    assert not [s for s in base if s[0] == kind]
    assert [(k, text[a:b]) for k, a, b in added] == [(kind, span)]
    assert span not in pii.masked(text) and f"[{kind.upper()}]" in pii.masked(text)


PARTLY_DISGUISED = [
    ("mail jоhn@example.com now", "email", "hn@example.com", "jоhn@example.com"),
    ("mail john@example.cоm now", "email", "john@example.c", "john@example.cоm"),
    ("mail john@mail.example dot com now", "email", "john@mail.example", "john@mail.example dot com"),
    ("mail jane@example.org [dot] uk now", "email", "jane@example.org", "jane@example.org [dot] uk"),
    ("call +49 151 234567 eight nine now", "phone", "+49 151 234567", "+49 151 234567 eight nine"),
    ("call +49 151 23456７8 now", "phone", "+49 151 23456", "+49 151 23456７8"),
]


@pytest.mark.parametrize("text, kind, plain, whole", PARTLY_DISGUISED)
def test_partial_disguises(text, kind, plain, whole):
    base, added = pii.all_spans(text)
    assert [(k, text[a:b]) for k, a, b in base] == [(kind, plain)]
    assert [(k, text[a:b]) for k, a, b in added] == [(kind, whole)]
    assert pii.masked(text) == text.replace(whole, f"[{kind.upper()}]")
    assert pii.all_spans("jоe: jane@example.org")[1] == []


def test_prose_stays():
    for text in (PROSE, "look at the dot com boom", "meet me at example.com", "one two three", "un deux, trois", "зима и лето"):
        assert pii.all_spans(text) == ([], []) and pii.masked(text) == text


@pytest.mark.parametrize("piece", ["a", "1", "1 ", "+1", "@", "a@", "one ", "a at b dot ", "O", "Ol ", "1O", "(", "1.", "а", "a dot "])
def test_long_texts_take_linear_time(piece):
    pii.all_spans(piece * 60_000)


def test_redact(docs, nothing):
    clean = pii.redact(docs, "text", "n_chars")
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert r["text"] is None or (len(r["text"]) == r["n_chars"] and not brute.personal(r["text"]))
    assert pii.redact(nothing).count() == 0 and pii.find(nothing).count() == 0


# byte pair encoding


def test_round_trip(docs, nothing):
    library = Tokenizer.from_file(BYTE_BPE)
    got = bpe.decode(bpe.encode(docs, BYTE_BPE), BYTE_BPE).collect()
    want = []
    for d, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, ids, library.decode(ids, skip_special_tokens=False)))
    assert bag((r["id"], r["ids"], r["text"]) for r in got) == bag(want)
    assert bpe.encode(nothing, BYTE_BPE).count() == 0


def test_random_words_and_ids(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 500)
    library, coder = Tokenizer.from_file(BYTE_BPE), bpe.Bpe(Path(BYTE_BPE).read_text())
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abest c\néñ中'<|1 .,\x1c\x85\xa0²½_") for _ in range(rnd.randrange(300))) for _ in range(400)]
    texts += ["<|endoftext|>" * 3, "a<|endoftext|>b", "é" * 33, "ab" * 40, "t" * 999]
    ids = [np.frombuffer(i, dtype=np.int32) for some in bpe._runs(texts, 5000) for i in coder.encode_batch(some)]
    assert [i.tolist() for i in ids] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    ids += [np.array([rnd.randrange(50_257) for _ in range(rnd.randrange(12))], dtype=np.int32) for _ in range(300)]
    decoded = coder.decode_batch(np.concatenate(ids), np.cumsum([len(i) for i in ids])).to_pylist()
    assert decoded == [library.decode(i.tolist(), skip_special_tokens=False) for i in ids]


# near-duplicates


def test_simhash(docs, nothing):
    got = simhash.near_duplicates(docs).collect()
    prints = [brute.fingerprint(t) for _, t in ROWS]
    wanted = zip([d for d, _ in ROWS], prints, brute.components(prints, [d for d, _ in ROWS]))
    assert bag((r["id"], r["fp"] % (1 << 64), r["component"]) for r in got) == bag(wanted)
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("tile", [7, 10_000])
def test_links_join_what_all_pairs_join(spark, tile):
    rnd = random.Random(4)
    values = {0}
    for _ in range(40):
        at = rnd.getrandbits(64)
        for _ in range(12):
            values.add(at)
            for _ in range(rnd.choice([1, 1, 2, 3])):
                at ^= 1 << rnd.randrange(64)
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    links = simhash.links_within(spark.createDataFrame([(v,) for v in values], "fp long"), 2, tile=tile)
    root = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    ours = [root.get(v, v) for v in values]
    theirs = brute.components([v % (1 << 64) for v in values], values)
    assert ours == theirs


def test_components_of_a_chain(spark):
    order = list(range(300))
    random.Random(5).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(900, 901)], "a long, b long")
    found = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert found == {**{v: 0 for v in order if v}, 901: 900}


def test_deduplicate(docs):
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    prints = [brute.fingerprint(t) for _, t in ROWS]
    names = [(d is None, d if d is not None else 0, i) for i, (d, _) in enumerate(ROWS)]
    groups = brute.components(prints, names)
    assert bag(r["doc_id"] for r in kept.collect()) == bag(ROWS[g[2]][0] for g in set(groups))


# URLs


URLS = [
    "http://a.com/x", "https://EXAMPLE.com/en/1?q=/en/", "http://www.example.com/en/", "http://b.www.example.com/en/z#t",
    "http://notexample.com/en/", "http://example.com", "http://example.com?/en/", "http://a.b.net/es/1", "http://net/fr/",
    "http://net/frx", "no mark", "", None, "://", "http://x://y.com/", "http://a.com:80/", "http://ü.COM/", "http://a.com/\n",
    "http://" + "a." * 20_000 + "com/", "http://a.com/" + "p" * 50_000,
]


def test_url_verdicts(spark, nothing):
    import duckdb

    pages = spark.createDataFrame(list(enumerate(URLS)) + [(0, URLS[0])], "page_id long, url string")
    rules = spark.createDataFrame([("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"), (None, "block"), ("com/", "allow")], "entry string, verdict string")
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", [*enumerate(URLS), (0, URLS[0])])
    for shard in (2, 1000):
        got = urls.judge(pages, rules, shard=shard).withColumnRenamed("id", "page_id")
        assert differences(got, con, LLM_SQL["op5_url_verdicts"]) == []
    assert {r["verdict"] for r in urls.judge(pages, rules.where("false")).collect()} == {"allow"}
    assert urls.judge(nothing, rules, "doc_id", "text").count() == 0


def test_equal_keys_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda data, seed: len(data))
    urls.write_shard(str(tmp_path / "s"), [("aa.com/", "block"), ("bb.com/", "allow"), ("c.com/", "block")])
    shard = urls.Shard(str(tmp_path / "s"))
    found = shard.find([b"bb.com/", b"aa.com/", b"xx.com/", b"c.com/", b"x"])
    assert [shard.entry(i) if i >= 0 else None for i in found] == ["bb.com/", "aa.com/", None, "c.com/", None]


# sharding


def test_shards_are_exact(docs, nothing):
    got = sharding.shuffle(docs, 6, block=4).collect()
    assert bag((r["id"], r["size"], r["crc"]) for r in got) == bag(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in ROWS
    )
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by_shard.get(s, [])) for s in range(6)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert sharding.shuffle(nothing, 3).count() == 0


def test_counts_follow_the_hypergeometric_law(spark):
    population, ours, draws, n = 30, 12, 9, 20_000
    u = (F.col("id") + 0.5) / n
    drawn = spark.range(n).select(
        sharding.hypergeometric(u, *[F.lit(v).cast("long") for v in (population, ours, draws)]).alias("k")
    )
    got = {r["k"]: r["count"] for r in drawn.groupBy("k").count().collect()}
    for k in range(draws + 1):
        exact = math.comb(ours, k) * math.comb(population - ours, draws - k) / math.comb(population, draws) * n
        assert abs(got.get(k, 0) - exact) <= 2


def test_matrix_has_its_sums(spark):
    sizes = [5, 0, 17, 1, 300, 40, 2]
    table = spark.createDataFrame(list(enumerate(sizes)), "block long, size long")
    rows = {r["block"]: r["counts"] for r in sharding.matrix(table, 4).collect()}
    assert [sum(rows[b]) for b in range(7)] == sizes
    total = sum(sizes)
    assert [sum(r[s] for r in rows.values()) for s in range(4)] == [total // 4 + (s < total % 4) for s in range(4)]


def test_shuffle_is_uniform(spark):
    """Over many seeds each row is in each shard, and at each slot, about equally often."""
    docs = spark.range(8).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    at = np.zeros((8, 8))
    for seed in range(60):
        for r in sharding.shuffle(docs, 2, seed=seed * 1000, block=3).collect():
            at[r["id"], r["shard"] * 4 + r["slot"]] += 1
    chi = ((at - 7.5) ** 2 / 7.5).sum()
    assert chi < 49 + 5 * math.sqrt(98)


# token files


def test_token_files(spark, docs, nothing):
    library = Tokenizer.from_file(WORD_BPE)
    for block in (50, 2_000_000):
        path = token_files.write(docs, WORD_BPE, 2, block_ids=block)
        got = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
        assert sum(r["n_tokens"] for r in got) == got[-1]["start"] + got[-1]["n_tokens"]
        assert [r["id"] for r in got] == sorted((d for d, _ in ROWS), key=lambda d: (d is not None, d))
        start = 0
        for r in got:
            assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]))
            start += len(r["ids"])
        want = [(d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in ROWS]
        assert bag((r["id"], r["ids"]) for r in got) == bag(want)
        sums = {(r["start"], r["crc"]) for r in token_files.read_checksums(spark, path).collect()}
        assert sums == {(r["start"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in got}
    assert token_files.read(spark, token_files.write(nothing, WORD_BPE, 2)).count() == 0


def test_words_by_the_library():
    library, coder = Tokenizer.from_file(WORD_BPE), token_files.Words(Path(WORD_BPE).read_text())
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("abC ,.'s\n\x0b\x1c\x85\xa0ΣσİıéÉ́中½1<|>") for _ in range(200)) for _ in range(300)]
    texts += ["<|endoftext|> <|ENDOFTEXT|> x<|startoftext|>.", "It's THE end., We'LL see.", "ΑΣ ΑΣΑ. İ,"]
    ours = [np.frombuffer(i, dtype=coder.dtype).tolist() for i in coder.ids([t.encode() for t in texts])]
    assert ours == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_elias_fano():
    rnd = random.Random(7)
    for top in (0, 1, 9, 1000, 10**6, 10**9):
        values = np.sort(np.array([rnd.randrange(top + 1) for _ in range(rnd.choice([1, 5, 3000]))], dtype=np.int64))
        code = token_files.EliasFano.encode(values, top)
        at = np.arange(len(values))
        assert (code.values(at) == values).all()
        some = np.array(rnd.sample(range(len(values)), min(5, len(values))))
        assert (code.values(some) == values[some]).all()
        spent = len(code.low) + len(code.high)
        assert spent <= len(values) * (2 + math.log2(max(1, top / len(values)) + 1) + 1) / 8 + 16


# classifiers


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in LLM_QUERIES["op8_quality_classifier"](spark, folder).collect()]
    assert len(rows) == 1000 and all(r["held_out"] == (brute.remainder(r["doc_id"], 3) == 1) for r in rows)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    rules = {r["doc_id"]: r["kept"] for r in LLM_QUERIES["op9_quality_rules"](spark, folder).collect()}
    good = [d for d, q in truth.items() if q == 1]
    assert sum(rules[d] for d in good) >= 0.9 * len(good)
    assert sum(rules[d] for d, q in truth.items() if q == 0) <= 0.1 * (len(truth) - len(good))


def test_classifier_edges(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1), (16, 0), (16, 0), (2, None), (None, 1), (999, 1)], "doc_id long, quality int")
    rows = classifier.classify(docs, labels, "quality", F.lit(True)).collect()
    assert bag(r["id"] for r in rows) == bag(d for d, _ in ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    none = labels.where("false")
    assert {r["score"] for r in classifier.classify(docs, none, "quality", F.lit(True)).collect()} == {0.5}
    assert classifier.classify(nothing, labels, "quality", F.lit(True)).count() == 0


def test_scores_are_sparse_dot_products():
    rnd = np.random.default_rng(1)
    weights = rnd.normal(size=(1 << classifier.BITS) + 1)
    texts = [(t or "").encode() for _, t in ROWS]
    together = classifier.scores(texts, weights)
    for text, score in zip(texts, together):
        found, _ = classifier.features([text])
        at, n = np.unique(found, return_counts=True)
        x = classifier.SCALE * n / max(1, n.sum())
        assert math.isclose(score, 1 / (1 + math.exp(-(weights[at] @ x + weights[-1]))), rel_tol=1e-9)


def test_quality_counts(docs, nothing):
    rows = quality.judge(docs, quality.Model.empty()).collect()
    ours = [
        (r["id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        for r in rows
    ]
    assert bag(ours) == bag((d, *brute.quality(t)) for d, t in ROWS)
    assert all((r["verdict"] == "fails") == r["base_failed"] for r in rows)
    assert quality.judge(nothing, quality.Model.empty()).count() == 0


def test_quality_counts_of_random_texts():
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["a", "b", "c\n", "\n", "#x", "é", "\x00"]) for _ in range(rnd.randrange(60))) for _ in range(400)]
    facts = quality.counts([t.encode() for t in texts])
    assert [tuple(f[i] for f in facts.values()) for i in range(len(texts))] == [brute.quality(t) for t in texts]


def test_calibration_and_keep(spark, docs):
    labels = spark.createDataFrame([(d, int(d != 16)) for d, _ in ROWS if d], "doc_id long, quality int")
    model = quality.train(quality.labelled(docs, labels))
    kept = quality.keep(docs, model)
    assert kept.columns == docs.columns
    verdicts = {r["id"]: r["verdict"] for r in quality.judge(docs, model).collect()}
    assert bag(r["doc_id"] for r in kept.collect()) == bag(d for d, _ in ROWS if verdicts[d] == "keep")
    slope, offset = quality.calibrate(np.array([-2.0, -1.0, 1.0, 2.0, 3.0]), np.array([0, 0, 1, 1, 1]))
    assert slope > 0 and -2 < -offset / slope < 2


# language model


def reference_scores(rows, training):
    """Context trees held as dictionaries, probabilities as ratios of whole-tree weights."""
    depth, counts = lm.DEPTH, {}

    def steps(text):
        data = bytes(depth) + (text or "").encode() + b"\0"
        for i in range(depth, len(data)):
            for j in range(8):
                yield data[i - depth : i], 1 << j | data[i] >> (8 - j), data[i] >> (7 - j) & 1

    for (_, text), trains in zip(rows, training):
        for context, prefix, bit in steps(text) if trains else ():
            for d in range(depth + 1):
                counts.setdefault((prefix, context[depth - d :]), [0, 0])[bit] += 1
    children = {}
    for prefix, context in counts:
        if context:
            children.setdefault((prefix, context[1:]), []).append((prefix, context))

    def kt(node):
        a, b = counts.get(node, (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    known = {}

    def log_w(node):
        if node not in known:
            own = kt(node)
            if len(node[1]) == depth:
                known[node] = own
            else:
                below = sum(map(log_w, children.get(node, [])))
                high, low = max(own, below), min(own, below)
                known[node] = math.log(0.5) + high + math.log1p(math.exp(low - high))
        return known[node]

    def p(context, prefix, bit, d=0):
        node = (prefix, context[depth - d :])
        a, b = counts.get(node, (0, 0))
        own = ((a, b)[bit] + 0.5) / (a + b + 1)
        if d == depth:
            return own
        share = math.exp(math.log(0.5) + kt(node) - log_w(node))
        return share * own + (1 - share) * p(context, prefix, bit, d + 1)

    cache = {}

    def score(text):
        total = 0.0
        for step in steps(text):
            if step not in cache:
                cache[step] = math.log10(p(*step))
            total += cache[step]
        return total

    return [score(t) for _, t in rows]


@pytest.mark.parametrize("block_bytes", [200, 32 << 20])
def test_context_trees(docs, block_bytes):
    rows = [(d, t) for d, t in ROWS if t is None or len(t) < 2000]
    training = [d is not None and d % 3 != 1 for d, _ in rows]
    some = docs.where("text is null or length(text) < 2000")
    got = lm.score(some, F.pmod("doc_id", F.lit(3)) != 1, block_bytes=block_bytes).collect()
    tokens = [[*brute.SPACED.findall(brute.small(t or "")), ""] for _, t in rows]
    counts = {}
    for own, trains in zip(tokens, training):
        for w in own if trains else ():
            counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())
    want = [
        (
            d, trains, len(own), sum(w in counts for w in own), total,
            round(sum(math.log10((counts.get(w, 0) + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in own), 6),
            round(score, 6),
        )
        for (d, _), trains, own, score in zip(rows, training, tokens, reference_scores(rows, training))
    ]
    ours = [
        (r["id"], r["train"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
        for r in got
    ]
    assert bag(ours) == bag(want)


@pytest.mark.parametrize("depth", [1, lm.LARGEST_DEPTH])
def test_context_trees_of_any_depth(docs, monkeypatch, depth):
    rows = [(d, t) for d, t in ROWS if t is None or len(t) < 2000]
    training = [d is not None and d % 3 != 1 for d, _ in rows]
    some = docs.where("text is null or length(text) < 2000")
    got = lm.score(some, F.pmod("doc_id", F.lit(3)) != 1, block_bytes=200, depth=depth).collect()
    monkeypatch.setattr(lm, "DEPTH", depth)
    want = [(d, round(s, 6)) for (d, _), s in zip(rows, reference_scores(rows, training))]
    assert bag((r["id"], round(r["score"], 6)) for r in got) == bag(want)
    with pytest.raises(ValueError):
        lm.score(docs, F.lit(True), depth=lm.LARGEST_DEPTH + 1)


def test_context_trees_edges(docs, nothing):
    assert lm.score(nothing, F.lit(True)).count() == 0
    for r in lm.score(docs, F.lit(False)).collect():
        assert math.isclose(r["bits_per_byte"], 8) and r["n_known"] == 0 and r["train_tokens"] == 0


# queries


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_same_as_sql(spark, small, name):
    assert differences(LLM_QUERIES[name](spark, small), connect(small), LLM_SQL[name]) == []


#: A result of its own kind, tested with its operator.
SEARCHES = {"op12_nearest_neighbours"}


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_SQL) - SEARCHES))
def test_queries_give_each_row_once(spark, small, name):
    ids = [r["doc_id"] for r in LLM_QUERIES[name](spark, small).select("doc_id").collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in spark.read.parquet(f"{small}/documents.parquet").collect())


def test_pipeline(spark, small, tmp_path):
    """Every stage keeps what the shortest way keeps of its own input."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r["doc_id"]: r for r in docs.collect()}
        if name != "token_ids":
            assert docs.columns == columns
        if name == "quality_rules":
            assert not [d for d in after if brute.quality(before[d])[5]]
        if name == "near_duplicates":
            ids = list(before)
            assert set(after) == set(brute.components([brute.fingerprint(before[d]) for d in ids], ids))
        if name == "decontamination":
            assert set(after) == {d for d, t in before.items() if not brute.contamination(t, items)[4]}
        if name == "personal_data":
            assert set(after) == set(before)
            assert not [d for d, r in after.items() if brute.personal(r["text"])]
            assert all(after[d]["text"] == t for d, t in before.items() if pii.all_spans(t) == ([], []))
        if name == "token_ids":
            library = Tokenizer.from_file(BYTE_BPE)
            for d, r in after.items():
                assert r["ids"] == library.encode(before[d], add_special_tokens=False).ids
                assert r["decoded_sha256"] == brute.sha(before[d])
