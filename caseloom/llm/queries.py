"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from caseloom.llm import (
    alignment, bpe, classifier, contamination, lm, pii, quality, ranked, sharding, simhash, token_files, urls, vector_tree,
)
from caseloom.llm.registry import QUERIES as LLM_QUERIES, SQL as LLM_SQL, query, table  # noqa: F401


OP1_SQL = r"""with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
sized as (select item, w, least(10, len(w)) as size from b where len(w) > 0),
starts as (select item, w, size, unnest(range(1, len(w) - size + 2)) as s from sized),
windows as (select distinct item, size, w[s:s + size - 1] as win from starts),
sizes as (select distinct size from windows),
doc_starts as (select doc_id, w, size, unnest(range(1, greatest(1, len(w) - size + 2))) as s
  from d join sizes on len(w) >= size),
found as (select x.doc_id, x.s, x.size, y.item from doc_starts x join windows y
  on y.size = x.size and y.win = x.w[x.s:x.s + x.size - 1]),
covered as (select doc_id, count(distinct pos) as n_hit
  from (select doc_id, unnest(range(s, s + size)) as pos from found) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item from found) group by doc_id),
numbered as (select win, size, row_number() over () as id from (select distinct win, size from windows)),
parts as (select id, size, unnest(win) as word, generate_subscripts(win, 1) as i from numbered),
places as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from d),
fits as (select doc_id, id, size, i, unnest(range(pos - i - 2, pos - i + 3)) as s from places join parts using (word)),
near as (select distinct doc_id, id from (
  select doc_id, id, s from fits group by doc_id, id, size, s having count(distinct i) = size)),
near_items as (select doc_id, count(distinct item) as n_near
  from near join numbered using (id) join windows using (win, size) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(n_near, 0) as n_near
from d left join covered using (doc_id) left join named using (doc_id) left join near_items using (doc_id)
"""


@query("op1_decontaminate", OP1_SQL)
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    marked = contamination.mark(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return marked.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
    )


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        *[pii.counted("base", kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.listing("base"), 256).alias("base_sha256"),
        pii.listing("spans").alias("spans"),
    )


@query("op3_bpe_round_trip")
def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.round_trip(table(spark, folder, "documents"), path).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op4_simhash_components")
def op4_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"),
        simhash.fingerprint_hex().alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


#: The entries and their verdicts (fixed values).
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

OP5_SQL = """
with split as (select page_id, regexp_extract(url, '://((?s:.*))$', 1) as rest, url from pages),
parts as (
  select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') as path
  from split
),
ruled as (
  select page_id, host, path, case
    when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/'
    end as rule
  from parts
)
select page_id, host, path, rule,
  case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' else 'allow' end as verdict
from ruled
"""


@query("op5_url_verdicts", OP5_SQL)
def op5_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "entry string, verdict string")
    return urls.judge(table(spark, folder, "pages"), rules).withColumnRenamed("id", "page_id")


@query("op6_uniform_shards")
def op6_uniform_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shuffle(table(spark, folder, "documents"), 40).select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_token_files")
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = token_files.write(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return token_files.read_checksums(spark, path).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc").alias("ids_crc32")
    )


@query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    scored = classifier.classify(docs, labels, "quality", ~held_out).withColumnRenamed("id", "doc_id")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.train(quality.labelled(docs, labels))
    return quality.judge(docs, model).select(
        F.col("id").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (F.col("verdict") == "keep").alias("kept"),
        "probability",
    )


@query("op10_context_tree_scores")
def op10_context_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    scored = lm.score(table(spark, folder, "documents"), ~held_out)
    return scored.select(
        F.col("id").alias("doc_id"),
        (~F.col("train")).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte",
    )


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.summarise(table(spark, folder, "documents"), *paths).select(
        F.col("id").alias("doc_id"),
        "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256",
    )


@query("op12_nearest_neighbours")
def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_tree.nearest(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP13_SQL = r"""with d as (
  select doc_id, row_number() over () as doc, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
facts as (select count(*) as big_n, sum(len(w)) as big_l from d where len(w) > 0),
b as (
  select item_id, row_number() over () as item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from (select distinct item_id, text from benchmark where text is not null)),
wanted as (select item_id, item, term, count(*) as repeats from (select item_id, item, unnest(w) as term from b) group by all),
places as (select doc_id, doc, len(w) as n, unnest(w) as term from d),
postings as (select doc_id, doc, n, term, count(*) as tf from places where term in (select term from wanted) group by all),
weights as (select term, cast(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) as bigint) as weight
  from postings, facts group by term, big_n),
impacts as (select doc_id, doc, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))) as impact
  from postings join weights using (term), facts),
scores as (select item_id, item, doc_id, doc, cast(sum(repeats * impact) as bigint) as score
  from wanted join impacts using (term) group by item_id, item, doc_id, doc having sum(repeats * impact) > 0),
ranked as (select item_id, doc_id, score,
  row_number() over (partition by item order by score desc, doc_id asc nulls last, doc) as rank from scores)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 20
"""


@query("op13_ranked_search", OP13_SQL)
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    found = ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")
