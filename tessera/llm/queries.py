"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import json
import zlib

from pyspark.sql import functions as F

from tessera.llm import (elias_fano, exact_dedup, mincut, mixing, packing, periodic, quality, secrets, sharding, simhash,
                         toxicity, variants, warc)
from tessera.llm.common import table
from tessera.llm.registry import register

SEQUENCE = 2048


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def vocabulary_size(path: str) -> int:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])


@register("op5_elias_fano")
def op5(spark, sf_dir):
    path = tokenizer_path("word_bpe_49k.json")
    return elias_fano.token_dataset(spark, table(spark, sf_dir, "documents"), path, 1, vocabulary_size(path))


@register("op8_exact_dedup", """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY length(t) DESC, doc_id) AS k,
         count(*) OVER (PARTITION BY h) AS n
  FROM d)
SELECT r.doc_id, b.doc_id AS keep_id, r.n AS group_size, r.k = 1 AS kept, r.h AS text_sha256
FROM r JOIN r AS b ON b.h = r.h AND b.k = 1""")
def op8(spark, sf_dir):
    index, batch = exact_dedup.DigestIndex(spark), "documents"
    members, reps = exact_dedup.classes(table(spark, sf_dir, "documents"), index, batch=batch)
    index.commit(reps, batch)
    return exact_dedup.decide(members, index.look_up(reps, batch))


@register("op10_best_fit")
def op10(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 0, SEQUENCE)


@register("op2_simhash")
def op2(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op4_quality_rules", r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM d),
p AS (SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS k FROM w),
g AS (
  SELECT r, k, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS g
  FROM p WINDOW o AS (PARTITION BY r ORDER BY k)),
h AS (SELECT r, k, g IS NOT NULL AND count(*) OVER (PARTITION BY r, g) > 1 AS again FROM g),
v AS (
  SELECT r, again OR coalesce(lag(again) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS hit
  FROM h WINDOW o AS (PARTITION BY r ORDER BY k)),
s AS (SELECT r, count(*) FILTER (hit) AS n FROM v GROUP BY r),
c AS (SELECT r, max(n) AS top FROM (SELECT r, x, count(*) AS n FROM p GROUP BY r, x) GROUP BY r),
b AS (
  SELECT w.doc_id, w.t, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         CAST(coalesce(s.n, 0) AS BIGINT) AS n_repeat_words, coalesce(c.top, 0) AS top_word
  FROM w LEFT JOIN s USING (r) LEFT JOIN c USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words
            OR 5 * (length(t) - length(replace(t, '!', ''))) > n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) > length(t) - length(regexp_replace(t, '[a-z]', '', 'g'))
            OR 2 * n_dup_lines > n_lines OR 10 * n_repeat_words > 4 * n_words OR 10 * top_word > 3 * n_words) AS kept
FROM f""")
def op4(spark, sf_dir):
    return quality.assess(table(spark, sf_dir, "documents")).drop("rejected_by")


SHARDS = [f"shard-{k:03d}" for k in range(128)]
SLOTS = 65_537


@register("op6_lookup_sharding")
def op6(spark, sf_dir):
    slots = sharding.table_frame(spark, SHARDS, SLOTS)
    return sharding.place(table(spark, sf_dir, "documents"), slots, "doc_id", SLOTS)


@register("op1_warc", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, sha256(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (h)""")
def op1(spark, sf_dir):
    return warc.archive_pages(table(spark, sf_dir, "pages"))


@register("op9_secret_scan")
def op9(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


# Temperatures: the share of a category grows with this power of its tokens.
MIX_TARGETS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
MIX_KEEP = 0.7


def mix_columns():
    """(dimensions, tokens) of documents, which has no topic column."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = mixing.n_words(text)
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.form_topic(text, words)}, words


@register("op7_ipf_mixing", mixing.oracle(MIX_TARGETS, MIX_KEEP))
def op7(spark, sf_dir):
    dims, words = mix_columns()
    out = mixing.assess(table(spark, sf_dir, "documents"), dims, MIX_TARGETS, words, MIX_KEEP)
    return out.withColumn("probability", F.round(F.col("probability").cast("decimal(38,9)"), 6).cast("double"))


@register("op3_toxicity")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.assess(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register("op11_spelling_variants")
def op11(spark, sf_dir):
    words = variants.damaged(variants.words_of(table(spark, sf_dir, "documents")))
    return variants.group(variants.vocabulary(words))


@register("op12_mincut_text")
def op12(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return mincut.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def repeat_tail(doc_id, words):
    """The words with a periodic tail, for ids whose CRC-32 ends in 0; a null id has none."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@register("op13_periodic_runs")
def op13(spark, sf_dir):
    found = periodic.detect(table(spark, sf_dir, "documents"), prepare=repeat_tail)
    best = periodic.strongest(F.col("runs"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")))
