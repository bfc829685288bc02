"""The registered queries of the llm operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage, work_path
from . import (alignment, ball_hashing, decontaminate, language, mixing, ngram_join, pivot_codes, repetition, sharding, token_files, token_rollups,
               toxicity, url_filter)
from .words import ALNUM_WORD, PLAIN_WORD, byte_class

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLAIN = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def register(name: str, oracle: str | None = None):
    def add(query):
        QUERIES[name] = query
        if oracle:
            ORACLES[name] = oracle
        return query
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op9_ngram_jaccard_join", rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{PLAIN}') AS ws FROM documents),
sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                             WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM sets x JOIN sets y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * o >= 75 * (s.n + t.n - o)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets reach Jaccard 0.75."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def _repeat_words_sql(length: int) -> str:
    """Words inside ``length``-word windows found twice or more in their document."""
    return rf"""(SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT v.doc_id, unnest(range(p, p + {length})) AS word FROM (
        SELECT doc_id, unnest(ps) AS p FROM (SELECT doc_id, g, list(p) AS ps FROM (
            SELECT doc_id, unnest(range(1, len(ws) - {length} + 2)) AS p, array_to_string(ws[p:p + {length} - 1], ' ') AS g FROM w)
        GROUP BY doc_id, g HAVING count(*) > 1)) v) GROUP BY doc_id)"""


@register("op2_suffix_array_repetition", rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{PLAIN}') AS ws FROM documents),
lines AS (SELECT doc_id, l, count(*) - 1 AS again FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w)
          WHERE regexp_matches(l, '{PLAIN}') GROUP BY doc_id, l),
dup AS (SELECT doc_id, sum(again)::BIGINT AS n FROM lines GROUP BY doc_id),
r3 AS {_repeat_words_sql(3)}, r8 AS {_repeat_words_sql(8)}, r61 AS {_repeat_words_sql(61)},
b AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
      coalesce(r3.n, 0)::BIGINT AS n_repeat_words, coalesce(r8.n, 0)::BIGINT AS n_covered_words, r61.n IS NOT NULL AS long_repeat
      FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN r3 USING (doc_id) LEFT JOIN r8 USING (doc_id) LEFT JOIN r61 USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered_words, base_failed,
       NOT base_failed AND 100 * n_covered_words <= 30 * n_words AND NOT long_repeat AS kept FROM f""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the verdict of the suffix-array repetition rules for every document."""
    return repetition.repetition_rules(table(spark, sf_dir, "documents"), max_longest=60).drop("longest_repeat")


@register("op3_wu_manber_decontamination", rf"""
WITH iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS ws FROM benchmark),
windows AS (SELECT DISTINCT item_id, array_to_string(g, ' ') AS g, len(g) AS k FROM (
    SELECT item_id, unnest(CASE WHEN len(ws) > 13 THEN list_transform(range(1, len(ws) - 11), lambda i: ws[i:i + 12])
                                WHEN len(ws) > 0 THEN [ws] ELSE [] END) AS g FROM iw)),
sizes AS (SELECT DISTINCT k FROM windows),
dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS ws FROM documents),
spots AS (SELECT doc_id, k, p, array_to_string(ws[p:p + k - 1], ' ') AS g FROM (
    SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM dw, sizes)),
found AS (SELECT doc_id, item_id, s.k, p FROM spots s JOIN windows w ON s.g = w.g AND s.k = w.k),
hit AS (SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS word FROM found) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n > 0 AND 20 * hit.n >= len(ws), false) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of 13-word benchmark windows in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def _held_out(col: str = "doc_id"):
    """The fold that no model learns from."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % 3 == 1


@register("op10_language_spans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from Viterbi spans; learned from two of three folds."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~_held_out()).select("doc_id", "text", "lang"))
    return language.predict(docs, model).select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "n_spans")


@register("op4_convolutional_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity score of every document; learned from two of three folds."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~_held_out()))
    found = toxicity.scored(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), F.col(toxicity.SCORE).alias("score"),
                        (F.col(toxicity.SCORE) >= toxicity.CUT).cast("int").alias("predicted"))


def bpe_path() -> str:
    """The public byte-level BPE that the token queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, read back through their minimal perfect hash index."""
    return token_files.token_files(table(spark, sf_dir, "documents"), bpe_path())


def _feistel_sql(source: str, seed: int) -> str:
    """One pass of the network over column v of ``source`` (CTE dom has bits and mask)."""
    sql = f"SELECT row, v >> bits AS l, v & mask AS r FROM {source}, dom"
    for a, b in sharding.round_keys(seed):
        p = (1 << 31) - 1
        m = f"((r * {a}::BIGINT + {b}) % {p})"
        sql = f"SELECT row, r AS l, xor(l, ({m} * {m}) % {p} & mask) AS r FROM ({sql}), dom"
    return f"SELECT row, (l << bits) | r AS v FROM ({sql}), dom"


@register("op6_feistel_shards", f"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab),
t AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS hx FROM documents),
s AS (SELECT doc_id, size, xor(4294967295, list_reduce(
        list_transform(regexp_extract_all(hx, '..'), lambda h: ('0x' || h)::BIGINT),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS text_crc32 FROM t, crc_table),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS row FROM s),
dom AS (SELECT count(*) AS n, ((len(bin(greatest(count(*) - 1, 1))) + 1) // 2)::INT AS bits,
        (1::BIGINT << ((len(bin(greatest(count(*) - 1, 1))) + 1) // 2)::INT) - 1 AS mask FROM numbered),
start AS (SELECT row, row AS v FROM numbered),
walk(row, v) AS ({_feistel_sql("start", 20_231)} UNION ALL
    ({_feistel_sql("(SELECT row, v FROM walk, (SELECT n FROM dom) WHERE v >= n)", 20_231)})),
placed AS (SELECT row, v FROM walk, (SELECT n FROM dom) WHERE v < n)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (v % 16)::INT AS shard,
       (v // 16)::BIGINT AS slot, NULL::INT AS grown_shard FROM numbered JOIN placed USING (row)""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards by a Feistel permutation of their row numbers."""
    placed = sharding.shuffle_shards(table(spark, sf_dir, "documents"), shards=16, seed=20_231)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
REJECTED = "[01]"   # first digit of the md5 of a page's html: an eighth of the pages stands for those that a review rejected


@register("op5_blocked_bloom_urls", rf"""
WITH p AS (SELECT page_id, url, html, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 1), ''), '{UPPER}', '{LOWER}') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 2), '') AS path,
                  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 3), '') AS query FROM pages),
c AS (SELECT *, list_filter(list_sort(string_split(query, '&')), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref)=')) AS args FROM p),
k AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '')
                     || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END END AS key FROM c),
listed AS (SELECT DISTINCT key FROM k WHERE regexp_matches(md5(html), '^{REJECTED}')),
rules(rule, site, rest, action) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
best AS (SELECT page_id, url, host, path, key, (SELECT arg_max(r, length(r.rule)) FROM rules r
         WHERE (host = r.site OR ends_with(host, '.' || r.site)) AND starts_with(path, r.rest)) AS r FROM k)
SELECT page_id, host, path, r.rule AS rule, listed.key IS NOT NULL AS listed,
       coalesce(r.action, CASE WHEN listed.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM best LEFT JOIN listed ON listed.key = best.key""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: rules, then the list of URLs of pages rejected by their content. Other pages
    of a listed address (with ``www.``, tracking parameters, other content) are found by filter and join alone."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.where(F.md5(F.col("html").cast("binary")).rlike(f"^{REJECTED}")).select("url")
    return url_filter.judge(pages.select("page_id", "url"), listed, RULES).drop("url")


ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SYMBOL = "[#*$%&|<>]"


@register("op1_token_rollups", rf"""
WITH c AS (SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '{PLAIN}')) AS plain,
                  len(regexp_extract_all(coalesce(text, ''), '{ANY_CASE}')) AS alnum,
                  len(regexp_extract_all(regexp_replace(coalesce(text, ''), '{SYMBOL}', '', 'g'), '{PLAIN}')) AS solid,
                  min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
changes AS (SELECT source, lang, 'plain-1' AS tokenizer_version, 1 AS docs, plain AS tokens FROM c
  UNION ALL SELECT source, lang, 'alnum-1', 1, alnum FROM c
  UNION ALL SELECT source, lang, 'plain-1', -1, -plain FROM c WHERE doc_id <> first
  UNION ALL SELECT source, lang, 'alnum-1', -1, -alnum FROM c WHERE doc_id <> first
  UNION ALL SELECT source, lang, 'plain-1', 0, solid - plain FROM c WHERE doc_id = first)
SELECT source, lang, tokenizer_version, sum(docs)::BIGINT AS n_docs, sum(tokens)::BIGINT AS n_tokens FROM changes GROUP BY ALL""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after inserts under two tokenizer versions, deletes of exact copies and
    recounts without words of symbols only; every batch is sent twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), "text")
    counters = {"plain": (PLAIN_WORD, None), "alnum": (ALNUM_WORD | byte_class((0x41, 0x5A)), None),
                "solid": (PLAIN_WORD, ~byte_class(*[(ord(c), ord(c)) for c in SYMBOL[1:-1]]))}
    counted = stage(token_rollups.count_words(docs, counters), "counted")
    first = stage(counted.groupBy("digest").agg(F.min("doc_id").alias("first")), "first")   # staged: AQE can then split a hot digest
    marked = stage(counted.join(first, "digest"), "marked")
    copies, kept = marked.where("doc_id <> first"), marked.where("doc_id = first")
    rollup = token_rollups.TokenRollup(spark, work_path(spark, "rollup"))
    change = token_rollups.changes
    for batch_id, batch in [
        ("load-plain-1", change(marked, "insert", "plain-1", "plain")),
        ("load-alnum-1", change(marked, "insert", "alnum-1", "alnum")),
        ("drop-copies", change(copies, "delete", "plain-1", "plain").unionByName(change(copies, "delete", "alnum-1", "alnum"))),
        ("recount-solid", change(kept, "revise", "plain-1", "solid", "plain")),
    ]:
        rollup.commit(batch_id, batch)
        rollup.commit(batch_id, batch)   # a replay: its id is in the log, nothing changes
    return rollup.totals()


MIX = {"high": 0.87, "low": 0.13}


def quality_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with their domain: ``high`` or ``low`` quality."""
    return table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").alias("domain"))


@register("op7_soft_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, rate and copies of every document for the target mix of quality domains."""
    docs = table(spark, sf_dir, "documents")
    rates = mixing.fit(docs, quality_domains(spark, sf_dir), MIX, least=1.0)
    return mixing.rated(docs, rates, MIX)


@register("op11_ball_hashing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose SimHash fingerprints differ in at most four bits."""
    return ball_hashing.simhash_components(table(spark, sf_dir, "documents"))


def _codes_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Product quantisation by comparing every part with every entry, round by round."""
    def nearest(book: str) -> str:
        return f"""SELECT vec_id, part, min(dist) AS dist, arg_min(entry, (dist, entry)) AS entry FROM (
          SELECT vec_id, p.part, entry, sum((x - c) * (x - c))::BIGINT AS dist FROM x p JOIN {book} b ON b.part = p.part AND b.place = p.place
          GROUP BY vec_id, p.part, entry) GROUP BY vec_id, part"""

    steps = [f"""b0 AS (SELECT part, place, x AS c, rank - 1 AS entry FROM x JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rank FROM kept) USING (vec_id) WHERE rank <= {entries})"""]
    for i in range(rounds):
        steps += [f"a{i} AS MATERIALIZED ({nearest(f'b{i}')})",
                  f"""m{i} AS (SELECT part, place, entry, (sum(x)::BIGINT - ((sum(x)::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS c FROM x JOIN a{i} USING (vec_id, part) GROUP BY ALL)""",
                  f"b{i + 1} AS MATERIALIZED (SELECT part, place, entry, coalesce(m.c, b.c)::BIGINT AS c FROM b{i} b LEFT JOIN m{i} m USING (part, place, entry))"]
    return f"""WITH kept AS (SELECT vec_id, label, embedding AS v FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, i // w AS part, i % w AS place, floor(v[i + 1]::DOUBLE * 1024)::BIGINT AS x FROM (
      SELECT vec_id, v, len(v) // {parts} AS w, unnest(range(len(v))) AS i FROM kept)),
{", ".join(steps)},
coded AS (SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM ({nearest(f'b{rounds}')}) GROUP BY vec_id),
books AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN kept USING (vec_id), books"""


@register("op12_laesa_vector_codes", _codes_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-byte codes of all vectors by product quantisation, nearest entries found with pivots."""
    found = pivot_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return pivot_codes.with_label_error(found.rows).select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                                                           F.lit(found.sha256()).alias("codebooks_sha256"))


def piece_path() -> str:
    """The public sentencepiece model that the alignment query compares with."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@register("op13_galloping_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two tokenizers' tokens of every document, with corpus-wide pair counts."""
    return alignment.alignment_counts(table(spark, sf_dir, "documents"), bpe_path(), piece_path())
