"""Registered queries of this subpackage, one for each operator, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import (
    bpe, convtrie, decontaminate, filteraudit, htmltext, langid, linededup, quality, shards, simhash, toxicity,
    urlfilter, warc,
)
from tickwise.llm.common import with_row_key

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_OF_TEXT = 50256  # the id that the rank file leaves free

URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str) -> Column:
    """Whether a document's labels are kept from training."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = toxicity.training_labels(table(spark, sf_dir, "labels"), "doc_id", "toxic", ~held_out("doc_id"))
    scores = toxicity.toxicity(table(spark, sf_dir, "documents"), "doc_id", "text", labels)
    return scores.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
                         "score", "predicted")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, key = with_row_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return linededup.dedup_lines(docs, key, "text", "n_dropped").select("doc_id", "text", "n_dropped")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.url_filter(table(spark, sf_dir, "pages"), "page_id", "url",
                                urlfilter.rules_table(spark, URL_RULES))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, key = with_row_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    hits = decontaminate.contamination(docs, key, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    ids = docs.select("doc_id", F.col(key).alias("row_key"))
    return hits.join(ids, "row_key").select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_components(table(spark, sf_dir, "documents"), "doc_id", "text")
    return groups.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = shards.materialise(table(spark, sf_dir, "documents"), "doc_id", "text", RANKS,
                                  public_tokenizers.PATTERN, END_OF_TEXT)
    return shards.read_sequences(manifest)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.bpe_encode(docs, "text", TOKENIZER, "ids", "decoded").select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract_text(pages, "url", "html").withColumn(
        "n_chars", F.char_length("text").cast("long"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = convtrie.ordered_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    conv = F.col("conv")
    shared = F.crc32(conv.cast("string").cast("binary")) % 6
    return convtrie.trie_nodes(*convtrie.with_shared_openings(turns, conv - conv % 100, shared, most=5))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.filter_audit(table(spark, sf_dir, "documents"), "doc_id", "text", "lang",
                                    table(spark, sf_dir, "labels"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, key = with_row_key(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = langid.fit(docs.filter(third != 1), key, "text", "lang")
    asked = docs.select("doc_id", F.coalesce(third == 1, F.lit(False)).alias("held_out"), "text")
    return langid.identify(asked, "text", model)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_warc": op4_warc,
    "op5_url_filter": op5_url_filter,
    "op6_decontaminate": op6_decontaminate,
    "op7_simhash": op7_simhash,
    "op8_shards": op8_shards,
    "op9_bpe": op9_bpe,
    "op10_html_text": op10_html_text,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_language_id": op13_language_id,
}

# ------------------------------------------------------------------ DuckDB SQL

_STOP = ", ".join("'" + w + "'" for w in sorted({x for v in quality.STOP_WORDS.values() for x in v.split()}))

_OP3 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM d),
g AS (
  SELECT *, CASE WHEN len(w) < 3 THEN [] ELSE list_transform(range(1, len(w) - 1),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END AS tri FROM w),
tri AS (SELECT doc_id, unnest(tri) AS g, unnest(range(len(tri))) AS i FROM g),
rep AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(3) r(k) GROUP BY doc_id),
m AS (
  SELECT g.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop_words,
         len(list_filter(w, lambda x: x LIKE '%!')) AS n_exclamations,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(hit.n, 0) AS n_repeat_words
  FROM g LEFT JOIN hit USING (doc_id)),
r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_words = 0 THEN false ELSE word_chars / n_words BETWEEN 2 AND 20 END AS ok_word_length,
         coalesce(n_symbols / nullif(n_words, 0), 0) <= 0.1 AS ok_symbols,
         coalesce(n_stop_words / nullif(n_words, 0), 0) >= 0.02 AS ok_stop_words,
         coalesce(n_dup_lines / nullif(n_lines, 0), 0) <= 0.4 AS ok_duplicate_lines,
         coalesce(n_exclamations / nullif(n_words, 0), 0) <= 0.1 AS ok_exclamations
  FROM m)
SELECT *, NOT base_failed AND ok_word_length AND ok_symbols AND ok_stop_words
          AND ok_duplicate_lines AND ok_exclamations AS kept
FROM r"""

_OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
b AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(x, 5 * (i // 4)::INT + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '')
    AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first
  FROM p)
SELECT page_id, octet_length(encode(h)) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b"""

_OP5 = """
WITH rules AS (
  SELECT split_part(rule, '/', 1) AS rh, substr(rule, strpos(rule, '/')) AS rp, rule, verdict
  FROM (VALUES """ + ", ".join(f"('{r}', '{v}')" for r, v in URL_RULES) + """) v(rule, verdict)),
u AS (
  SELECT page_id, coalesce(regexp_extract(url, '^(?s:.)*?://((?s:.)*)$', 1), '') AS rest FROM pages),
h AS (
  SELECT page_id, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM (
  SELECT h.*, (SELECT max({'n': length(rule), 'verdict': verdict, 'rule': rule}) FROM rules
               WHERE (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp)) AS best
  FROM h)"""

_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

_OP6 = f"""
WITH i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s + 1:s + least(len(w), 10)], ' ') AS win
  FROM (SELECT *, unnest(range(greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (
  SELECT doc_id, n, s, array_to_string(w[s + 1:s + n], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
f AS (SELECT doc_id, s, g.n, item FROM g JOIN win USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM f) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM f) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""

# CRC-32 of the decimal id, from its definition: eight steps for every byte.
_OP11 = """
WITH RECURSIVE t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({'role': role, 'text': text} ORDER BY p) AS turns FROM t GROUP BY c),
crc AS (
  SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(c::VARCHAR) + 1),
             lambda i: ascii(substr(c::VARCHAR, i::INT, 1))::BIGINT)),
           lambda acc, b: list_reduce(list_concat([xor(acc, b)], range(8)),
             lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)),
         4294967295::BIGINT) % 6 AS h
  FROM o),
s AS (
  SELECT o.c, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS turns
  FROM o JOIN crc USING (c) LEFT JOIN o b ON b.c = o.c - o.c % 100),
m AS (SELECT c, len(turns) AS len, turns, unnest(range(len(turns) + 1)) AS d FROM s),
n AS (
  SELECT min(c) AS conv_id, d, turns[1:d] AS seq, count(*) AS n,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len = d), '')) AS ends,
         (count(*) - 1) * coalesce(length(any_value(turns[d].text)), 0) AS w
  FROM m GROUP BY ALL),
k AS (SELECT d - 1 AS d, seq[1:d - 1] AS seq, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN k USING (d, seq)),
a AS (SELECT kids, w, seq[1:e] AS seq, e FROM (SELECT *, unnest(range(d + 1)) AS e FROM f)),
sub AS (SELECT seq, sum(w) AS saved, count(*) FILTER (WHERE kids = 0) AS leaves FROM a GROUP BY ALL)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n AS n_convs, f.kids AS n_children,
       sub.leaves AS n_leaves, sub.saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM f JOIN sub USING (seq) LEFT JOIN f p ON p.d = f.d - 1 AND p.seq = f.seq[1:f.d - 1]"""

_OP12 = """
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
      FROM labels GROUP BY doc_id),
x AS (
  SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
                regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first, false)] AS f,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM w LEFT JOIN l USING (doc_id)),
g AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM x GROUP BY ALL),
o AS (
  SELECT a || b || c || d || e AS filter_order
  FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS a), (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS b),
       (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c), (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS d),
       (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5),
y AS (
  SELECT part, filter_order, step, n, good, toxic, filter,
         f[ascii(filter) - 64] AS fails,
         len(list_filter(range(1, step), lambda i: f[ascii(substr(filter_order, i::INT, 1)) - 64])) > 0 AS gone,
         len(list_filter(f, lambda z: z)) AS n_fails
  FROM g, (SELECT *, substr(filter_order, step::INT, 1) AS filter FROM (SELECT *, unnest(range(1, 6)) AS step FROM o))),
z AS (
  SELECT part, filter_order, step, filter,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE fails AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0) AS toxic_lost
  FROM y GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM z"""

ORACLES: dict[str, str] = {
    "op3_quality_rules": _OP3, "op4_warc": _OP4, "op5_url_filter": _OP5, "op6_decontaminate": _OP6,
    "op11_conversation_trie": _OP11, "op12_filter_audit": _OP12}
