"""The queries opN_<name>: each operator with production parameters over its whole table."""

from __future__ import annotations

from html.entities import html5

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import (
    ann,
    byte_bpe,
    conversation_trie,
    decontaminate,
    exact_dedup,
    jaccard_join,
    language_id,
    secret_scan,
    sharding,
    spelling,
    token_store,
    url_rules,
    warc,
)
from tokenloom.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), PIECES)


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), sharding.uniform_tree(40))


@query(
    "op3_url_filters",
    r"""
WITH rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
         ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
                  ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), fit AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id, p.host, p.path
                            ORDER BY length(r.host || r.path) DESC) AS k
  FROM parsed p JOIN rules r ON (p.host = r.host OR suffix(p.host, '.' || r.host))
                             AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN (SELECT * FROM fit WHERE k = 1) f USING (page_id, host, path)""",
)
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_rules.RULES, url_rules.RULE_SCHEMA)
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


@query("op4_jaccard_join")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"))


@query("op5_secret_scans")
def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.document_report(table(spark, sf_dir, "documents"))


@query("op6_token_store")
def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored_tokens(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.digest_documents(docs, BYTE_RANKS, public_tokenizers.PATTERN)


@query(
    "op7_decontamination",
    r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), own AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)
), item_words AS (
  SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM benchmark
), wanted AS (
  SELECT DISTINCT item_id, array_to_string(w[i + 1 : i + 5], ' ') AS shingle
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM item_words
        WHERE len(w) > 0)
), sizes AS (SELECT item_id, count(*)::BIGINT AS item_shingles FROM wanted GROUP BY item_id)
SELECT doc_id, item_id, count(*)::BIGINT AS shared, item_shingles,
       count(*)::DOUBLE / item_shingles AS containment
FROM own JOIN wanted USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, item_shingles HAVING count(*)::DOUBLE / item_shingles >= 0.75""",
)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


WARC_SQL = r"""
WITH html_names AS (
  SELECT {names} AS names
), named AS (
  SELECT page_id, url, coalesce(html, '') AS html,
         md5(concat_ws(' ', page_id::VARCHAR, url, html)) AS h FROM pages
), source AS (
  SELECT *, 'sha256:' || sha256(html) AS payload_digest,
         '<urn:uuid:' || concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) || '>' AS id
  FROM named
), untagged AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(html,
    '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<noscript\b[^>]*>.*?</noscript\s*>|<template\b[^>]*>.*?</template\s*>', '', 'g'),
    '(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>', chr(10), 'g'),
    '<[a-zA-Z/!?][^>]*>', '', 'g') AS t2,
    regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title', 1) AS t3,
    regexp_extract(html, '(?is)<html\b[^>]*\blang="([^"]*)"', 1) AS language,
    regexp_extract_all(html, '(?i)<a\b[^>]*\bhref="([^"\r\n]*)"', 1) AS links FROM source
), decoded AS (
  SELECT page_id, url, payload_digest, id, language, links, {t2} AS plain,
         replace({t3}, chr(10), ' ') AS title FROM untagged, html_names
), blocks AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
         CASE WHEN title <> '' THEN 'title: ' || title || chr(13) || chr(10) ELSE '' END ||
         CASE WHEN language <> '' THEN 'language: ' || language || chr(13) || chr(10) ELSE '' END ||
         'outlinks: ' || len(links) || chr(13) || chr(10) ||
         coalesce(array_to_string(list_transform(links, lambda x: 'outlink: ' || x || chr(13) || chr(10)), ''), '')
         AS block FROM decoded
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', plain FROM decoded
), ids AS (
  SELECT *, md5(id || ':' || record_type) AS d, strlen(block)::BIGINT AS content_length,
         'sha256:' || sha256(block) AS block_digest FROM blocks
), final AS (
  SELECT *, '<urn:uuid:' || concat_ws('-', d[1:8], d[9:12], d[13:16], d[17:20], d[21:32]) || '>'
         AS derived_id FROM ids
)
SELECT page_id, id AS refers_to, url AS target_uri, payload_digest, record_type, derived_id,
       content_type, content_length, block_digest,
       array_to_string(['WARC/1.1', 'WARC-Type: ' || record_type, 'WARC-Record-ID: ' || derived_id,
         'WARC-Date: 1970-01-01T00:00:00Z', 'WARC-Target-URI: ' || url, 'WARC-Refers-To: ' || id,
         'WARC-Refers-To-Target-URI: ' || url, 'WARC-Refers-To-Date: 1970-01-01T00:00:00Z',
         'WARC-Source-Payload-Digest: ' || payload_digest, 'WARC-Block-Digest: ' || block_digest,
         'Content-Type: ' || content_type, 'Content-Length: ' || content_length,
         'WARC-Identified-Payload-Type: text/html', '', block], chr(13) || chr(10)) AS record
FROM final"""


def _text_sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _decoded_sql(column: str) -> str:
    """DuckDB SQL that decodes character references once and squeezes blanks."""
    name = "regexp_extract(p, '^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{0,39});', 1)"
    code = f"(CASE WHEN lower({name}[2]) = 'x' THEN '0x' || {name}[3:] ELSE {name}[2:] END)::BIGINT"
    bad = f"{code} = 0 OR {code} > 1114111 OR {code} BETWEEN 55296 AND 57343"
    char = (
        f"CASE WHEN {name}[1] = '#' THEN CASE WHEN {bad} THEN chr(65533) ELSE chr(({code})::INTEGER) END "
        f"ELSE names[{name}] END"
    )
    one = f"CASE WHEN {name} = '' THEN '&' || p ELSE coalesce({char} || substr(p, length({name}) + 2), '&' || p) END"
    parts = f"string_split({column}, '&')"
    whole = f"{parts}[1] || coalesce(array_to_string(list_transform({parts}[2:], lambda p: {one}), ''), '')"
    return (
        rf"regexp_replace(regexp_replace(regexp_replace({whole}, '[ \t\r\f\x0B\x{{A0}}]+', ' ', 'g'), "
        rf"' ?\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')"
    )


# HTML's table of names, as the standard library has it.
_NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
WARC_SQL = (
    WARC_SQL.replace("{names}", f"MAP([{', '.join(map(_text_sql, _NAMED))}], [{', '.join(map(_text_sql, _NAMED.values()))}])")
    .replace("{t2}", _decoded_sql("t2"))
    .replace("{t3}", _decoded_sql("t3"))
)


@query("op9_warc", WARC_SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.build_derivatives(warc.page_responses(table(spark, sf_dir, "pages")), "page_id")


@query("op8_nearest")
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query(
    "op13_exact_dedup",
    """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(exact_dedup.with_rows(table(spark, sf_dir, "documents")))


def _crc32_sql(codes: str) -> str:
    """DuckDB SQL of the CRC-32 of a text given as a list of code points below 256, in UTF-8.

    `crc_table` is a list column with the 256 remainders, from CRC_TABLE.
    """
    octets = (
        f"flatten(list_transform({codes}, lambda c: CASE WHEN c < 128 THEN [c::BIGINT] "
        f"ELSE [(192 + (c >> 6))::BIGINT, (128 + (c & 63))::BIGINT] END))"
    )
    step = "lambda a, o: xor(a >> 8, crc_table[(xor(a, o) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), {step}), 4294967295)"


CRC_TABLE = """crc_table_rows AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda r, k: CASE WHEN (r & 1) = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) ORDER BY i) AS crc_table
  FROM range(256) t(i))"""


@query(
    "op12_spelling",
    rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL HAVING length(run) >= 5
), hashed AS (
  SELECT run, k, ({_crc32_sql("list_transform(string_split(doc_id::VARCHAR || ':' || run, ''), lambda x: ord(x))")})::BIGINT AS h
  FROM runs, crc_table_rows
), slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[1 : (h % length(run))::INT] || run[(h % length(run))::INT + 2 :]
         ELSE run END AS word, k FROM hashed
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM slipped GROUP BY word HAVING length(word) >= 5 AND sum(k) >= 3
), gaps AS (
  SELECT word, n, i, word[1 : i] || word[i + 2 :] AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT DISTINCT * FROM (
    SELECT a.word, b.word AS other, b.n AS m FROM gaps a JOIN gaps b USING (i, rest) WHERE a.word <> b.word
    UNION ALL SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
    UNION ALL SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word)
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS other, max(m) AS m
  FROM near GROUP BY word
), forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form,
         CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)
), chains AS (
  SELECT word, word AS tip, 0 AS step FROM forms
  UNION ALL SELECT c.word, f.form, step + 1 FROM chains c JOIN forms f ON f.word = c.tip WHERE f.form IS NOT NULL
)
SELECT f.*, r.root FROM forms f JOIN (SELECT word, max_by(tip, step) AS root FROM chains GROUP BY word) r USING (word)""",
)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


@query(
    "op11_conversation_trie",
    rf"""
WITH {CRC_TABLE}, own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS txt,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         ({_crc32_sql("list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x))")})::BIGINT % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc_table_rows
), turns AS (
  SELECT c.conv_id, 0 AS tail, pos, role, txt FROM convs c JOIN own o ON o.conv_id = c.base AND pos < h
  UNION ALL SELECT c.conv_id, 1, pos, role, txt FROM convs c JOIN own o ON o.conv_id = c.conv_id AND pos >= h
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY tail, pos) AS depth,
         list([role, txt]) OVER (PARTITION BY conv_id ORDER BY tail, pos) AS prefix FROM turns
), paths AS (
  SELECT conv_id, depth, prefix, len(list_filter(string_split_regex(txt, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words
  FROM numbered
  UNION ALL SELECT conv_id, 0, []::VARCHAR[][], 0 FROM convs
), last AS (
  SELECT conv_id, max(depth) AS total FROM paths GROUP BY conv_id
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(CASE WHEN depth = total THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM paths JOIN last USING (conv_id) GROUP BY prefix, depth
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[: n.depth - 1]
), children AS (
  SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (conv_id, depth)
), own_node AS (
  SELECT p.conv_id AS member, c.* FROM paths p JOIN counted c USING (prefix, depth)
), below AS (
  SELECT DISTINCT a.conv_id, a.depth, b.conv_id AS conv_b, b.depth AS depth_b, b.n_children, b.n_convs, b.words
  FROM own_node a JOIN own_node b ON a.member = b.member AND a.depth <= b.depth
), sums AS (
  SELECT conv_id, depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
         sum((n_convs - 1) * words)::BIGINT AS saved_tokens FROM below GROUP BY conv_id, depth
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM counted JOIN sums USING (conv_id, depth)""",
)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))
