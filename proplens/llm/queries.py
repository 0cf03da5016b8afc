"""The operators' queries over whole tables, with production parameters, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proplens.llm import (decontaminate, exact_dedup, hard_negatives, language_id, license_scan, mixing, prefix_trie,
                          sharding, simhash, substring_dedup, token_counts, token_output, url_filter)
from proplens.llm.common import PLAIN_WORD, SPACED_WORD, UPPER, documents

SHARDS = 40
TOKENIZER = "byte_bpe_50k.json"
RULES = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
         url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]


def op1_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(documents(spark, sf_dir), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir), keep="max")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(documents(spark, sf_dir), shingle=3, distance=2).select(
        "doc_id", "fingerprint", "component_id")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = decontaminate.decontaminate(documents(spark, sf_dir), items, window=10, k=5)
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), end_id=0)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir), window=50).drop("spans")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    listed = url_filter.listed_pages(pages, min_words=50, distinct_share=0.25)
    return url_filter.filter_urls(pages, listed, RULES).select("page_id", "host", "path", "rule", "verdict", "listed")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir)).drop("spans")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, *language_id.fit(docs))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir), weights=(3, 1, 2), share=1.5, cap=2.0).select(
        "doc_id", "size", "source_size", "target", "taken")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), limit=512)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = hard_negatives.whole_vectors(rows, scale=256, label=label)
    return hard_negatives.hard_negatives(whole, F.col("vec_id") % 100 == 0, positives=5, negatives=10, band=(30, 90))


QUERIES = {f.__name__: f for f in (
    op1_ring_shards, op2_exact_dedup, op3_simhash, op4_decontaminate, op5_token_output, op6_substring_dedup,
    op7_url_filter, op8_license_scan, op9_language_id, op10_mixing, op11_prefix_trie, op12_token_counts,
    op13_hard_negatives)}

#: CRC-32 of a string's characters, bit by bit.
_CRC = """xor(list_reduce(list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda a, x:
  list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(a, x)),
  CAST(4294967295 AS BIGINT)), 4294967295)"""
_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
#: A page without scripts, styles, comments and tags.
_SEEN = "coalesce(html, '')"
for _pattern in url_filter.UNSEEN:
    _SEEN = f"regexp_replace({_SEEN}, '{_pattern}', ' ', 'g')"

ORACLE = {
    "op2_exact_dedup": """
WITH g AS (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size FROM documents GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM documents JOIN g ON coalesce(text, '') = t""",
    "op4_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{PLAIN_WORD}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '{PLAIN_WORD}') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS n, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i
  FROM b WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM bw),
dw AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
  FROM d, (SELECT DISTINCT n FROM bg) WHERE len(w) >= n),
hit AS (SELECT DISTINCT doc_id, item_id, i, dg.n FROM
  (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM dw) dg JOIN bg ON dg.n = bg.n AND dg.g = bg.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, i + unnest(range(n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op6_substring_dedup": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED_WORD}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM
  (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
late AS (SELECT doc_id, i FROM win JOIN (SELECT g, min(doc_id) AS f FROM win GROUP BY g) USING (g) WHERE f < doc_id),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(50)) AS p FROM late),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM
  (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op7_url_filter": rf"""
WITH u AS (SELECT page_id, url, html,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), '{UPPER}', '{UPPER.lower()}') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path FROM pages),
q AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(url, '^[^#]*?\?([^#]*)', 1, 's'), '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)'))) AS query FROM u),
c AS (SELECT * EXCLUDE (html), regexp_replace(host, ':(80|443)$', '')
    || regexp_replace(regexp_replace(path, '/index\.html?$', '/'), '/+$', '')
    || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS canonical,
    regexp_extract_all(translate({_SEEN}, '{UPPER}', '{UPPER.lower()}'), '{PLAIN_WORD}') AS words FROM q),
w AS (SELECT page_id, canonical, words, row_number() OVER (PARTITION BY words ORDER BY page_id NULLS FIRST, canonical) AS i
  FROM c WHERE host <> '' AND len(words) >= 50),
l AS (SELECT canonical FROM w WHERE len(list_distinct(words)) < len(words) * 0.25
  UNION SELECT w.canonical FROM w JOIN w f ON f.words = w.words AND f.i = 1 WHERE w.canonical <> f.canonical),
r AS (SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
  host <> '' AND canonical IN (SELECT canonical FROM l) AS listed FROM c)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow' WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed FROM r""",
    "op10_mixing": f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{SPACED_WORD}')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS point
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
f AS (SELECT *, 2.0::DOUBLE * source_size / weight AS fills FROM w),
g AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER upto, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER upto, 0)) AS rate FROM f
  WINDOW upto AS (ORDER BY fills, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size,
    max(rate) OVER () * weight) AS target FROM g),
p AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS whole FROM t),
e AS (SELECT doc_id, point, size, d.source, source_size, target, whole, target - whole * source_size AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY point) AS upto,
    sum(size) OVER (PARTITION BY d.source, point) AS here FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
x AS (SELECT *, max(CASE WHEN upto - here <= budget THEN point END) OVER (PARTITION BY source) AS edge FROM e)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN budget > 0 AND (point < edge
  OR point = edge AND here - (budget - (upto - here)) < budget - (upto - here)) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM x""",
    "op11_prefix_trie": f"""
WITH t AS (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    strlen(coalesce(text, '')) AS b FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'k': k, 'b': b}} ORDER BY turn NULLS FIRST, k) AS own,
    {_CRC.format("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM t GROUP BY conv_id),
r AS (SELECT o.conv_id, list_concat(coalesce(p.own[1:o.h], []), o.own[o.h + 1:]) AS s
  FROM o LEFT JOIN o p ON p.conv_id = o.conv_id - o.conv_id % 5),
m AS (SELECT conv_id, s, d, list_transform(s[1:d], lambda x: x.k) AS path
  FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM r)),
n AS (SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    any_value(CASE WHEN d > 0 THEN s[d].b ELSE 0 END) * (count(*) - 1) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = len(s)), '')) AS ends_sha256
  FROM m GROUP BY path),
k AS (SELECT path[1:depth - 1] AS path, count(*) AS kids FROM n WHERE depth > 0 GROUP BY 1),
u AS (SELECT n.*, coalesce(kids, 0) AS n_children FROM n LEFT JOIN k USING (path)),
b AS (SELECT path[1:d] AS path, sum(saved) AS saved, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM u) GROUP BY 1)
SELECT u.conv_id, u.depth, up.conv_id AS parent_conv_id, u.n_convs, u.n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, u.ends_sha256
FROM u JOIN b USING (path) LEFT JOIN u up ON u.depth > 0 AND up.path = u.path[1:u.depth - 1]""",
    "op13_hard_negatives": """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT * FROM (SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
WHERE rank <= 10""",
}
