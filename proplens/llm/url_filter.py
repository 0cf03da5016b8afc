"""URL filter: ordered host/path rules, then a list of canonical URLs behind a blocked Bloom filter.

DataFrame operations only.  The filter is a table of 64-bit blocks; a URL's hash names one block and a few bits in it.
It is built by one ``bit_or`` per block and probed by one join on the block number.  Up to ``max_blocks`` blocks the table
is broadcast; a longer list's is not, and URLs are dealt to its partitions by block, so that the filter never fills up.
URLs that pass go to an exact hash join with the list, which removes the false positives.

``listed_pages`` makes the list from the pages themselves: those whose words are mostly repeats, and those that say what
an earlier page says under another URL.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proplens.llm.common import UPPER, plain_words, written

BITS_PER_URL = 12
PROBES = 4
#: Blocks of 12 bytes that are broadcast at most.
MAX_BLOCKS = 1 << 20
#: What a reader of a page doesn't see.
UNSEEN = (r"(?is)<script\b[^>]*>.*?</script>", r"(?is)<style\b[^>]*>.*?</style>", r"(?s)<!--.*?-->", r"<[^>]*>")


@dataclass(frozen=True)
class Rule:
    """Fits a host and all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for text without ``://``."""
    part = lambda i: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))
    return F.translate(part(1), UPPER, UPPER.lower()), part(2)


def canonical_url(url: Column, host: Column, path: Column) -> Column:
    """Host and path without default port, index page or closing slash, with the query but for tracking parameters.

    The scheme and the fragment say nothing about the page and go.
    """
    query = F.regexp_extract(url, r"(?s)^[^#]*?\?([^#]*)", 1)
    query = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|gclid|fbclid)(=|$)")))
    bare = F.regexp_replace(F.regexp_replace(path, r"/index\.html?$", "/"), r"/+$", "")
    return F.concat(F.regexp_replace(host, r":(80|443)$", ""), bare,
                    F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(F.lit("")))


def rule_columns(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, else null.  The rules are a short parameter, not a table."""
    name = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.host + r.path), r.host, r.verdict)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = (F.when if name is None else name.when)(fits, F.lit(r.host + r.path))
        verdict = (F.when if verdict is None else verdict.when)(fits, F.lit(r.verdict))
    none = F.lit(None).cast("string")
    return (none if name is None else name), (none if verdict is None else verdict)


def _probe(url: Column, blocks: int) -> tuple[Column, Column]:
    """Block number and the bits of a URL in it."""
    h = F.xxhash64(url)
    mask = F.lit(0).cast("long")
    for i in range(PROBES):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"),
                                              F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")))
    return F.pmod(F.shiftrightunsigned(h, 6 * PROBES), F.lit(blocks)), mask


def bloom_blocks(listed: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The filter as (block, word), and its number of blocks, a power of two for ``n`` URLs."""
    blocks = 1 << max(0, math.ceil(math.log2(max(1, n * BITS_PER_URL / 64))))
    block, mask = _probe(F.col("canonical"), blocks)
    return listed.select(block.alias("block"), mask.alias("mask")).groupBy("block").agg(
        F.bit_or("mask").alias("word")), blocks


def visible_words(html: Column) -> Column:
    """Lower-cased words of a page outside scripts, styles, comments and tags; null has none."""
    for pattern in UNSEEN:
        html = F.regexp_replace(html, pattern, " ")
    return plain_words(html)


def listed_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_words: int = 50, distinct_share: float = 0.25) -> DataFrame:
    """(canonical, reason) of pages that the list should hold, judged by each page's content and never by its host.

    ``junk``: of at least ``min_words`` visible words, the share of distinct ones is below ``distinct_share``.  ``copy``: a
    page of at least ``min_words`` words has exactly the words of another whose URL is another; of the URLs that say the
    same, that of the smallest identifier (null first, then by URL) isn't listed.  A null URL, one without host and a null
    page are never listed.  Copies are counted by URL before they meet, so many copies of one page are one row each.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"),
                        visible_words(F.col(html_col)).alias("words")).filter(F.col("host") != "")
    said = F.array_join("words", " ")
    rows = rows.select("id", canonical_url(F.col("url"), F.col("host"), F.col("path")).alias("canonical"),
                       F.size("words").alias("n"), F.size(F.array_distinct("words")).alias("different"),
                       F.sha2(said.cast("binary"), 256).alias("said")).filter(F.col("n") >= min_words)
    rows = written(rows, "page-words")
    junk = rows.filter(F.col("different") < F.col("n") * distinct_share).select("canonical", F.lit("junk").alias("reason"))
    seen = rows.groupBy("said", "canonical").agg(F.min(F.struct("id", "canonical")).alias("at"))
    first = seen.groupBy("said").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("urls")).filter("urls > 1")
    copies = seen.join(first, "said").filter(F.col("canonical") != F.col("first.canonical")).select(
        "canonical", F.lit("copy").alias("reason"))
    return junk.unionByName(copies).distinct()


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
                max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, canonical, listed.

    listed: a frame with a column ``canonical`` (see ``canonical_url``); nulls and repeats in it don't matter.  The
    verdict is that of the longest fitting rule, else block for a listed URL and allow for any other.  A null URL, or
    one without ``://``, has an empty host and path, fits no rule and is never listed.  An empty list blocks nothing,
    an empty table gives no rows.
    """
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    urls = urls.select("page_id", "host", "path", name.alias("rule"), verdict.alias("by_rule"), F.when(
        F.col("host") != "", canonical_url(F.col("url"), F.col("host"), F.col("path"))).alias("canonical"))
    entries = written(listed.select("canonical").filter("canonical is not null").distinct(), "listed")
    table, blocks = bloom_blocks(entries, entries.count())
    block, mask = _probe(F.col("canonical"), blocks)
    # At most max_blocks rows of 12 bytes are broadcast; else both sides are shuffled by block, where adaptive execution
    # splits a block that many URLs fall in.
    probed = urls.withColumn("block", block).withColumn("mask", mask).join(
        F.broadcast(table) if blocks <= max_blocks else table.hint("merge"), "block", "left").withColumn(
        "maybe", F.coalesce(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False)))
    # Only possible hits carry a key into the exact join; a null key meets nothing.
    hits = entries.select(F.col("canonical").alias("maybe_url"), F.lit(True).alias("hit"))
    sure = probed.filter(~F.col("maybe") | F.col("canonical").isNull()).withColumn("listed", F.lit(False))
    tested = probed.filter(F.col("maybe") & F.col("canonical").isNotNull()).join(
        hits, F.col("canonical") == F.col("maybe_url"), "left").withColumn("listed", F.coalesce("hit", F.lit(False)))
    out = sure.unionByName(tested.drop("maybe_url", "hit"))
    return out.select("page_id", "host", "path", "rule", F.coalesce(
        "by_rule", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "canonical", "listed")
