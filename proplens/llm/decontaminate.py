"""Benchmark decontamination by winnowing, in DataFrame operations only.

A text's fingerprints are the smallest k-gram hash of every run of ``window - k + 1`` consecutive k-grams.  Which one is
chosen depends on those words alone, so two texts that share ``window`` consecutive words share a fingerprint.  Training
fingerprints meet those of the benchmark in a join; each meeting point is then extended word by word to both sides, and
a span counts if it reaches ``window`` words.  Items shorter than that are looked up whole, wherever their first word
stands.  Texts are read once for all of it.  A Bloom filter of the benchmark's hashes keeps the other words from becoming
rows; a row carries the few words around its place, never the text, and items with the same words there meet it as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proplens.llm.common import GAPS, forget, plain_words, text_key, words_between, written

#: Fingerprints are one long: 33 bits of hash above 30 bits of position (a text of 2 GB has fewer words than 2**30).
POS_BITS = 30
HASH_MASK = (1 << 33) - 1
#: Longs of a Bloom filter at most (64 KB; three bits a hash, all in one long): under one of 10,000 other hashes passes at
#: 5,000 fingerprints, 2 % at 50,000, more beyond.  Those that pass meet nothing in the join.
BLOOM_LONGS = 1 << 13


def gram_hashes(words: Column, n: int) -> Column:
    """The 64-bit hash of every n-gram; empty for shorter texts."""
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.xxhash64(F.slice(words, i, n)))).otherwise(
        F.array().cast("array<bigint>"))


def placed(hashes: Column) -> Column:
    """hash << 30 | position of every hash."""
    return F.transform(hashes, lambda h, i: F.shiftleft(h.bitwiseAND(HASH_MASK), POS_BITS).bitwiseOR(i.cast("long")))


def grams(words: Column, n: int) -> Column:
    """hash << 30 | position of every n-gram; empty for shorter texts."""
    return placed(gram_hashes(words, n))


def winnowed(packed: Column, width: int) -> Column:
    """The distinct minima of every ``width`` consecutive grams; ties go to the leftmost, which has the smaller position."""
    return F.when(F.size(packed) >= width, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(packed) - width + 1),
        lambda i: F.array_min(F.slice(packed, i, width))))).otherwise(F.array().cast("array<bigint>"))


def exploded(df: DataFrame, packed: str, *cols: str) -> DataFrame:
    """One row per fingerprint: its hash and word position, with the given columns; nulls where there is none.

    The outer form, because for the other Spark puts a filter on the array's size below its expressions, with all of
    them in it once more for each word.
    """
    rows = df.select(*cols, F.explode_outer(packed).alias("print"))
    return rows.select(*cols, F.shiftright("print", POS_BITS).alias("hash"),
                       F.col("print").bitwiseAND((1 << POS_BITS) - 1).cast("int").alias("at"))


class Bloom:
    """A Bloom filter of the column ``hash`` (its low 32 bits), made by Spark as one small array."""

    def __init__(self, hashes: DataFrame):
        rows = hashes.agg(F.approx_count_distinct("hash")).first()[0]
        self.longs = min(BLOOM_LONGS, 1 << (4 * rows).bit_length())
        hash = F.col("hash")
        bits = F.call_function("shiftleft", F.lit(1).cast("long"), self._at(hash, 14))
        for from_bit in (20, 26):
            bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), self._at(hash, from_bit)))
        longs = hashes.select(self._slot(hash).alias("slot"), bits.alias("bits")).groupBy("slot").agg(
            F.bit_or("bits").alias("bits")).collect()  # at most BLOOM_LONGS rows
        found = {r["slot"]: r["bits"] for r in longs}
        self.array = F.split(F.lit(",".join(str(found.get(i, 0)) for i in range(self.longs))), ",").cast("array<bigint>")

    def _slot(self, hash: Column) -> Column:
        return hash.bitwiseAND(self.longs - 1).cast("int")

    def _at(self, hash: Column, from_bit: int) -> Column:
        return F.shiftright(hash, from_bit).bitwiseAND(63).cast("int")

    def may_have(self, hash: Column) -> Column:
        """Bit by bit: nearly all other hashes fail at the first."""
        bit = lambda n: F.bit_get(F.get(self.array, self._slot(hash)), self._at(hash, n)) == 1
        return bit(14) & bit(20) & bit(26)


def _hash_of(words: Column, seed: int = 0) -> Column:
    return F.xxhash64(*([F.lit(seed)] if seed else []), words).bitwiseAND(HASH_MASK)


def item_phrases(items: DataFrame, window: int, k: int) -> DataFrame:
    """hash, near, near_at, phrase, item_id: what of the items texts are compared with.

    Of an item of ``window`` words or more a row for each fingerprint, with the words around it (width - 1 to its left,
    ``window`` from its start on); a shorter one whole, with near_at -1.  Rows with the same words have the same phrase.
    """
    width = window - k + 1
    long = items.filter(F.size("item_words") >= window).withColumn("packed", grams(F.col("item_words"), k)).select(
        "item_id", "item_words", winnowed(F.col("packed"), width).alias("prints"))
    begin = F.greatest(F.col("at") - (width - 1), F.lit(0))
    long = exploded(long, "prints", "item_id", "item_words").select(
        "item_id", "hash", F.slice("item_words", begin + 1, window + width - 1).alias("near"), (F.col("at") - begin).alias("near_at"))
    short = items.filter((F.size("item_words") > 0) & (F.size("item_words") < window)).select(
        "item_id", _hash_of(F.col("item_words"), window).alias("hash"), F.col("item_words").alias("near"), F.lit(-1).alias("near_at"))
    # Words hold no spaces: the key says the place and the words exactly.
    return long.unionByName(short).withColumn("phrase", F.concat_ws(" ", F.col("near_at").cast("string"), F.col("near"))).distinct()


def contaminated_spans(docs: DataFrame, phrases: DataFrame, text_col: str, window: int, k: int) -> DataFrame:
    """k1, k2, phrase, begin, end: the spans of words of a text that stand in a phrase of ``item_phrases``."""
    width = window - k + 1
    texts = docs.select(*text_key(F.col(text_col)), plain_words(F.col(text_col)).alias("words"))
    texts = texts.withColumn("hashes", gram_hashes(F.col("words"), k))
    hash_of = lambda p: F.shiftright(p, POS_BITS)
    bloom = Bloom(phrases.filter("near_at >= 0"))
    # A text none of whose k-grams may be an item's fingerprint has none of them: only the others are winnowed.
    winnow = F.get(F.transform(F.array(placed(F.col("hashes"))), lambda g: winnowed(g, width)), F.lit(0))
    prints = F.when(F.exists("hashes", bloom.may_have), F.filter(winnow, lambda p: bloom.may_have(hash_of(p)))).otherwise(
        F.array().cast("array<bigint>"))
    short = phrases.filter("near_at < 0")
    lengths = sorted(n for (n,) in short.select(F.size("near")).distinct().collect())  # fewer than window
    if lengths:
        whole, first = Bloom(short), Bloom(short.select(_hash_of(F.get("near", F.lit(0))).alias("hash")))
        words = F.col("words")
        starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: first.may_have(_hash_of(F.get(words, i))))
        texts = texts.withColumn("starts", F.when(F.size(words) > 0, starts).otherwise(F.array().cast("array<int>")))
        places = F.flatten(F.transform("starts", lambda i: F.array(*[
            F.when(i + n <= F.size(words), F.shiftleft(_hash_of(F.slice(words, i + 1, n), window), POS_BITS).bitwiseOR(
                i.cast("long"))) for n in lengths])))
        prints = F.concat(prints, F.filter(places, lambda p: p.isNotNull() & whole.may_have(hash_of(p))))
    begin = F.greatest(F.col("at") - (width - 1), F.lit(0))
    rows = exploded(texts.withColumn("prints", prints), "prints", "k1", "k2", "words").select(
        "k1", "k2", "hash", "at", F.slice("words", begin + 1, window + width - 1).alias("here"), (F.col("at") - begin).alias("here_at"))
    # Spark broadcasts the phrases where their bytes allow; else rows are shuffled with the words around their place.
    hits = rows.filter("hash IS NOT NULL").join(phrases.select("hash", "near", "near_at", "phrase").distinct(), "hash")
    here, near, at, here_at, near_at = (F.col(c) for c in ("here", "near", "at", "here_at", "near_at"))
    hits = hits.withColumn("left", _run(here, near, here_at - 1, near_at - 1, -1, width - 1)).withColumn(
        "right", _run(here, near, here_at, near_at, 1, window))
    is_short = near_at < 0
    met = F.when(is_short, F.slice(here, here_at + 1, F.size(near)) == near).otherwise(
        (F.col("right") >= k) & (F.col("left") + F.col("right") >= window))
    return hits.filter(met).select("k1", "k2", "phrase", F.when(is_short, at).otherwise(at - F.col("left")).alias("begin"),
                                   (at + F.when(is_short, F.size(near)).otherwise(F.col("right"))).alias("end")).distinct()


def _run(a: Column, b: Column, a_at: Column, b_at: Column, step: int, n: int) -> Column:
    """How many of the next ``n`` words, going ``step`` from the given places, are the same."""
    same = lambda i: F.get(a, a_at + step * i) == F.get(b, b_at + step * i)
    out = F.lit(n)
    for i in range(n - 1, -1, -1):
        out = F.when(F.coalesce(same(i), F.lit(False)), out).otherwise(F.lit(i))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10, k: int = 5,
                  extra: tuple = ()) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, items (sorted identifiers), spans, contaminated.

    A span is ``[begin, end)`` in words, from 0.  Null and empty texts have no words and no hits; an item without words
    is in no text; the words of an item with a null item_id are hit, but ``items`` doesn't name it.  Items of equal text, and repeated
    items, are all named, each name once.  Rows with equal text share one result, found once.  ``extra`` columns are
    carried along.  An empty benchmark hits nothing, an empty table gives no rows.
    """
    if not 1 <= k <= window:
        raise ValueError("k is at least 1 and at most the window")
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"),
                             plain_words(F.col(item_text_col)).alias("item_words"))
    phrases = written(item_phrases(items, window, k), "item-phrases")
    met = written(contaminated_spans(docs, phrases, text_col, window, k), "phrase-spans")
    names = met.select("k1", "k2", "phrase").distinct().join(phrases.select("phrase", "item_id").distinct(), "phrase").groupBy(
        "k1", "k2").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    hit = written(met.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans")).join(
        names, ["k1", "k2"]), "spans")
    forget(phrases)
    forget(met)
    places = F.flatten(F.transform("spans", lambda s: F.sequence(s["begin"], s["end"] - 1)))
    hit = hit.select("k1", "k2", "items", "spans", F.size(F.array_distinct(places)).cast("long").alias("n_hit"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.size(words_between(F.col(text_col), GAPS)).cast("long").alias("n_words"),
        *text_key(F.col(text_col)), *extra)
    none = lambda c: F.coalesce(c, F.array().cast(dict(hit.dtypes)[c]))
    return rows.join(hit, ["k1", "k2"], "left").select(
        "doc_id", *[c for c in rows.columns if c not in ("k1", "k2", "doc_id")],
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), none("items").alias("items"),
        none("spans").alias("spans"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
