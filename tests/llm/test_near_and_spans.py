"""SimHash groups, decontamination and substring dedup against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from proplens.llm import decontaminate as D
from proplens.llm import simhash, substring_dedup
from proplens.llm.components import connected

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    return WORD.findall((text or "").translate(UP))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def simhash_by_bits(text, k):
    words = spaced((text or "").translate(UP))
    runs = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups_by_pairs(prints, distance):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


@pytest.mark.parametrize("source,distance", [("edge_docs", 2), ("sf_docs", 2), ("edge_docs", 0), ("edge_docs", 3)])
def test_simhash(frame, request, source, distance):
    rows = request.getfixturevalue(source)
    got = simhash.simhash_groups(frame(rows), distance=distance).collect()
    prints = [simhash_by_bits(t, 3) for _, t, *_ in rows]
    group = groups_by_pairs(prints, distance)
    least = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in group}
    want = sorted((str(r[0]), f"{p:016x}", str(least[g])) for r, p, g in zip(rows, prints, group))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want


def test_every_near_pair_meets_at_an_anchor():
    rng = np.random.default_rng(3)
    a = rng.integers(-2**63, 2**63 - 1, 2000, dtype=np.int64)
    for flips in range(3):
        b = a.copy()
        for _ in range(flips):
            b ^= np.int64(1) << rng.integers(0, 64, len(b)).astype(np.int64)
        index, at = simhash.visits(b, 2)
        met = np.zeros(len(a), bool)
        np.logical_or.at(met, index, at == simhash.homes(a)[index])
        assert met.all()


def test_links_match_all_pairs(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(-2**63, 2**63 - 1, 20, dtype=np.int64)
    fp = set()
    for s in seeds:  # groups of near copies, some within two bits of each other
        for _ in range(60):
            fp.add(int(s ^ (np.int64(1) << np.int64(rng.integers(64))) ^ (np.int64(1) << np.int64(rng.integers(64)))))
    fp = sorted(fp)
    df = spark.createDataFrame([(x,) for x in fp], "fp long")
    got = {tuple(r) for r in simhash.links_within(df, 2).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for i, b in enumerate(fp) for a in fp[:i] if ((a ^ b) & mask).bit_count() <= 2}


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}


def test_one_of_each(frame, edge_docs):
    df = frame(edge_docs)
    got = simhash.one_of_each(df).collect()
    prints = [simhash_by_bits(t, 3) for _, t, *_ in edge_docs]
    group = groups_by_pairs(prints, 2)
    want = sorted(str(min((r[0] for r, h in zip(edge_docs, group) if h == g and r[0] is not None), default=None))
                  for g in set(group))
    assert sorted(str(r["doc_id"]) for r in got) == want and got[0].__fields__ == df.columns


def hits_by_windows(text, items, window):
    words, hit, names = plain(text), set(), set()
    for name, item in items:
        w = plain(item)
        n = min(window, len(w))
        runs = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in runs:
                hit |= set(range(i, i + n))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


def leaky(rows):
    items = [(0, "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu"), (1, "Short ITEM here"), (2, None),
             (3, ""), (4, "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu"), (10, "w1 w2"), (11, "solo"),
             (12, "a a a a a a a a a a a a a a a")] + [(20 + i, t) for i, t in enumerate(
                 " ".join(plain(r[1])[30:60]) for r in rows[:40] if r[1])]
    extra = [(900, "x Alpha, beta gamma delta epsilon zeta eta theta iota kappa. lamda mu nu z", "en", "s"),
             (901, "x beta gamma delta epsilon zeta eta theta iota kappa lamda", "en", "s"),
             (902, "gamma delta epsilon zeta eta theta iota kappa lamda", "en", "s"),
             (903, "a short item here solo solo", "en", "s"), (904, "a " * 40, "en", "s"),
             (905, "x Alpha, beta gamma delta epsilon zeta eta theta iota kappa. lamda mu nu z", "en", "s")]
    return items, rows + extra


@pytest.mark.parametrize("longs", [None, 1])
@pytest.mark.parametrize("source", ["edge_docs", "sf_docs"])
def test_decontaminate(spark, frame, request, source, longs, monkeypatch):
    """Also with Bloom filters that are full: they let everything through and the join decides."""
    if longs is not None:
        monkeypatch.setattr(D, "BLOOM_LONGS", longs)
    items, rows = leaky(request.getfixturevalue(source))
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS hash", "'y' AS words")
    got = D.decontaminate(frame(rows), bench).collect()
    want = sorted((str(r[0]), *hits_by_windows(r[1], items, 10)) for r in rows)
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], list(r["items"])) for r in got) == want
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in got)


def removed_by_windows(rows, window):
    first = {}
    texts = [spaced(r[1]) for r in rows]
    ids = [r[0] if r[0] is not None else 1 << 70 for r in rows]
    for i, w in zip(ids, texts):
        for j in range(len(w) - window + 1):
            t = tuple(w[j:j + window])
            first[t] = min(first.get(t, i), i)
    for r, i, w in zip(rows, ids, texts):
        gone = {j + k for j in range(len(w) - window + 1) if first[tuple(w[j:j + window])] < i for k in range(window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        yield str(r[0]), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("window,m,bucket_rows", [(50, 8, 5000), (50, 8, 3), (20, 20, 5000), (7, 1, 10)])
@pytest.mark.parametrize("source", ["edge_docs", "sf_docs"])
def test_substring_dedup(frame, request, source, window, m, bucket_rows):
    rows = request.getfixturevalue(source)
    got = substring_dedup.substring_dedup(frame(rows), window=window, m=m, bucket_rows=bucket_rows).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == sorted(
        removed_by_windows(rows, window))
    for r in got:
        assert len({i for s in r["spans"] for i in range(s["begin"], s["end"])}) == r["n_removed"]


def test_empty(spark, frame, sf_docs):
    none = frame([])
    items = spark.createDataFrame([], "item_id long, text string")
    assert simhash.simhash_groups(none).count() == simhash.one_of_each(none).count() == 0
    assert D.decontaminate(none, items).count() == substring_dedup.substring_dedup(none).count() == 0
    assert D.decontaminate(frame(sf_docs[:5]), items).filter("contaminated").count() == 0


def test_substring_buckets_are_bounded_by_windows(frame):
    """A line repeated through long texts is one super-k-mer of very many windows; both ways give brute force's rows."""
    line = " ".join(f"w{i}" for i in range(20))
    rows = [(1, f"{line} " * 300, None, None), (2, "start " + f"{line} " * 200 + "end", None, None), (3, line, None, None)]
    spread = substring_dedup.substring_dedup(frame(rows), bucket_windows=100).collect()
    sorted_ = substring_dedup.substring_dedup(frame(rows), bucket_rows=10 ** 6, bucket_windows=10 ** 9).collect()
    assert sorted(map(tuple, spread)) == sorted(map(tuple, sorted_))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in spread}
    assert got == {1: (6000, 0), 2: (4002, 4000), 3: (20, 0)}


def test_decontaminate_stock_phrase_and_short_items(spark, frame):
    """Items that share a phrase are all named; a short item counts wherever it stands, its first word alone doesn't."""
    stock = "the following ten words stand in each of these many items"
    items = [(i, f"{stock} number {i}") for i in range(50)] + [(None, f"{stock} without a name"), (60, "the end"), (61, "of")]
    rows = [(1, f"so {stock} and the end", None, None), (2, "the the the end of the", None, None), (3, "the ends", None, None),
            (4, f"so {stock} and the end", None, None)]
    got = D.decontaminate(frame(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    named = [(n, t) for n, t in items if n is not None]
    want = sorted((r[0], *hits_by_windows(r[1], named, 10)) for r in rows)
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in got) == want


def test_substring_window_of_very_many_texts(frame):
    """One passage in many texts: all but the smallest identifier's lose it, whichever part they are dealt to."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own{i} {passage} tail{i}", None, None) for i in range(3, 300)]
    got = substring_dedup.substring_dedup(frame(rows), bucket_rows=10).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {3: 0} | {i: 60 for i in range(4, 300)}
