"""Prefix trie, token counts and hard negatives against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from proplens.llm import hard_negatives, prefix_trie, token_counts
from tests.llm.conftest import SF, add_clashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(rows):
    """The contract's nodes by dictionaries of prefixes."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    seq = {c: tuple(own.get(c - c % 5, [])[:zlib.crc32(str(c).encode()) % 9] + v[zlib.crc32(str(c).encode()) % 9:])
           for c, v in own.items()}
    members, kids, saved, leaves = (defaultdict(x) for x in (list, int, int, int))
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += p not in kids
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seq[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def conversations(kind):
    rng = random.Random(11)
    if kind == "edges":
        rows = [(1, None, None, None), (1, 0, "user", ""), (2, 0, "user", "é"), (3, 5, None, "x"), (3, 5, None, "x"),
                (3, 5, "a", "x"), (None, 0, "user", "lost"), (4, 1, "u", "ab"), (4, 0, "ua", "b"), (12, 0, "u", "only"),
                (5, 0, "user", "long " * 50_000), (6, 0, "user", "long " * 50_000)]
        return rows + [(0, t, "user", f"turn {t // 3}") for t in range(90)]  # one conversation in many stretches
    if kind == "copies":  # a third are copies, nearly all begin alike
        rows = [(c, t, "user", f"same {t}") for c in range(60) for t in range(11)]
        return rows + [(100 + c, t, "user", f"same {t}" if t < rng.randrange(14) else f"{c} {t}")
                       for c in range(120) for t in range(rng.randrange(1, 14))]
    return [(rng.randrange(80), rng.randrange(6), rng.choice("ab"), rng.choice("xyz")) for _ in range(500)]


@pytest.mark.parametrize("kind", ["edges", "copies", "ties"])
@pytest.mark.parametrize("block", [1, 4])
def test_trie(spark, monkeypatch, kind, block):
    monkeypatch.setattr(prefix_trie, "STRETCH", 16)
    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    rows = conversations(kind)
    df = add_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    got = prefix_trie.conversation_trie(df, block).select(*NODE).collect()
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == trie(rows)


def test_trie_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = prefix_trie.conversation_trie(df).select(*NODE).collect()
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == trie([tuple(r) for r in df.collect()])
    assert prefix_trie.conversation_trie(df.limit(0)).count() == 0


def test_blocks_are_taken_apart_only_where_they_diverge(spark):
    """Two conversations agree on their first block and differ in the second: only that one's distinct blocks are split."""
    turns = spark.createDataFrame([(c, 6, d, f"d{d}" if d < 6 else f"{c}", d) for c in (1, 2) for d in range(1, 7)],
                                  "conv_id long, length long, depth long, digest string, n_bytes long")
    convs = spark.createDataFrame([(1, 6), (2, 6), (3, 0)], "conv_id long, length long")
    nodes, ends = prefix_trie.prefix_trie(turns, convs, 4)
    got = {(r["conv_id"], r["depth"]): r["n_convs"] for r in nodes.collect()}
    assert got == {(1, 0): 3, **{(1, d): 2 for d in range(1, 6)}, (1, 6): 1, (2, 6): 1}
    assert sorted(map(tuple, ends.collect())) == [(1, 0, 3), (1, 6, 1), (2, 6, 2)]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("source", ["edge_docs", "sf_docs"])
def test_token_counts(frame, request, source, tokenizer):
    rows = request.getfixturevalue(source) + [(500, "<|endoftext|> don't\r\n  stop\n\n<|endoftext|>", None, None),
                                              (501, "a\0b <|endoftext|", None, None), (502, "x" * 30_000, None, None)]
    got = token_counts.count_tokens(frame(rows), PATH, 512).collect()
    want = []
    for i, t, *_ in rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want.append((str(i), len((t or "").encode()), n, n > 512))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == sorted(want)
    assert all(0 <= r["n_shortcut"] <= r["n_tokens"] for r in got) and any(r["n_shortcut"] for r in got)
    assert token_counts.count_tokens(frame([]), PATH, 512).count() == 0


def test_counts_like_the_library(tokenizer):
    counter = token_counts.Counter(PATH, token_counts.proven_tokens(PATH), token_counts.proven_texts(PATH),
                                   token_counts.proven_characters(PATH))
    rng = random.Random(5)
    kinds = [" \n\t\ra1.!'éB²\xa0\x1c\x85 漢字 s t ", "ab éßĀɏ.,!?'", [chr(i) for i in range(700)],
             [chr(rng.randrange(0xD800)) for _ in range(4000)], [" the", " of", "ing", "'s", "'", " ", "\n", "12", " don't", "<|"]]
    texts = ["".join(rng.choice(k) for _ in range(rng.randrange(30))) for k in kinds for _ in range(3000)]
    n, straight = counter.count(pa.array(texts))
    for t, a, e in zip(texts, n, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert a == len(e.ids), repr(t)
    n, straight = counter.count(pa.array([" the of and"]))
    assert n[0] == straight[0] == 3


def test_proven_tokens_encode_alone(tokenizer):
    texts = sorted(token_counts.proven_texts(PATH))
    assert len(texts) > 45_000
    assert all(len(e.ids) == 1 for e in tokenizer.encode_batch(texts, add_special_tokens=False))


def test_only_proven_tokenizers():
    with pytest.raises(ValueError):
        token_counts.proven_tokens(public_tokenizers.path("word_bpe_49k.json"))


def negatives(rows, every, positives=5, count=10):
    """The contract's rows by all products."""
    whole = [(i, v, label) for i, v, label in rows if None not in (i, v, label)
             and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v, _ in whole), default=0)
    q = np.array([[int(np.floor(256 * float(x))) for x in v] + [0] * (width - len(v)) for _, v, _ in whole]).reshape(-1, width)
    out = []
    for i in sorted({r[0] for r in whole if r[0] % every == 0}):
        a = min((label, [int(x) for x in q[j][:len(v)]], j) for j, (k, v, label) in enumerate(whole) if k == i)[2]
        s = [int(x) for x in q @ q[a]]
        best = sorted((-s[j], r[0]) for j, r in enumerate(whole) if r[0] != i and r[2] == whole[a][2])[:positives]
        for p, name in best:
            near = sorted((-s[j], r[0]) for j, r in enumerate(whole) if r[2] != whole[a][2]
                          and 30 * -p <= 100 * s[j] <= 90 * -p)[:count]
            out += [(i, name, k + 1, n, -p, -x) for k, (x, n) in enumerate(near)]
    return sorted(out)


def vectors(kind):
    rng = np.random.default_rng(3)
    if kind == "edges":
        v = rng.normal(size=4).round(3).tolist()
        rows = [(0, v, 1), (1, v, 1), (2, v, 2), (3, None, 1), (4, v, None), (None, v, 1), (5, [1.0, None, 2.0, 3.0], 1),
                (6, [float("nan"), 1.0, 1.0, 1.0], 1), (7, [float("inf"), 1.0, 1.0, 1.0], 1), (8, [], 1), (9, [0.0] * 4, 2), (10, v[:2], 2),
                (11, [x * 1e5 for x in v], 2), (12, [x * .5 for x in v], 3), (10, [-x for x in v], 5), (1, v, 1), (20, v, 7)]
        return rows + [(30 + i, [x * .8 for x in v], 3) for i in range(15)]
    if kind == "copies":  # a third of all rows is one vector
        rows = [(i, [.5, .25, -.5, .125], i % 3) for i in range(150)]
        return rows + [(150 + i, x.tolist(), int(i % 3)) for i, x in enumerate(rng.normal(size=(300, 4)).round(1))]
    spread = rng.normal(size=(500, 12)) * np.exp(rng.normal(size=(500, 1)) * 1.5)  # lengths of all sizes
    return [(i, x.tolist(), int(rng.integers(0, 4))) for i, x in enumerate(spread)]


@pytest.mark.parametrize("kind", ["edges", "copies", "lengths"])
def test_hard_negatives(spark, monkeypatch, kind):
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 16)
    rows = vectors(kind)
    df = add_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3))
    whole = hard_negatives.whole_vectors(df)
    got = hard_negatives.hard_negatives(whole, F.col("vec_id") % 10 == 0, column_rows=100, group_anchors=8).collect()
    assert sorted(map(tuple, got)) == negatives(rows, 10)
    none = hard_negatives.hard_negatives(whole.limit(0), F.col("vec_id") % 10 == 0)
    assert none.count() == 0 and none.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                                  "negative_score"]


def test_feasible_ranges_lose_nothing_and_prune():
    rng = np.random.default_rng(9)
    v = np.floor(rng.normal(size=(2000, 8)) * 300)
    lengths = np.sqrt((v ** 2).sum(1))
    order = np.argsort(-lengths)
    b = hard_negatives.Bucket(order, np.zeros(2000, int), v[order], lengths[order])
    for i in range(50):
        q = v[i]
        d = q / np.linalg.norm(q)
        focus = np.argsort(-np.abs(d))[:6]
        cosines = (v[order] @ q) / lengths[order] / np.linalg.norm(q)
        rows = b.feasible(d, focus, 0.95)
        assert set(np.flatnonzero(cosines >= 0.95)) <= set(rows) and len(rows) < 200
