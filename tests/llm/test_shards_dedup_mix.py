"""Sharding, exact dedup and mixing against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from proplens.llm import exact_dedup, mixing, sharding


def ring_by_walking(rows, shards, vnodes, load):
    """Offers row by row: in step h each arc's rest, in rank order, goes to the point h steps on."""
    at, owner = sharding.ring(shards, vnodes)
    room = sharding.capacities(len(rows), shards, load).tolist()
    left = defaultdict(list)
    for point, *row in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3])):
        left[int(np.searchsorted(at, point)) % len(at)].append(row)
    out, used, hop = [], Counter(), 0
    while any(left.values()):
        for arc in range(len(at)):
            s = int(owner[(arc + hop) % len(at)])
            while left[arc] and used[s] < room[s]:
                out.append((*left[arc].pop(0), s, used[s]))
                used[s] += 1
        hop += 1
    return out


def shard_input(spark, df):
    from pyspark.sql import functions as F
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = df.select(F.col("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("crc"))
    return [tuple(r) for r in rows.select(F.xxhash64("doc_id", "size", "crc"), "doc_id", "size", "crc").collect()]


@pytest.mark.parametrize("load", [None, 1.1])
@pytest.mark.parametrize("source", ["edge_docs", "sf_docs"])
def test_shards(spark, frame, request, source, load):
    rows = request.getfixturevalue(source)
    df = frame(rows)
    got = sorted((tuple(r) for r in sharding.shard_rows(df, 7, vnodes=16, load=load).collect()), key=str)
    assert got == sorted(ring_by_walking(shard_input(spark, df), 7, 16, load), key=str)
    counts, slots = Counter(r[3] for r in got), defaultdict(list)
    for r in got:
        slots[r[3]].append(r[4])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if load is None:
        assert max(counts.values()) - min(counts[s] for s in range(7)) <= 1
    assert Counter((r[0], r[1], r[2]) for r in got) == Counter(
        (i, 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t, *_ in rows)


def test_one_row_many_times(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 64)
    df = spark.range(1000).selectExpr("cast(5 as long) doc_id", "'same' text")
    got = sharding.shard_rows(df, 6, vnodes=8).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [166, 166, 167, 167, 167, 167]


def test_growth_moves_few(spark):
    df = spark.range(6000).selectExpr("id doc_id", "'t' text")
    a = {r[0]: r[3] for r in sharding.shard_rows(df, 10, load=1.1).collect()}
    b = {r[0]: r[3] for r in sharding.shard_rows(df, 11, load=1.1).collect()}
    assert sum(a[i] != b[i] for i in a) < 6000 * 0.25  # a plain remainder would move ten of eleven


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("source", ["edge_docs", "sf_docs"])
def test_exact_dedup(frame, request, source, keep):
    rows = request.getfixturevalue(source)
    got = exact_dedup.exact_dedup(frame(rows), keep=keep, runs=5, fan_in=2).collect()
    ids, size, kept = defaultdict(list), Counter(), Counter()
    for i, t, *_ in rows:
        size[t or ""] += 1
        if i is not None:
            ids[t or ""].append(i)
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in size}
    assert len(got) == len(rows)
    for r in got:
        t = sha[r["text_sha256"]]
        assert r["group_size"] == size[t] and r["keep_id"] == (min if keep == "min" else max)(ids[t], default=None)
        if r["kept"]:
            kept[t] += 1
            assert r["doc_id"] == r["keep_id"]
    assert all(kept[t] == 1 for t in size)


def mix_by_loops(rows, points, weights, share, cap):
    size = [len((t or "").encode().split()) for _, t, *_ in rows]
    by = defaultdict(int)
    for (_, _, _, s), n in zip(rows, size):
        by[s] += n
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None] * (None in by)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(size), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        target = fixed | {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if target[s] > cap * by[s] + 1e-9]
        if not over:
            break
        fixed |= {s: cap * by[s] for s in over}
    return by, target


@pytest.mark.parametrize("source", ["edge_docs", "sf_docs"])
def test_mixing(frame, request, source):
    rows = request.getfixturevalue(source)
    got = mixing.mix_sources(frame(rows), bits=3).collect()
    assert len(got) == len(rows)
    by, target = mix_by_loops(rows, None, (3, 1, 2), 1.5, 2.0)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == by[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    same = Counter((i, t, s) for i, t, _, s in rows)
    for i, t, _, s in rows:
        largest[s] = max(largest[s], len((t or "").encode().split()) * same[i, t, s])
    for s in by:
        assert abs(taken[s] - target[s]) <= largest[s]
    again = mixing.mix_sources(frame(list(reversed(rows))), bits=12).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_empty(frame):
    assert sharding.shard_rows(frame([]), 4, vnodes=4).count() == 0
    assert exact_dedup.exact_dedup(frame([])).count() == 0
    assert mixing.mix_sources(frame([])).count() == 0
