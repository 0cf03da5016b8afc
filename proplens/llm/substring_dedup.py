"""Substring dedup by super-k-mer partitioning.

The minimiser of a window is its smallest m-gram hash.  Consecutive windows mostly share it, and travel together as one
packed string to the bucket of that minimiser, where the windows of all texts are sorted and counted as they are.  Equal
windows have equal minimisers, so no bucket needs another.

Three reductions come before any text moves.  Equal texts are judged once: of a later copy every window is in the first.
A minimiser seen in one text only can have no shared window, so its super-k-mers stay home.  And a bucket with more than
``bucket_rows`` super-k-mers or ``bucket_windows`` windows (one line repeated through a long text is one super-k-mer) is not
sorted in one place: its windows are spread by their own SHA-256 and combined before the shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proplens.llm.common import text_key, written

#: Windows of a spread bucket that are handed on at once.
SPREAD_WINDOWS = 8192
#: Parts that the texts holding one spread window are dealt to.
SALTS = 64
#: Bytes of text that are hashed at once; a longer document is handled whole.
BLOCK_BYTES = 2 << 20
#: A null identifier is later than any other.
LAST = (1 << 63) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in concatenated texts, and the number of the first word of each text (and the end)."""
    blank = _SPACE[data]
    before, after = np.r_[True, blank[:-1]], np.r_[blank[1:], True]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(~blank & before)
    return starts, np.flatnonzero(~blank & after) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    power = np.full(len(data) + 1, _ODD)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    total = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)]
    # Shifting every word to the same power keeps the sum free of its place; odd numbers are units modulo 2**64.
    back = np.full(len(data) + 1, np.uint64(pow(int(_ODD), -1, 1 << 64)))
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    return _mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def super_kmers(data: np.ndarray, offsets: np.ndarray, window: int, m: int):
    """(words per text, text of each super-k-mer, minimiser hash, first window, number of windows), in reading order."""
    starts, ends, first = word_bounds(data, offsets)
    n_words, n = np.diff(first), len(starts)
    none = np.zeros(0, np.int64)
    if n < window:
        return n_words, none, none, none, none
    h = word_hashes(data, starts, ends)
    gram = np.zeros(n - m + 1, np.uint64)
    factor = 1
    for j in range(m):
        factor = factor * int(_ODD) % (1 << 64) | 1
        gram += h[j:n - m + 1 + j] * np.uint64(factor)
    gram = _mix(gram)
    bits = np.uint64(max(1, int(n).bit_length()))
    low = (gram >> bits << bits) | np.arange(len(gram), dtype=np.uint64)  # ties: the leftmost
    width, step = window - m + 1, 1
    while step * 2 <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    low = np.minimum(low[:len(low) - (width - step)], low[width - step:])
    at = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(n_words)), n_words)[:len(at)]
    ok = np.flatnonzero(np.arange(len(at)) + window <= first[1:][text])
    # The hash decides, not its place: a stretch that repeats one m-gram stays one super-k-mer.
    new = np.r_[True, (np.diff(ok) != 1) | (gram[at[ok[1:]]] != gram[at[ok[:-1]]])] if len(ok) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    lead = ok[begin]
    return (n_words, text[lead], gram[at[lead]].view(np.int64), lead - first[text[lead]],
            np.diff(np.r_[begin, len(ok)]))


def _buffers(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = text.cast(pa.binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def _blocks(batch: pa.RecordBatch, column: str):
    """Slices of a batch with about BLOCK_BYTES of text each."""
    ends = _buffers(batch[column])[1][1:]
    begin = 0
    while begin < batch.num_rows:
        base = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _joined_sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def scan_rows(docs: DataFrame, id_col: str, text_col: str, window: int, m: int) -> DataFrame:
    """One row per document: key of the text, identifier, words, hash of the joined words and its super-k-mers."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*text_key(text), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))

    def run(batches):
        for batch in batches:
            for b in _blocks(batch, "text"):
                n_words, owner, h, start, n = super_kmers(*_buffers(b["text"]), window, m)
                at = pa.array(np.searchsorted(owner, np.arange(b.num_rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(t)))
                         for x, t in ((h, np.int64), (start, np.int32), (n, np.int32))]
                sha = [_joined_sha(t.as_py().encode().split()) for t in b["text"]]
                yield pa.RecordBatch.from_arrays(
                    [b["k1"], b["k2"], b["doc_id"], pa.array(n_words), pa.array(sha), *lists],
                    ["k1", "k2", "doc_id", "n_words", "sha", "h", "start", "n"])

    return rows.mapInArrow(run, "k1 long, k2 long, doc_id long, n_words long, sha string, "
                                "h array<long>, start array<int>, n array<int>")


def _spans(start: int, flagged: list[int], window: int):
    """[begin, end) of words covered by the flagged windows of a super-k-mer, consecutive windows as one span."""
    begin = last = flagged[0]
    for j in flagged[1:]:
        if j != last + 1:
            yield start + begin, start + last + window
            begin = j
        last = j
    yield start + begin, start + last + window


def sort_bucket(rows: list[tuple], window: int):
    """(row, flagged windows) for rows (text id, packed words) of one bucket.

    All windows are sorted as the words they are, then by text id; of equal ones those after the smallest id are flagged.
    """
    if len({r[0] for r in rows}) < 2:
        return
    flagged: dict[int, list[int]] = {}
    windows = []
    for i, (owner, packed) in enumerate(rows):
        ends = [-1]
        at = packed.find(b" ")
        while at >= 0:
            ends.append(at)
            at = packed.find(b" ", at + 1)
        ends.append(len(packed))
        windows += [(packed[ends[j] + 1:ends[j + window]], owner, i, j) for j in range(len(ends) - window)]
    windows.sort()
    seen = first = None
    for words, owner, i, j in windows:
        if words != seen:
            seen, first = words, owner
        elif owner > first:
            flagged.setdefault(i, []).append(j)
    for i, js in flagged.items():
        yield i, sorted(js)


_SPAN = "k1 long, k2 long, begin int, end int"


def repeated_spans(scan: DataFrame, docs: DataFrame, text_col: str, id_col: str, window: int,
                   bucket_rows: int, bucket_windows: int) -> tuple[DataFrame, DataFrame]:
    """(texts that may have repeats, spans of their words that also start in a text with a smaller identifier)."""
    spans = scan.select("k1", "k2", "doc_id", F.explode(F.arrays_zip("h", "start", "n")).alias("s")).select(
        "k1", "k2", "doc_id", "s.*")
    shared = spans.groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"),
                                    F.count(F.lit(1)).alias("rows"), F.sum("n").alias("windows")).filter("a <> b")
    wanted = spans.join(shared.select("h", ((F.col("rows") > bucket_rows) | (F.col("windows") > bucket_windows)).alias("hot")), "h").groupBy(
        "k1", "k2", "doc_id").agg(F.collect_list(F.struct("h", "start", "n", "hot")).alias("spans"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(*text_key(text), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc_id"),
                         text.cast("binary").alias("text"))
    suspects = written(source.join(wanted, ["k1", "k2", "doc_id"]), "suspects")
    schema = "k1 long, k2 long, doc_id long, h long, start int, packed binary"

    def pack(hot: bool):
        def run(batches):
            for batch in batches:
                cols, size = [[] for _ in range(6)], 0
                for k1, k2, owner, text, spans in zip(*(batch[c].to_pylist() for c in (
                        "k1", "k2", "doc_id", "text", "spans"))):
                    words = text.split()
                    for s in spans:
                        if s["hot"] == hot:
                            packed = b" ".join(words[s["start"]:s["start"] + s["n"] + window - 1])
                            for c, v in zip(cols, (k1, k2, owner, s["h"], s["start"], packed)):
                                c.append(v)
                            size += len(packed)
                    if size > BLOCK_BYTES:
                        yield _batch(cols)
                        cols, size = [[] for _ in range(6)], 0
                yield _batch(cols)
        return run

    def _batch(cols):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          ["k1", "k2", "doc_id", "h", "start", "packed"])

    def found(out):
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                          ["k1", "k2", "begin", "end"])

    def sort_buckets(batches):
        bucket, held, out = None, [], []

        def close():
            for i, js in sort_bucket([(r[2], r[4]) for r in held], window):
                out.extend((held[i][0], held[i][1], a, b) for a, b in _spans(held[i][3], js, window))

        for batch in batches:
            for h, *row in zip(*(batch[c].to_pylist() for c in ("h", "k1", "k2", "doc_id", "start", "packed"))):
                if h != bucket:
                    close()
                    bucket, held = h, []
                held.append(row)
            if out:
                yield found(out)
                out.clear()
        close()
        yield found(out)

    ordinary = suspects.mapInArrow(pack(False), schema).repartition("h").sortWithinPartitions("h").mapInArrow(
        sort_buckets, _SPAN)

    def unpack(batches):
        for batch in batches:
            for k1, k2, owner, start, packed in zip(*(batch[c].to_pylist() for c in (
                    "k1", "k2", "doc_id", "start", "packed"))):
                words = packed.split(b" ")
                n = len(words) - window + 1
                for at in range(0, n, SPREAD_WINDOWS):
                    digest = [hashlib.sha256(b" ".join(words[j:j + window])).digest()
                              for j in range(at, min(n, at + SPREAD_WINDOWS))]
                    m = len(digest)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k1] * m), pa.array([k2] * m), pa.array([owner] * m),
                         pa.array(range(start + at, start + at + m), pa.int32()), pa.array(digest, pa.binary())],
                        ["k1", "k2", "doc_id", "begin", "digest"])

    single = suspects.filter(F.exists("spans", lambda s: s["hot"])).mapInArrow(pack(True), schema).mapInArrow(
        unpack, "k1 long, k2 long, doc_id long, begin int, digest binary")
    # A window that very many texts hold is dealt to SALTS parts; a part learns the smallest identifier of all.
    single = single.withColumn("salt", F.pmod(F.xxhash64("k1", "begin"), F.lit(SALTS)))
    parts = single.groupBy("digest", "salt").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    first = parts.groupBy("digest").agg(F.min("least").alias("first"), F.max("most").alias("last")).filter("first < last")
    late = parts.join(first, "digest").filter("most > first").select("digest", "salt", "first")
    spread = single.join(late, ["digest", "salt"]).filter("doc_id > first").select(
        "k1", "k2", "begin", (F.col("begin") + window).alias("end"))
    return suspects, ordinary.unionByName(spread)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that meet or overlap as one."""
    out: list[tuple[int, int]] = []
    for begin, end in spans:
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def cut_words(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    """The words outside all spans."""
    drop = np.zeros(len(words) + 1, np.int64)
    for begin, end in spans:
        drop[begin] += 1
        drop[end] -= 1
    return [w for w, d in zip(words, np.cumsum(drop[:-1])) if not d]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, m: int = 8,
                    bucket_rows: int = 5000, bucket_windows: int = 50_000) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, spans, kept_sha256.

    A word goes if a window of ``window`` consecutive words that covers it also starts in a document with a smaller
    identifier; spans are the word ranges [begin, end) that go, apart from each other, kept_sha256 is that of the remaining words joined by one
    space.  Words are runs without ASCII white space.  Null and empty texts have no words, texts shorter than a window
    lose none.  A null identifier is later than any other; rows with the same identifier never remove from each other.
    Identifiers are whole numbers.  An empty table gives no rows.
    """
    if not 1 <= m <= window:
        raise ValueError("m is at least 1 and at most the window")
    scan = written(scan_rows(docs, id_col, text_col, window, m).withColumn(
        "doc_id", F.coalesce("doc_id", F.lit(LAST))), "scan")
    texts = scan.groupBy("k1", "k2").agg(F.min("doc_id").alias("first_id"))
    scan = written(scan.join(texts, ["k1", "k2"]), "scan-first")
    own = scan.filter("doc_id = first_id")
    suspects, spans = repeated_spans(own, docs, text_col, id_col, window, bucket_rows, bucket_windows)
    found = written(spans.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("gone")),
                    "spans")

    def cut(batches):
        for b in batches:
            gone = [merged([(s["begin"], s["end"]) for s in g.as_py()]) for g in b["gone"]]
            kept = [cut_words(t.as_py().split(), g) for t, g in zip(b["text"], gone)]
            gone = pa.array([[{"begin": begin, "end": end} for begin, end in g] for g in gone], b.schema.field("gone").type)
            yield pa.RecordBatch.from_arrays(
                [b["k1"], b["k2"], gone, pa.array([len(k) for k in kept], pa.int64()),
                 pa.array([_joined_sha(k) for k in kept])], ["k1", "k2", "gone", "n_kept", "kept_sha"])

    part = suspects.select("k1", "k2", "text").join(found, ["k1", "k2"]).mapInArrow(
        cut, "k1 long, k2 long, gone array<struct<begin:int,end:int>>, n_kept long, kept_sha string")
    part = written(part, "cut").dropDuplicates(["k1", "k2"])
    empty = F.array().cast("array<struct<begin:int,end:int>>")
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= window)
    first = F.col("doc_id") == F.col("first_id")
    every = F.array(F.struct(F.lit(0).alias("begin"), F.col("n_words").cast("int").alias("end")))
    return scan.select("k1", "k2", "doc_id", "n_words", "sha", "first_id").join(part, ["k1", "k2"], "left").select(
        F.nullif("doc_id", F.lit(LAST)).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).when(first & F.col("n_kept").isNotNull(), F.col("n_words") - F.col("n_kept"))
        .otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, every).when(first, F.coalesce("gone", empty)).otherwise(empty).alias("spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).when(first, F.coalesce("kept_sha", "sha"))
        .otherwise(F.col("sha")).alias("kept_sha256"))
