"""SimHash near-dedup by anchor-point covering.

Anchors are the codewords of a covering code: the perfect [23, 12] code of covering radius 3 over each of two blocks of
23 fingerprint bits, 2**24 anchors in all.  Each fingerprint lives at its nearest anchor, within radius 3 in each block.
A fingerprint ``t`` bits away lies within 3 + t_i of that anchor in block i, with the t_i summing to t at most; so it is
replicated to every anchor within covering radius plus threshold, and each pair meets at the home of one of the two.
Replicas go only to anchors where something lives, which a bitmap of 2 MB tells whatever the number of documents.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proplens.llm.common import text_key, written
from proplens.llm.components import connected

SEED = 42
BLOCK, MESSAGE, RADIUS = 23, 12, 3
#: Fixed value: generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the perfect code.
GENERATOR = 0b110001110101
BLOCK_MASK = (1 << BLOCK) - 1
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash: bit set where over half of the shingles' XXH64 have it; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    digests = np.frombuffer(b"".join([xxhash.xxh64_digest(b" ".join(r), SEED) for r in runs]), np.uint8).reshape(-1, 8)
    counts = np.bincount((digests + np.arange(0, 2048, 256)).ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    return int.from_bytes(np.packbits(counts.ravel() * 2 > len(digests)).tobytes())


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, extra: tuple = ()) -> DataFrame:
    """Adds fp, the fingerprint as a signed long, to identifier and extra columns."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *extra, F.col(text_col).alias("fp_text"))
    kept = [c for c in rows.columns if c != "fp_text"]

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b["fp_text"]], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.select(kept).columns, pa.array(fp)], [*kept, "fp"])

    schema = rows.drop("fp_text").schema.add("fp", "long")
    return rows.mapInArrow(run, schema)


@cache
def syndromes() -> np.ndarray:
    """Syndromes of all 23-bit words: doubled bit by bit, as that of a sum is the sum of theirs (16 MB)."""
    check = BLOCK - MESSAGE
    table, power = np.arange(1 << check, dtype=np.int16), GENERATOR ^ 1 << check
    for _ in range(MESSAGE):
        table = np.concatenate([table, table ^ np.int16(power)])
        power <<= 1
        power ^= GENERATOR if power >> check else 0
    return table


@cache
def code_tables(excess: int) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Syndromes of all 23-bit words; by syndrome, the (error pattern, excess) that lead to codewords within reach.

    A pattern's excess is its weight above the covering radius; patterns up to the radius are unique by syndrome.
    """
    syndrome = syndromes()
    ways: list[list[tuple[int, int]]] = [[] for _ in range(1 << (BLOCK - MESSAGE))]
    for weight in range(RADIUS + excess + 1):
        for bits in combinations(range(BLOCK), weight):
            pattern = sum(1 << b for b in bits)
            ways[syndrome[pattern]].append((pattern, max(0, weight - RADIUS)))
    return syndrome, ways


def anchor(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Number of the anchor: the message bits of both codewords (the code is systematic)."""
    return (first >> (BLOCK - MESSAGE)).astype(np.int64) << MESSAGE | (second >> (BLOCK - MESSAGE))


def _blocks(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (fp & BLOCK_MASK).astype(np.int32), (fp >> BLOCK & BLOCK_MASK).astype(np.int32)


@cache
def _patterns(excess: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ways of all syndromes as arrays: pattern, its excess, and where each syndrome's begin."""
    ways = code_tables(excess)[1]
    flat = [p for w in ways for p in w]
    return (np.array([p for p, _ in flat], np.int32), np.array([e for _, e in flat], np.int8),
            np.cumsum([0, *map(len, ways)]))


def forget_tables() -> None:
    """Drops the tables that a task has used: Spark uses its process for other tasks (a rebuild takes 0.1 s)."""
    for table in (syndromes, code_tables, _patterns):
        table.cache_clear()
    pa.default_memory_pool().release_unused()


def homes(fp: np.ndarray) -> np.ndarray:
    """The nearest anchor of each fingerprint."""
    syndrome, ways = code_tables(0)
    leader = np.array([w[0][0] for w in ways], np.int32)
    return anchor(*(x ^ leader[syndrome[x]] for x in _blocks(fp)))


def visits(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor) for every anchor within covering radius plus distance."""
    syndrome = code_tables(distance)[0]
    pattern, excess, begin = _patterns(distance)
    index, near, used = np.arange(len(fp)), [], np.zeros(len(fp), np.int8)
    for x in _blocks(fp):
        x = x[index]
        s = syndrome[x]
        n = begin[s + 1] - begin[s]
        src = np.repeat(np.arange(len(index)), n)
        way = np.arange(len(src)) - np.repeat(np.cumsum(n) - n, n) + begin[s][src]
        ok = used[src] + excess[way] <= distance
        src, way = src[ok], way[ok]
        near = [a[src] for a in near] + [x[src] ^ pattern[way]]
        index, used = index[src], used[src] + excess[way]
    return index, anchor(*near)


def links_within(prints: DataFrame, distance: int) -> DataFrame:
    """(a, b), a < b, for all distinct fingerprints ``fp`` that differ in at most ``distance`` bits."""
    spark = prints.sparkSession

    def home_rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["fp"], pa.array(homes(b["fp"].to_numpy()))], ["a", "anchor"])
        forget_tables()

    living = written(prints.select("fp").mapInArrow(home_rows, "a long, anchor long"), "homes")
    words = living.groupBy(F.shiftright("anchor", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(anchor & 63 as int))")).alias("bits")).toPandas()  # 2**18 rows at most
    bitmap = np.zeros(1 << (2 * MESSAGE - 6), np.int64)
    bitmap[words["word"]] = words["bits"]
    lived_in = spark.sparkContext.broadcast(bitmap)

    def visit_rows(batches):
        live = lived_in.value
        for b in batches:
            fp = b["fp"].to_numpy()
            for i in range(0, len(fp), 1024):  # some 500,000 ways at once
                part = fp[i:i + 1024]
                src, at = visits(part, distance)
                ok = live[at >> 6] >> (at & 63) & 1 == 1
                yield pa.RecordBatch.from_arrays([pa.array(part[src[ok]]), pa.array(at[ok])], ["b", "anchor"])
        forget_tables()

    visiting = prints.select("fp").mapInArrow(visit_rows, "b long, anchor long")
    return living.join(visiting, "anchor").filter(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)).select("a", "b")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2,
                   extra: tuple = ()) -> DataFrame:
    """One row per input row: doc_id, fp, fingerprint (hex), component, component_id, component_rows, extra columns.

    Fingerprints of ``distance`` bits or fewer apart are linked; component is the smallest fingerprint reachable, component_id is the smallest identifier among all rows
    reachable by links, nulls aside (null if there is no other).  Null and empty texts have fingerprint 0 and link like
    any other.  Equal fingerprints travel as one, whatever the number of copies.  An empty table gives no rows.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle, extra), "fingerprints")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "prints")
    parts = written(connected(links_within(prints, distance), "a", "b").withColumnRenamed("node", "fp"), "parts")
    member = prints.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("n").alias("component_rows"))
    names = written(member.join(least, "component").select("fp", "component", "component_id", "component_rows"), "names")
    return rows.join(names, "fp").withColumn("fingerprint", F.lpad(F.lower(F.hex("fp")), 16, "0"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                distance: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays for each group of ``simhash_groups``.

    The smallest identifier stays, nulls last; of rows with equal identifiers the one whose text has the smallest hash,
    and of rows that repeat whole, one.
    """
    key = text_key(F.col(text_col))
    groups = simhash_groups(docs, id_col, text_col, shingle, distance, tuple(key))
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "k1", "k2")
    best = written(groups.groupBy("component").agg(F.min(place).alias("best")).join(
        groups.withColumn("place", place).groupBy("component", "place").agg(F.count(F.lit(1)).alias("n")), "component"
    ).filter(F.col("best") == F.col("place")).select("best.*", "n"), "kept")
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).alias("row_id"), *key)
    # A null text's hash is that of no value, so keys compare as they are; a null identifier matches only itself.
    kept = row.join(best.select("doc_id", F.col("k1").alias("b1"), F.col("k2").alias("b2")),
                    (F.col("k1") == F.col("b1")) & (F.col("k2") == F.col("b2"))
                    & F.col("row_id").eqNullSafe(F.col("doc_id")), "left_semi")
    if not best.filter("n > 1").isEmpty():
        kept = kept.dropDuplicates(["row_id", "k1", "k2"])
    return kept.select("row.*")
