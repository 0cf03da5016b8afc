"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a 64-bit ring; a key belongs to the next point clockwise.  A shard takes keys up to
its capacity; the rest of an arc's keys go on clockwise to the next point whose shard has room.  Rows are counted per
arc, the overflow is settled on those counts alone (ring-sized, whatever the rows), and each row then finds its shard
from its place within its arc.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proplens.llm.common import written

#: Rows that a copy count is expanded into at a time.
CHUNK = 50_000


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions (signed 64-bit) of all virtual nodes, and the shard of each.

    A shard's points depend on its own number alone, so one more shard leaves the others' where they are.
    """
    owner = np.repeat(np.arange(shards), vnodes)
    at = np.array([xxhash.xxh64_intdigest(f"shard {s} node {v}") for s in range(shards) for v in range(vnodes)],
                  dtype=np.uint64).view(np.int64)
    order = np.lexsort((owner, at))
    return at[order], owner[order]


def capacities(rows: int, shards: int, load: float | None) -> np.ndarray:
    """Rows that each shard may hold: ``ceil(load * rows / shards)``, or with no load factor exactly its equal part."""
    if load is None:
        return rows // shards + (np.arange(shards) < rows % shards)
    return np.full(shards, int(np.ceil(load * rows / shards)))


def settle(counts: np.ndarray, owner: np.ndarray, room: np.ndarray) -> pd.DataFrame:
    """Which run of an arc's rows goes where: arc, first (rank in the arc), shard, slot (of the run's first row), n.

    In each round every arc offers what it has left to the point so many steps clockwise; points are served in ring
    order while their shard has room.  A round costs the ring's length; rounds end when no row is left.
    """
    n, left, first = len(counts), counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64)
    used, runs, hop = np.zeros(len(room), np.int64), [], 0
    while left.any():
        if hop >= n:
            raise ValueError("the shards have less room than there are rows")
        arcs = np.flatnonzero(left)
        shard = owner[(arcs + hop) % n]
        order = np.lexsort((arcs, shard))
        arcs, shard = arcs[order], shard[order]
        ends = np.cumsum(left[arcs])
        starts_group = np.r_[True, shard[1:] != shard[:-1]]
        base = np.repeat((ends - left[arcs])[starts_group], np.diff(np.r_[np.flatnonzero(starts_group), len(arcs)]))
        before = ends - left[arcs] - base + used[shard]
        taken = np.clip(room[shard] - before, 0, left[arcs])
        some = taken > 0
        runs.append(np.column_stack([arcs, first[arcs], shard, before, taken])[some])
        np.add.at(used, shard, taken)
        first[arcs] += taken
        left[arcs] -= taken
        hop += 1
    out = np.concatenate(runs) if runs else np.zeros((0, 5), np.int64)
    return pd.DataFrame(out, columns=["arc", "first", "shard", "slot", "n"]).sort_values(["arc", "first"])


def shard_rows(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", vnodes: int = 256,
               load: float | None = None) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot.

    Size is the text's UTF-8 bytes plus 16; null counts as no bytes (size 16, crc 0).  Without ``load`` every shard is
    filled to its equal part, so counts are at most one apart; with a factor above 1 a shard may hold that many times
    the mean and fewer keys leave their home.  Slots of a shard run from 0 without gaps.  A row's place follows from
    identifier, size and crc, a null identifier being a key like any other; equal rows share a place on the ring, are
    counted there as one row with a number, and are laid out one by one, over several shards if need be.  An empty table
    gives no rows.
    """
    if shards < 1 or vnodes < 1 or (load is not None and load < 1):
        raise ValueError("shards and vnodes are at least 1, load is None or at least 1")
    at, owner = ring(shards, vnodes)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                      F.crc32(text).alias("text_crc32"))
    key = key.groupBy(*key.columns).agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "point", F.xxhash64("doc_id", "size", "text_crc32"))

    @F.pandas_udf("int")
    def arc_of(point: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(at, point.to_numpy()) % len(at)).astype(np.int32))

    key = written(key.withColumn("arc", arc_of("point")), "keys")
    counted = key.groupBy("arc").agg(F.sum("copies").alias("n")).toPandas()  # a row per virtual node at most
    counts = np.zeros(len(at), np.int64)
    counts[counted["arc"]] = counted["n"]
    runs = settle(counts, owner, capacities(int(counts.sum()), shards, load))
    run_arc, run_first, run_shard, run_slot = (runs[c].to_numpy() for c in ("arc", "first", "shard", "slot"))

    place = Window.partitionBy("arc").orderBy("point", "doc_id", "size", "text_crc32")
    ranked = key.withColumn("rank", F.sum("copies").over(place.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies"))

    def lay_out(batches):
        span = int(counts.max(initial=0)) + 1
        starts = run_arc * span + run_first  # arcs ascend, and ranks within each
        for b in batches:
            copies, rank, arc = (b[c].to_numpy() for c in ("copies", "rank", "arc"))
            ends = np.cumsum(copies)
            for a in range(0, int(ends[-1]) if len(ends) else 0, CHUNK):
                row = np.arange(a, min(a + CHUNK, int(ends[-1])))
                src = np.searchsorted(ends, row, side="right")
                at_rank = rank[src] + row - (ends[src] - copies[src])
                run = np.searchsorted(starts, arc[src].astype(np.int64) * span + at_rank, side="right") - 1
                same = b.select(["doc_id", "size", "text_crc32"]).take(pa.array(src))
                yield pa.RecordBatch.from_arrays(
                    [*same.columns, pa.array(run_shard[run].astype(np.int32)),
                     pa.array(run_slot[run] + at_rank - run_first[run])],
                    ["doc_id", "size", "text_crc32", "shard", "slot"])

    kind = dict(docs.dtypes)[id_col]
    # Copies of one row are laid out in pieces, so that a row with many fills no single task.
    pieces = ranked.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK))))
    pieces = pieces.select("doc_id", "size", "text_crc32", "arc", (F.col("rank") + F.col("piece") * CHUNK).alias("rank"),
                           F.least(F.lit(CHUNK), F.col("copies") - F.col("piece") * CHUNK).cast("long").alias("copies"))
    return pieces.mapInArrow(lay_out, f"doc_id {kind}, size long, text_crc32 long, shard int, slot long")
