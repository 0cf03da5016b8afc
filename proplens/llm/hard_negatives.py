"""Hard negatives by inner product, with coordinate pruning over length buckets.

Rows are dealt by (label, length) into columns of a few thousand rows, written to the shared folder; anchors are dealt
by hash into groups.  A cell, one column met by one anchor group, is a bounded task that cuts its rows into length
buckets, longest first, each with its directions' coordinates as sorted lists.  An anchor that needs a score of at
least s compares only with directions within the angle that s leaves for the bucket's length.  That angle gives each of
the anchor's focus coordinates (its largest) a feasible range of values: a slice of the sorted list.  What lies in all
slices is verified by the exact product; a bucket too short for s ends the anchor's walk.  The score needed rises with
what the cell has found, so the pruning loses nothing: ties are kept, and ranges are widened against rounding.

Each cell gives its best rows per anchor; the final ranks are taken over the cells' few.  All anchors meet all columns
that can hold an answer: the stated query set against all rows, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proplens.llm.common import forget, written

#: Rows in a column, in a length bucket and anchors in a group: a cell holds the first and the last as 8-byte numbers.
COLUMN_ROWS, BUCKET_ROWS, GROUP_ANCHORS = 8192, 1024, 8192
#: Coordinates of an anchor whose ranges are intersected.
FOCUS = 6
#: What an anchor asks with: a positive's number, identifier and score, and the bounds of a negative's score.
BAND = ("slot", "positive_id", "positive_score", "low", "high")
#: Widens ranges and lowers thresholds against rounding of directions and lengths.
SLACK = 1e-7


def whole_vectors(rows: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
                  label_col: str = "label", label: Column | None = None) -> DataFrame:
    """vec_id, label, q (components ``floor(scale * x)``), length2; without rows that lack a part or a finite component.

    ``label`` replaces the label column's value.  Rows with a null identifier have no name to be found by and go too.
    """
    x = F.col(vector_col)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == math.inf))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    whole = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull()).filter(~odd)
    out = whole.select(F.col(id_col).cast("long").alias("vec_id"),
                       (F.col(label_col) if label is None else label).cast("long").alias("label"), q.alias("q"))
    length2 = F.aggregate("q", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    return out.withColumn("length2", length2)


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of whole numbers, shorter vectors filled with zeros; in doubles while every product is exact there."""
    lists = vectors.combine_chunks()
    flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    out = np.zeros((len(lists), width), np.int64)
    sizes = np.diff(ends)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - ends[row]] = flat
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> np.dtype:
    """The number type in which inner products of rows of ``a`` and ``b`` are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most >= 2.0 ** 63:
        raise ValueError("inner products of these vectors don't fit in 64 bits")
    return np.dtype(np.float64 if most < 2.0 ** 53 else np.int64)


class Bucket:
    """Rows of similar length, longest first, with sorted lists of their directions' coordinates."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.longest, self.shortest = float(lengths.max()), float(lengths.min())
        self.lowest, self.highest = labels.min(), labels.max()
        directions = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.order = np.argsort(directions, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(directions.T, self.order, axis=1)
        self.zeros = lengths == 0

    def feasible(self, direction: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray | None:
        """Rows whose focus coordinates allow a cosine of at least ``cosine`` with the direction; None: all of them."""
        if cosine <= -1.0:
            return None
        angle = math.acos(min(1.0, cosine))
        own = np.arccos(np.clip(direction[focus], -1.0, 1.0))
        low, high = np.cos(np.minimum(math.pi, own + angle)) - SLACK, np.cos(np.maximum(0.0, own - angle)) + SLACK
        slices = [(np.searchsorted(self.values[f], a, "left"), np.searchsorted(self.values[f], z, "right"), f)
                  for f, a, z in zip(focus, low, high)]
        slices = sorted((z - a, a, z, f) for a, z, f in slices if z - a < len(self.ids))
        if not slices:
            return None
        seen = np.zeros(len(self.ids), np.int8)
        for _, a, z, f in slices:
            seen[self.order[f, a:z]] += 1
        return np.flatnonzero(seen == len(slices))

    def above(self, query: np.ndarray, direction: np.ndarray, length: float, focus: np.ndarray, least: float,
              wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of at least ``least``, of the ``wanted`` rows; every one of them is among the feasible."""
        top = length * (self.longest if least > 0 else self.shortest)
        if math.isinf(least) or top == 0 or (least <= 0 and self.zeros.any()):
            rows = None
        else:
            rows = self.feasible(direction, focus, least / top - SLACK)
        if rows is None:
            scores, rows = self.vectors @ query, np.arange(len(self.ids))
        else:
            scores = self.vectors[rows] @ query
        keep = scores >= least
        if wanted is not None:
            keep &= wanted[rows]
        return rows[keep], scores[keep]


def _buckets(table: pa.Table, width: int, kind: np.dtype) -> list[Bucket]:
    ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
    vectors, lengths = _matrix(table["q"], width).astype(kind), np.sqrt(table["length2"].to_numpy())
    order = np.argsort(-lengths, kind="stable")
    return [Bucket(ids[o], labels[o], vectors[o], lengths[o])
            for o in (order[i:i + BUCKET_ROWS] for i in range(0, len(order), BUCKET_ROWS))]


def _best(ids: np.ndarray, scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``count`` by score, the smaller identifier first among equals."""
    order = np.lexsort((ids, -scores))[:count]
    return ids[order], scores[order]


def _walk(buckets: list[Bucket], query: np.ndarray, own: float, same: bool, bands: list[tuple[float, float]], count: int,
          self_id: int | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each band of scores the first ``count`` rows in it, of the anchor's label (``same``) or of the others."""
    length = math.sqrt(float((query.astype(np.float64) ** 2).sum()))
    direction = query / length if length else query.astype(np.float64)
    focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
    found = [(np.zeros(0, np.int64), np.zeros(0, query.dtype)) for _ in bands]
    need = [low for low, _ in bands]
    for b in buckets:  # longest first
        least = min(need)
        if same and not b.lowest <= own <= b.highest or not same and b.lowest == b.highest == own:
            continue
        if least > 0 and length * b.longest * (1 + SLACK) < least:
            break
        wanted = None
        if b.lowest != b.highest or same:
            wanted = (b.labels == own) == same
            if self_id is not None:
                wanted &= b.ids != self_id
        rows, scores = b.above(query, direction, length, focus, least, wanted)
        if not len(rows):
            continue
        for i, (low, high) in enumerate(bands):
            hit = (scores >= need[i]) & (scores <= high)
            if hit.any():
                ids, best = found[i]
                found[i] = _best(np.r_[ids, b.ids[rows[hit]]], np.r_[best, scores[hit]], count)
                if len(found[i][0]) == count:
                    need[i] = found[i][1][-1]
    return found


def _search(columns: DataFrame, asked: DataFrame, groups: int, same: bool, count: int) -> DataFrame:
    """The first rows of every (anchor, band) of ``asked``: anchor_id, slot, positive_id, positive_score, vec_id, score,
    rank.

    ``asked`` has a row for each anchor: vec_id, label, q, column (to meet) and bands (slot, the positive's number;
    positive_id, positive_score, low, high), whose bounds null leaves open.
    """

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            width = max(int(np.diff(t["q"].combine_chunks().offsets.to_numpy()).max(initial=0)) for t in (left, right))
            queries = _matrix(right["q"], width)
            kind = _exact(_matrix(left["q"], width), queries)
            buckets, queries = _buckets(left, width, kind), queries.astype(kind)
            for i, (anchor, own, bands) in enumerate(zip(*(right[c].to_pylist() for c in ("vec_id", "label", "bands")))):
                limits = [(-math.inf if b["low"] is None else b["low"], math.inf if b["high"] is None else b["high"])
                          for b in bands]
                for b, (ids, scores) in zip(bands, _walk(buckets, queries[i], own, same, limits, count,
                                                         anchor if same else None)):
                    out += [(anchor, b["slot"], b["positive_id"], b["positive_score"], int(v), int(s)) for v, s in zip(ids, scores)]
        return pa.Table.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*out) if out else [()] * 6)],
                                    ["anchor_id", "slot", "positive_id", "positive_score", "vec_id", "score"])

    # Every row meets every anchor group, every anchor the columns it names: both sides are dealt by the cell.
    rows = columns.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    key = ["column", "group"]
    found = rows.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(
        cell, "anchor_id long, slot long, positive_id long, positive_score long, vec_id long, score long")
    by = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= count)


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10,
                   band: Sequence[int] = (30, 90), column_rows: int = COLUMN_ROWS, group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """For each anchor and positive: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``rows`` is of the form that ``whole_vectors`` gives.  An anchor (``anchors``, a condition on ``rows``) has its
    ``positives`` best other rows of its label as positives; each one's negatives are the first rows of other labels with
    ``band[0] * positive_score <= 100 * score <= band[1] * positive_score``.  Equal scores: the smaller identifier first.
    Rows that repeat an identifier stand for themselves each, but never as their own anchor's positive; of anchors with one
    identifier that with the smallest label and vector asks.  A shorter vector counts as filled with zeros.  An anchor
    without positives, and a positive without rows in its band, gives no row; an empty table gives an empty one.
    Products beyond 64 bits raise.
    """
    spark = rows.sparkSession
    rows = rows.select("vec_id", "label", "q", "length2")
    n = rows.count()
    count = max(1, math.ceil(n / column_rows))
    spread = F.xxhash64("vec_id", F.monotonically_increasing_id())  # equal rows too lie in several columns
    dealt = rows.withColumn("spread", spread).repartitionByRange(count, "label", F.desc("length2"), "spread").drop("spread")
    columns = written(dealt.withColumn("column", F.spark_partition_id()), "columns")
    asks = written(columns.filter(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("a")).select(
        "vec_id", "a.label", "a.q"), "anchors")
    groups = max(1, math.ceil(asks.count() / group_anchors))
    held = written(columns.groupBy("column", "label").count().drop("count"), "held")
    last = held.agg(F.max("column")).first()[0] or 0

    open_band = F.array(F.struct(*[F.lit(None).cast("long").alias(c) for c in BAND]))
    best = written(_search(columns, asks.join(held, "label").withColumn("bands", open_band), groups, True, positives).select(
        "anchor_id", F.col("rank").cast("long").alias("slot"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    # The band in whole scores.  A negative positive score has no room between its bounds.
    low, high = F.expr(f"({band[0]} * positive_score + 99) div 100"), F.expr(f"{band[1]} * positive_score div 100")
    bands = best.filter("positive_score >= 0").select(
        "anchor_id", F.struct("slot", "positive_id", "positive_score", low.alias("low"), high.alias("high")).alias("b"))
    bands = bands.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list("b").alias("bands"))  # positives at most
    met = asks.join(bands, "vec_id")
    # Columns that hold the anchor's label alone have no negative.
    labels = held.groupBy("column").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    alone = labels.filter("least = most").groupBy("least").agg(F.collect_set("column").alias("own"))
    met = met.join(alone, met["label"] == alone["least"], "left").withColumn("column", F.explode(F.array_except(
        F.sequence(F.lit(0), F.lit(last)), F.coalesce("own", F.array().cast("array<int>"))))).drop("least", "own")
    out = written(_search(columns, met, groups, False, negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score")), "negatives")
    for used in (columns, asks, held, best):
        forget(used)
    return out
