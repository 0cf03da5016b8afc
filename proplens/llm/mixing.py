"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Every document gets a fixed point on a 60-bit hash line.  Per source, tokens are summed by hash bucket; the running sum
shows the bucket in which the budget ends, and only that bucket is split into finer ones, until it holds one point.
Documents below the threshold are taken; nothing is sorted.  Budgets are nested: what a smaller one takes, a larger one
takes too, and a source whose target exceeds its size is repeated whole before the threshold applies to the next round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proplens.llm.common import SPACES, forget, words_between, written

HASH_BITS = 60


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """Adds weight and target to (source, source_size): ``share`` of all sizes dealt by weight, no target above ``cap``
    times its source, the excess reshared by weight.

    Resharing ends at one common rate r with target = min(cap * size, r * weight).  With sources in the order in which
    they reach their cap, running sums give the r that fits if those before are capped; the targets' sum is concave in
    r, so the largest of these is the one.  One row per source, ties by name.
    """
    every, byname = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
    full = Window.orderBy("fills", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(byname) - 1, F.lit(len(weights))) + 1))
    t = (sizes.withColumn("weight", w.cast("long"))
         .withColumn("fills", cap * F.col("source_size") / F.col("weight"))
         .withColumn("used", F.coalesce(F.sum("source_size").over(full), F.lit(0)) * cap)
         .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(full), F.lit(0)))
         .withColumn("rate", (share * F.sum("source_size").over(every) - F.col("used")) / F.col("open"))
         .withColumn("rate", F.max("rate").over(every)))
    return t.select("source", "source_size", "weight", F.least(
        cap * F.col("source_size"), F.col("rate") * F.col("weight")).alias("target"))


def hash_point(id_col: str, text_col: str):
    """A place on the hash line from identifier and text: md5's first 60 bits."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("/"),
                   F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def thresholds(rows: DataFrame, budgets: DataFrame, bits: int = 12) -> DataFrame:
    """Per source the hash value below which its documents sum to the budget, as near as whole documents allow.

    rows: source, size, point.  budgets: source, budget.  Each level sums tokens by the next ``bits`` bits of the point,
    for rows of the boundary bucket alone, and picks the bucket in which the running sum passes what is left.  A level
    of n rows leaves about n / 2**bits a source; it ends when no boundary bucket holds two different points.
    """
    # lo: first point of the boundary bucket; left: budget not yet used below it.
    state = budgets.select("source", F.col("budget").cast("double").alias("left"), F.lit(0).cast("long").alias("lo"),
                           (F.col("budget") > 0).alias("open"))
    shift, old = HASH_BITS, None
    while True:
        width = shift
        shift = max(0, shift - bits)
        here = rows.alias("d").join(
            state.filter("open").alias("s"),
            F.col("d.source").eqNullSafe(F.col("s.source"))
            & (F.shiftright("d.point", width) == F.shiftright("s.lo", width)))
        buckets = here.groupBy("s.source", F.shiftleft(F.shiftright("d.point", shift), shift).alias("bucket")).agg(
            F.sum("d.size").alias("tokens"), F.min("d.point").alias("first"), F.max("d.point").alias("last"))
        upto = Window.partitionBy("source").orderBy("bucket")
        buckets = buckets.withColumn("below", F.sum("tokens").over(upto) - F.col("tokens"))
        # The boundary bucket is the last one that begins within the budget.
        hit = buckets.join(state.select(F.col("source").alias("s_source"), "left"),
                           F.col("source").eqNullSafe(F.col("s_source"))).filter("below <= left")
        hit = hit.groupBy("source").agg(F.max(F.struct("bucket", "below", "tokens", "first", "last")).alias("b"))
        nxt = state.alias("s").join(hit.alias("h"), F.col("s.source").eqNullSafe(F.col("h.source")), "left")
        single = F.col("b.first") == F.col("b.last")
        rest = F.col("left") - F.col("b.below")
        # One point left: it is taken if that ends nearer to the budget.
        edge = F.when(F.col("b.tokens") - rest < rest, F.col("b.last") + 1).otherwise(F.col("b.first"))
        nxt = nxt.select(
            "s.source", F.when(F.col("b").isNull() | single, F.col("left")).otherwise(rest).alias("left"),
            F.when(F.col("b").isNull(), F.col("lo")).when(single, edge).otherwise(F.col("b.bucket")).alias("lo"),
            (F.col("open") & F.col("b").isNotNull() & ~single).alias("open"))
        state = written(nxt, "thresholds")
        if old is not None:
            forget(old)
        old = state
        if not shift or state.filter("open").isEmpty():
            return state.select("source", F.col("lo").alias("threshold"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, bits: int = 12,
                extra: tuple = ()) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken (= copies * size).

    Size counts the white-space words of the text; null and empty texts have 0 and are taken as often as their place on
    the hash line says, at no cost.  A null source is a source of its own, the last.  The result depends on identifiers
    and texts alone, so reruns agree; rows that repeat with identifier and text share one point and are taken together.
    ``extra`` columns are carried along.  An empty table gives no rows.
    """
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.size(words_between(F.col(text_col), SPACES)).cast("long").alias("size"),
        hash_point(id_col, text_col).alias("point"), *extra), "sizes")
    targets = written(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")),
                                     weights, share, cap), "targets")
    whole = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size")))
    plan = targets.select("source", "source_size", "target", whole.cast("long").alias("whole"))
    plan = plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    edges = thresholds(rows, plan, bits).withColumnRenamed("source", "edge_source")
    plan = plan.join(edges, F.col("source").eqNullSafe(F.col("edge_source"))).withColumnRenamed("source", "plan_source")
    # Written, so that Spark sees its real size: a few sources are broadcast and the documents stay where they are.
    plan = written(plan, "plan")
    copies = F.col("whole") + F.when((F.col("point") < F.col("threshold")) & (F.col("budget") > 0), 1).otherwise(0)
    return rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).select(
        *[c for c in rows.columns if c != "point"], "source_size", "target", copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"))
