"""Exact quantiles in two scans, by one method at every size.

1. A mergeable sketch per group (``approx_percentile``) brackets every wanted quantile: two values between which it lies,
   a few ten-thousandths of the group's rows apart.
2. One counting pass.  A row inside a bracket counts for its value, any other for the zone between two brackets, so that
   after map-side combining only the values inside the brackets are shuffled, each once.

Running sums over these counts (``ranged.running_sum``: no task holds a group) give the value at each rank.  The counts
prove the brackets: a rank that falls into a zone has no value, and then the whole is counted again without brackets.

The result is numpy's and pandas' linear interpolation (``v[floor(pos)] + (v[ceil(pos)] - v[floor(pos)]) * frac``,
pos = p(n-1)).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proplens.functions.names import col
from proplens.functions.scalar import known
from proplens.operators.joins import join_group_stats, join_null_safe, written
from proplens.operators.ranged import running_sum

#: Rank error of the sketch: a group's rows divided by this.  A group of no more rows is counted value by value.
ACCURACY = 10_000
#: Rank errors between a wanted rank and the ranks asked of the sketch: one is its own, the others cover the rounding.
MARGIN = 3
_MANTISSA = float(2 ** 52)


def order_key(value: Column) -> Column:
    """A long that orders as the double does: 0 for both zeros, infinities outermost, NaN above all."""
    x = F.abs(value)
    near = F.floor(F.log2(x)).cast("double")  # may be off by one beside a power of two
    e = F.when(F.pow(F.lit(2.0), near) > x, near - 1).when(F.pow(F.lit(2.0), near + 1) <= x, near + 1).otherwise(near)
    e = F.greatest(e, F.lit(-1022.0))  # below the normal numbers the mantissa alone counts
    bits = (e + 1022).cast("long") * F.lit(2 ** 52) + (x / F.pow(F.lit(2.0), e) * _MANTISSA).cast("long")
    top = 2047 * 2 ** 52
    size = F.when(F.isnan(value), F.lit(top + 1)).when(x == float("inf"), F.lit(top)).when(x == 0, F.lit(0)) \
            .otherwise(bits)
    return F.when(value < 0, -size).otherwise(size)


def _brackets(base: DataFrame, groups: Sequence[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """One row per group: arrays of the lower and upper ends, one of each per probability."""
    def at(shift: float) -> Column:
        return F.percentile_approx("_v", [min(1.0, max(0.0, float(p) + shift)) for p in probs], accuracy)

    def unless_small(ends: str, bound: float) -> Column:
        return F.when(F.col("_rows") > accuracy, F.col(ends)).otherwise(
            F.array(*[F.lit(bound) for _ in probs])).alias(ends)

    ends = base.groupBy(*groups).agg(F.count(F.lit(1)).alias("_rows"), at(-MARGIN / accuracy).alias("_lo"),
                                     at(MARGIN / accuracy).alias("_hi"))
    return ends.select(*groups, unless_small("_lo", float("-inf")), unless_small("_hi", float("inf")))


def _counted(base: DataFrame, groups: Sequence[str], probs: Sequence[float], brackets: DataFrame | None) -> DataFrame:
    """(groups, zone, value or null, rows): values inside a bracket one by one, all others by zone.

    The zone is twice the number of brackets that end below the value, plus one inside a bracket; it never falls as the
    values rise, also where brackets overlap.
    """
    value, zone = F.col("_v"), F.lit(0)
    if brackets is not None:
        base = join_group_stats(base, brackets, groups)
        ends = [(F.col("_lo")[i], F.col("_hi")[i]) for i in range(len(probs))]
        inside = reduce(lambda a, b: a | b, [(F.col("_v") >= lo) & (F.col("_v") <= hi) for lo, hi in ends])
        passed = reduce(lambda a, b: a + b, [(F.col("_v") > hi).cast("int") for _, hi in ends])
        value, zone = F.when(inside, F.col("_v")), passed * 2 + inside.cast("int")
    return base.select(*groups, zone.alias("_z"), value.alias("_x")).groupBy(*groups, "_z", "_x").agg(
        F.count(F.lit(1)).alias("_c"))


def _picked(counts: DataFrame, groups: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row per group: the values at the ranks below (``_lo``) and above (``_hi``) each position, and its fraction."""
    summed = running_sum(counts, [*groups, "_z", "_x"], "_c", "quantile_counts")
    begin, n = (F.col("_cum") - F.col("_c")), F.col("_n")
    size = written(summed.groupBy(*groups).agg(F.min(begin).alias("_first"), F.sum("_c").alias("_n")), "quantile_sizes")
    rows = join_null_safe(summed, size, groups) if groups else join_group_stats(summed, size, [])
    aggs = []
    for i, p in enumerate(probs):
        pos = (n - 1).cast("double") * F.lit(float(p))
        for name, k in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            rank = F.col("_first") + k
            aggs.append(F.max(F.when((begin <= rank) & (rank < F.col("_cum")), F.col("_x"))).alias(f"_{name}{i}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_f{i}"))
    return written(rows.groupBy(*groups).agg(*aggs), "quantiles")


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], names: Sequence[str] | None = None,
                    group_cols: Sequence[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value_col`` (NULLs and NaN skipped).

    One row per group that has at least one non-null value (a null group is a group; without groups one row
    always), with one double column per probability.  ``df`` is read twice and must give the same rows both times.
    """
    groups = list(group_cols)
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    g = [f"_g{i}" for i in range(len(groups))]
    base = df.select(*[col(c).alias(a) for c, a in zip(groups, g)], known(col(value_col)).cast("double").alias("_v")) \
             .where(F.col("_v").isNotNull())
    found = _picked(_counted(base, g, probs, _brackets(base, g, probs, accuracy)), g, probs)
    if found.where(reduce(lambda a, b: a | b, [F.col(f"_f{i}").isNotNull() & (
            F.col(f"_lo{i}").isNull() | F.col(f"_hi{i}").isNull()) for i in range(len(probs))])).count():
        found = _picked(_counted(base, g, probs, None), g, probs)

    cols = []
    for i, name in enumerate(names):
        lo, hi, f = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_f{i}")
        cols.append(F.when(f == 0, lo).otherwise(lo + (hi - lo) * f).alias(name))
    return found.select(*[F.col(a).alias(c) for c, a in zip(groups, g)], *cols)


def column_quantile(df: DataFrame, columns: Sequence[str], prob: float, accuracy: int = ACCURACY) -> list[float | None]:
    """One exact quantile of each column, ``exact_quantiles``' of the stacked columns, without a row for every value.

    Sketches bracket the rank in one scan, a second counts rows below and inside the brackets.  A bracket of one value is
    that value; of the others only the rows inside become rows (a few ten-thousandths), counted by value.
    """
    spark, at = df.sparkSession, range(len(columns))
    base = df.select(*[known(col(c)).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
    probs = [min(1.0, max(0.0, float(prob) + shift / accuracy)) for shift in (-MARGIN, MARGIN)]
    ends = base.agg(*[F.count(f"_v{i}").alias(f"_n{i}") for i in at],
                    *[F.percentile_approx(f"_v{i}", probs, accuracy).alias(f"_e{i}") for i in at]).first()
    n = [ends[f"_n{i}"] for i in at]
    lo, hi = zip(*[ends[f"_e{i}"] if n[i] > accuracy else (float("-inf"), float("inf")) for i in at])
    value = [F.col(f"_v{i}") for i in at]
    inside = [(value[i] >= lo[i]) & (value[i] <= hi[i]) for i in at]
    seen = base.agg(*[F.count_if(value[i] < lo[i]).alias(f"_b{i}") for i in at], *[F.count_if(inside[i]).alias(f"_i{i}") for i in at]).first()
    out: list[float | None] = [None] * len(columns)
    open_at, zones = [], []
    for i in (i for i in at if n[i]):
        below, within, pos = seen[f"_b{i}"], seen[f"_i{i}"], (n[i] - 1) * float(prob)
        if lo[i] == hi[i] and below <= int(pos) and pos <= below + within - 1:
            out[i] = lo[i]
        else:
            open_at.append(i)
            zones += [(str(i), z, None, c) for z, c in ((0, below), (2, n[i] - below - within)) if c]
    if not open_at:
        return out
    rows = F.explode(F.array_compact(F.array(*[F.when(inside[i], F.struct(F.lit(str(i)).alias("_g0"), F.lit(1).alias("_z"),
                                                                          value[i].alias("_x"))) for i in open_at])))
    counts = base.select(rows.alias("_r")).select("_r.*").groupBy("_g0", "_z", "_x").agg(F.count(F.lit(1)).alias("_c"))
    counts = counts.unionByName(spark.createDataFrame(zones, "_g0 string, _z int, _x double, _c long"))
    for r in _picked(counts, ["_g0"], [prob]).collect():  # a row for each column
        i, low, high = int(r["_g0"]), r["_lo0"], r["_hi0"]
        if low is None or high is None:  # a rank outside its bracket
            out[i] = exact_quantiles(df, columns[i], [prob], ["q"], accuracy=accuracy).first()["q"]
        else:
            out[i] = low if r["_f0"] == 0 else low + (high - low) * r["_f0"]
    return out


def exact_median(df: DataFrame, value_col: str, group_cols: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value_col, [0.5], [name], group_cols)
