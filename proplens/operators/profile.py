"""Descriptive statistics: describe, histograms, correlations, column profiles.

Rows are read once per profile (twice where quantiles are asked for).  The driver
gets at most a matrix of the columns, never rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DoubleType, FloatType, MapType, StructType

from proplens.functions.names import col
from proplens.functions.scalar import known
from proplens.operators.joins import join_group_stats
from proplens.operators.quantiles import exact_quantiles


def _stack(df: DataFrame, columns: Sequence[str], name: str = "column_name", value: str = "value") -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(name), known(col(c)).alias(value)) for c in columns])).alias("_s")
    ).select(f"_s.{name}", f"_s.{value}")


def describe(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per column (long form)."""
    long = _stack(df, columns)
    basic = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"], ["column_name"])
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column_name")).cast("int")
    j = basic.join(q, "column_name", "left")
    r = lambda c: F.round(col(c), digits).alias(c)
    return j.select("column_name", order.alias("ordinal"), "count", r("mean"), r("std"), r("min"),
                    r("q25"), r("q50"), r("q75"), r("max"))


def histogram(df: DataFrame, column: str, bins: int = 50, group_cols: Sequence[str] = (),
              digits: int = 4) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; zero-count bins kept.

    A constant column gives one bin.  Without groups the range is fitted
    eagerly (two numbers, inlined as literals); with groups the min/max table
    (one row per group) is joined back with a size-checked broadcast.
    """
    groups = list(group_cols)
    v = known(F.col(column))
    data = df.select(*groups, v.alias("_x")).where(F.col("_x").isNotNull())
    rng = data.groupBy(*groups).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    if not groups:
        r = rng.first()
        if r is None or r["_lo"] is None:
            return df.sparkSession.createDataFrame(
                [], "bin int, bin_start double, bin_end double, count long")
        rng = df.sparkSession.createDataFrame([(float(r["_lo"]), float(r["_hi"]))], "_lo double, _hi double")
        j = data.select("_x", F.lit(r["_lo"]).cast("double").alias("_lo"), F.lit(r["_hi"]).cast("double").alias("_hi"))
    else:
        j = join_group_stats(data, rng, groups)
    raw = F.floor((F.col("_x") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo")))
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    counts = j.groupBy(*groups, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    nb = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(F.lit(bins - 1))
    frame = rng.select(*groups, "_lo", "_hi", F.explode(F.sequence(F.lit(0), nb)).alias("bin"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    # Both sides have at most (groups x bins) rows.
    out = frame.join(counts, [*groups, "bin"], "left")
    return out.select(*groups, "bin",
                      F.round(F.col("_lo") + F.col("bin") * w, digits).alias("bin_start"),
                      F.round(F.when(F.col("_hi") == F.col("_lo"), F.col("_hi"))
                               .otherwise(F.col("_lo") + (F.col("bin") + 1) * w), digits).alias("bin_end"),
                      F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


#: A spread below this share of the squared distance from the column's reference value is rounding: constant.
CONSTANT = 1e-12
#: Rows that are looked at for a reference value near each column's values.
HEAD_ROWS = 1000


def _pair_stats(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pairwise-complete correlation per (a, b) pair; a constant column gives NULL (never an error).

    One scan for any number of columns: each row becomes a vector of its values (less a reference value, missing ones 0),
    their squares, which are present and which infinite, and the Gram matrix of these vectors, summed as a tree over the
    partitions, holds every pair's sums.  The driver gets that matrix, four rows a column, whatever the number of rows.
    An infinite value makes NaN of the pairs that it takes part in.
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    k = len(names)
    values = df.select(*[known(col(c)).alias(f"_{i}") for i, c in enumerate(names)])
    finite = [F.when(F.abs(F.col(f"_{i}")) != float("inf"), F.col(f"_{i}")) for i in range(k)]
    head = values.limit(HEAD_ROWS).agg(*[F.first(v, ignorenulls=True) for v in finite], F.count(F.lit(1))).first()
    near = [F.coalesce(v - F.lit(h or 0.0), F.lit(0.0)) for v, h in zip(finite, head)]
    there = [F.col(f"_{i}").isNotNull().cast("double") for i in range(k)]
    endless = [F.coalesce((F.abs(F.col(f"_{i}")) == float("inf")).cast("double"), F.lit(0.0)) for i in range(k)]
    rows = values.select(array_to_vector(F.array(*near, *[x * x for x in near], *there, *endless)).alias("v"))
    rows = MLUtils.convertVectorColumnsFromML(rows, "v")
    gram = np.zeros((4 * k, 4 * k)) if not head[k] else RowMatrix(rows, numCols=4 * k).computeGramianMatrix().toArray()
    at = {c: i for i, c in enumerate(names)}
    out = []
    for a, b in pairs:
        i, j = at[a], at[b]
        n, sx, sy = gram[2 * k + i, 2 * k + j], gram[i, 2 * k + j], gram[j, 2 * k + i]
        xx, yy = gram[k + i, 2 * k + j], gram[k + j, 2 * k + i]
        r = None
        if gram[3 * k + i, 2 * k + j] or gram[3 * k + j, 2 * k + i]:
            r = float("nan")
        elif n:
            vx, vy = xx - sx * sx / n, yy - sy * sy / n
            if vx > CONSTANT * xx and vy > CONSTANT * yy:
                r = float((gram[i, j] - sx * sy / n) / (math.sqrt(vx) * math.sqrt(vy)))
        out.append((a, b, r))
    return df.sparkSession.createDataFrame(out, "column_a string, column_b string, correlation double")


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every ordered pair (upper triangle computed, then mirrored)."""
    cols = list(columns)
    upper = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    tri = _pair_stats(df, upper)
    mirror = tri.where(F.col("column_a") != F.col("column_b")).select(
        F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "correlation")
    return tri.unionByName(mirror).withColumn("correlation", F.round("correlation", digits))


def target_correlation(df: DataFrame, target: str, columns: Sequence[str], k: int = 20,
                       digits: int = 6) -> DataFrame:
    """Correlation of each column with the target, descending (NULL last), top k."""
    cols = [c for c in columns if c != target]
    long = _pair_stats(df, [(c, target) for c in cols]).select(
        F.col("column_a").alias("Feature"), F.col("correlation").alias("Correlation"))
    return long.withColumn("Correlation", F.round("Correlation", digits)) \
               .orderBy(F.desc_nulls_last("Correlation"), "Feature").limit(k)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """(column_name, ordinal, data_type, missing_count, distinct_count).

    One scan: every row gives its (column, value) pairs, which each partition makes distinct and counts before they are
    shuffled by pair; a column's distinct values are then a count of pairs, so that no task holds a column.  NaN is one
    value, as are both zeros.  With ``approx`` sketches take the place of the pairs.
    """
    cols = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}

    if approx:
        agg = df.agg(*[F.count_if(col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)],
                     *[F.approx_count_distinct(col(c)).alias(f"_d{i}") for i, c in enumerate(cols)])
        return agg.select(F.explode(F.array(*[F.struct(
            F.lit(c).alias("column_name"), F.lit(i + 1).alias("ordinal"), F.lit(types[c].simpleString()).alias("data_type"),
            F.col(f"_m{i}").alias("missing_count"), F.col(f"_d{i}").alias("distinct_count"))
            for i, c in enumerate(cols)])).alias("_s")).select("_s.*")
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _as_text(col(c), types[c]).alias("x"))
                                          for i, c in enumerate(cols)])).alias("_s")).select("_s.*")
    counts = pairs.groupBy("i", "x").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy("i").agg(F.sum(F.when(F.col("x").isNull(), F.col("n"))).alias("m"), F.count("x").alias("d"))
    # One row per column on both sides.
    every = df.sparkSession.createDataFrame([(i, c, i + 1, types[c].simpleString()) for i, c in enumerate(cols)],
                                            "i int, column_name string, ordinal int, data_type string")
    return every.join(counts, "i", "left").select("column_name", "ordinal", "data_type", *[
        F.coalesce(x, F.lit(0)).cast("long").alias(a) for x, a in (("m", "missing_count"), ("d", "distinct_count"))])


def _as_text(c: Column, kind: DataType) -> Column:
    """A text that two values of a type share only if they are equal."""
    if isinstance(kind, (FloatType, DoubleType)):
        return F.when(c == 0, F.lit("0")).otherwise(c.cast("string"))
    if isinstance(kind, BinaryType):
        return F.hex(c)
    if isinstance(kind, (ArrayType, StructType, MapType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c.alias("x"))))
    return c.cast("string")


def category_counts(df: DataFrame, dimension: DataFrame, key: str, order_col: str,
                    count_col: str = "ObservationCount") -> DataFrame:
    """Counts per label of a dimension table, zero-count labels kept, in label order."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    # The dimension is a small fixed table; the counts side has one row per label.
    return dimension.join(counts, key, "left").select(
        key, order_col, F.coalesce(F.col(count_col), F.lit(0)).cast("long").alias(count_col))


def prediction_range(df: DataFrame, actual: str, predicted: str, group_cols: Sequence[str] = (),
                     digits: int = 4) -> DataFrame:
    return df.groupBy(*group_cols).agg(
        F.round(F.least(F.min(actual), F.min(predicted)), digits).alias("range_min"),
        F.round(F.greatest(F.max(actual), F.max(predicted)), digits).alias("range_max"))


def scatter_grid(df: DataFrame, x: str, y: str, bins: int = 20, group_cols: Sequence[str] = ()) -> DataFrame:
    """2-D binned point counts over the joint [min, max] of x and y (non-empty cells)."""
    groups = list(group_cols)
    rng = df.groupBy(*groups).agg(F.least(F.min(x), F.min(y)).alias("_lo"),
                                  F.greatest(F.max(x), F.max(y)).alias("_hi"))
    j = join_group_stats(df, rng, groups)

    def b(c):
        raw = F.floor((col(c) - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo")))
        return F.when(F.col("_hi") == F.col("_lo"), 0).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")

    return j.where(col(x).isNotNull() & F.col(y).isNotNull()) \
            .groupBy(*groups, b(x).alias("x_bin"), b(y).alias("y_bin")) \
            .agg(F.count(F.lit(1)).alias("count"))


def row_counts(spark: SparkSession, stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, stage_order, rows, columns) for named DataFrames, as one union plan."""
    parts = [d.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("stage"), F.lit(i + 1).alias("stage_order"), "rows",
        F.lit(len(d.columns)).alias("columns")) for i, (name, d) in enumerate(stages)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
