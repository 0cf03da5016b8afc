"""Sorting, top-k and arg-best over (small) leaderboards and (large) error tables.

Global top-k uses ``orderBy(...).limit(k)``, which Spark plans as a
per-partition top-k followed by a merge of k rows per partition
(``TakeOrderedAndProject``), never a full sort in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def leaderboard(df: DataFrame, metric: str = "R2", ascending: bool = False, name_col: str = "Model",
                second: tuple[str, bool] | None = None) -> DataFrame:
    """Sort by one metric (and optionally a second), name as the final tie-break; adds Rank."""
    keys = [F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()]
    if second:
        keys.append(F.col(second[0]).asc_nulls_last() if second[1] else F.col(second[0]).desc_nulls_last())
    keys.append(F.col(name_col))
    # A leaderboard has one row per model: a single ordered window is fine.
    return df.withColumn("Rank", F.row_number().over(Window.orderBy(*keys)).cast("long"))


def top_k(df: DataFrame, k: int, keys: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*keys).limit(k)


def rank_within(df: DataFrame, group: Sequence[str], keys: Sequence[Column | str], name: str = "Rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*keys)).cast("long"))


def top_n_per_group(df: DataFrame, group: Sequence[str], keys: Sequence[Column | str], n: int,
                    name: str = "Rank") -> DataFrame:
    """The first n rows of each group by ``keys`` (window rank, then filter)."""
    return rank_within(df, group, keys, name).where(F.col(name) <= n)


def top_abs(df: DataFrame, value: str, k: int, name_col: str) -> DataFrame:
    """Largest |value| first, name as tie-break."""
    return df.orderBy(F.abs(F.col(value)).desc(), F.col(name_col)).limit(k)


def select_best(df: DataFrame, name_col: str = "Model", metric: str = "RMSE", lower_is_better: bool = True,
                tie: str | None = "R2", selection_set: str | None = None) -> DataFrame:
    """One row: the arg-best model (min metric; ties by higher ``tie`` then name; no metric is never best).

    With ``selection_set`` only rows of that ``EvaluationSet`` compete.
    """
    if selection_set is not None:
        df = df.where(F.col("EvaluationSet") == selection_set)
    m = F.col(metric) if lower_is_better else -F.col(metric)
    key = [m.alias("m")]
    if tie:
        key += [F.col(tie).isNull().alias("unknown"), (-F.col(tie)).alias("tie")]
    key.append(F.col(name_col).alias("name"))
    # A missing metric gives no key, and min_by skips rows without one.
    return df.agg(F.min_by(F.col(name_col), F.when(m.isNotNull(), F.struct(*key))).alias(f"Best{name_col}"))


def best_and_worst(df: DataFrame, name_col: str, metric: str) -> DataFrame:
    """One row: lowest and highest ``metric`` labels (name breaks ties; rows without the metric are neither)."""
    known = F.col(metric).isNotNull()
    return df.agg(F.min_by(F.col(name_col), F.when(known, F.struct(F.col(metric), F.col(name_col)))).alias("Best"),
                  F.min_by(F.col(name_col), F.when(known, F.struct(-F.col(metric), F.col(name_col)))).alias("Worst"),
                  F.min(metric).alias(f"Best{metric}"), F.max(metric).alias(f"Worst{metric}"))


def best_vs_second(df: DataFrame, name_col: str = "Model", order_metric: str = "RMSE",
                   deltas: Sequence[str] = ("RMSE", "MAE", "R2"), digits: int = 6) -> DataFrame:
    """Best (lowest ``order_metric``) minus runner-up for each metric, one row."""
    w = Window.orderBy(F.col(order_metric), F.col(name_col))
    ranked = df.where(F.col(order_metric).isNotNull()).withColumn("_rn", F.row_number().over(w))
    nxt = {m: F.lead(m).over(w) for m in deltas}
    with_next = ranked.select(
        "_rn", F.col(name_col).alias("Best"), F.lead(name_col).over(w).alias("RunnerUp"),
        *[F.round(F.col(m) - nxt[m], digits).alias(f"{m}Delta") for m in deltas])
    return with_next.where(F.col("_rn") == 1).drop("_rn")
