"""Joining per-group statistics back onto the rows they summarise."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proplens.functions.names import col
from proplens.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the shared folder: computed once, and of a size that Spark's planner knows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_null_safe(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the key columns of ``df`` stay."""
    theirs = {k: f"__other{i}" for i, k in enumerate(keys)}
    other = other.select(*[col(c).alias(theirs.get(c, c)) for c in other.columns])
    match = reduce(lambda a, b: a & b, [col(k).eqNullSafe(col(t)) for k, t in theirs.items()])
    return df.join(other, match, how).drop(*theirs.values())


def join_group_stats(df: DataFrame, stats: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``df`` joined with a one-row-per-group statistics table on ``groups``.

    Without groups the statistics are one row, read once and added as literal columns (no join at all).  With
    groups the table is written first, and Spark broadcasts it if its bytes allow, else shuffles both sides, where
    adaptive execution splits a hot group.
    """
    groups = list(groups)
    if not groups:
        row = stats.first()
        return df.select("*", *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in stats.schema.fields])
    return join_null_safe(df, written(stats, "group_stats"), groups)
