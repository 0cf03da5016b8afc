"""Running sums over a whole table in its order, without a task that holds the table or a group of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proplens.functions.names import col
from proplens.operators.joins import written


def running_sum(df: DataFrame, order: Sequence[str], weight: str, name: str = "running",
                max_ranges: int = 4096) -> DataFrame:
    """``df`` with ``_cum``, the sum of ``weight`` over all rows up to each one by ``order``, which must be unique.

    Rows are dealt by ranges of ``order`` and written with the number of their range, so that ranges stay as they are when
    a task runs again.  A range sums its own rows; what lies before it comes from one sum per range, a table as long as
    the session's number of shuffle partitions, ``max_ranges`` at most.
    """
    parts = min(max_ranges, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartitionByRange(parts, *[col(c) for c in order]).withColumn("_range", F.spark_partition_id())
    dealt = written(dealt, name)
    sums = dealt.groupBy("_range").agg(F.sum(weight).alias("_in"))
    sums = sums.select("_range", (F.sum("_in").over(Window.orderBy("_range").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col("_in")).alias("_before"))
    here = Window.partitionBy("_range").orderBy(*[col(c) for c in order]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return dealt.join(F.broadcast(sums), "_range").withColumn(
        "_cum", F.col("_before") + F.sum(weight).over(here)).drop("_range", "_before")
