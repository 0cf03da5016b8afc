"""Date and ordered-fraction splits, distributed.

``split_chronological`` returns exactly the rows a global ``row_number`` over
(order columns) would put first, without sorting all rows in one task: it
counts rows per date, finds the boundary date by a running sum, and
ranks only that date's rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proplens.functions.names import col
from proplens.operators.ranged import running_sum


def split_by_date(df: DataFrame, date_col: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """(train, test): train < cutoff <= test; NULL dates go to neither."""
    cut = F.lit(cutoff).cast("timestamp_ntz") if "ntz" in df.schema[date_col].dataType.typeName() \
        else F.to_timestamp(F.lit(cutoff))
    return df.where(F.col(date_col) < cut), df.where(F.col(date_col) >= cut)


def fit_count(n: int, fraction: float) -> int:
    """Size of the first part: floor(n * (1 - fraction)); both parts non-empty."""
    if not 0 < fraction < 1:
        raise ValueError("validation fraction must be between 0 and 1")
    cut = int(math.floor(n * (1 - fraction)))
    if cut <= 0 or cut >= n:
        raise ValueError(f"fraction {fraction} of {n} rows leaves one side of the split without rows")
    return cut


#: Ranges of dates that a running count is dealt into, at most.
BUCKETS = 4096


def date_key(df: DataFrame, date_col: str) -> Column:
    """A date, timestamp or whole number as a long that orders the same way, made inside Spark.

    Instants give their microseconds; dates and timestamps without a zone their day and time as written, which no time
    zone moves.
    """
    d, kind = F.col(date_col), df.schema[date_col].dataType.typeName()
    if kind in ("byte", "short", "integer", "long"):
        return d.cast("long")
    if kind == "timestamp":
        return F.unix_micros(d)
    day = F.unix_date(d.cast("date")).cast("long") * 86_400_000_000
    if kind == "date":
        return day
    second = (F.date_part(F.lit("SECOND"), d) * 1_000_000).cast("long")
    return day + F.hour(d) * 3_600_000_000 + F.minute(d) * 60_000_000 + second


def split_chronological(df: DataFrame, date_col: str, tiebreak: Sequence[str], fraction: float = 0.2,
                        n: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """First ``floor(n(1-f))`` rows by (date, tiebreak...) -> fit, the rest -> validation.

    Returns (fit, validation, cut).  ``tiebreak`` should make the order total;
    fully identical rows are interchangeable, so any of them may be taken.

    Rows are counted per date once; a running sum over these counts, dealt by ranges of dates, shows the one boundary
    date in one job, whatever the number of dates.  Only that date's rows need a rank: a range partitioning on the tiebreak columns plus a salt, so that one huge
    date, or many copies of one row, spreads over all tasks, checkpointed so that per-partition offsets stay valid.
    """
    spark = df.sparkSession
    key = date_key(df, date_col)
    counts = running_sum(df.where(F.col(date_col).isNotNull()).groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")),
                         ["key"], "n", "split_dates", BUCKETS)
    cut = fit_count((counts.agg(F.max("_cum")).first()[0] or 0) if n is None else n, fraction)
    edge = counts.where(F.col("_cum") >= cut).agg(F.min("key"), F.min(F.col("_cum") - F.col("n"))).first()
    edge, take = edge[0], cut - edge[1]
    cols = [col(c) for c in df.columns]
    before, after, day = df.where(key < edge), df.where(key > edge), df.where(key == edge)
    ranked = _rank_spread(day, [col(c) for c in tiebreak], int(spark.conf.get("spark.sql.shuffle.partitions")))
    fit = before.select(*cols).unionByName(ranked.where(F.col("_rank") < take).select(*cols))
    val = after.select(*cols).unionByName(ranked.where(F.col("_rank") >= take).select(*cols))
    return fit, val, cut


def _rank_spread(day: DataFrame, order, parts: int) -> DataFrame:
    """0-based rank of rows by ``order`` without a single-task sort."""
    pinned = (day.withColumn("_salt", F.rand(42))
                 .repartitionByRange(parts, *order, F.col("_salt"))
                 .sortWithinPartitions(*order, F.col("_salt"))
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id())
                 .checkpoint(eager=True))
    offsets = pinned.groupBy("_pid").agg(F.count(F.lit(1)).alias("_pn"), F.min("_mid").alias("_pmin"))
    ow = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = offsets.withColumn("_off", F.sum("_pn").over(ow) - F.col("_pn")).select("_pid", "_off", "_pmin")
    # One row per partition: a bounded table.
    return pinned.join(F.broadcast(offsets), "_pid").withColumn(
        "_rank", F.col("_off") + F.col("_mid") - F.col("_pmin"))
