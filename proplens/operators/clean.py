"""Filtering, projection, coercion and imputation.

Imputation is split into ``fit_*`` (a small statistics DataFrame computed from
the rows you choose, e.g. the train slice only) and ``apply_*`` (a broadcast of
that one-row table), which is how train-only filling is enforced.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proplens.functions.names import col
from pyspark.sql import types as T

from proplens.functions.scalar import coerce_numeric, finite_or_null
from proplens.operators.quantiles import column_quantile

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


# -- filter / projection -----------------------------------------------------

def filter_equals(df: DataFrame, equals: Mapping[str, object]) -> DataFrame:
    """Conjunctive equality filter; rows with NULL in a filter column drop."""
    cond = F.lit(True)
    for c, v in equals.items():
        cond = cond & (col(c) == F.lit(v))
    return df.where(cond)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in columns])


def keep_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tolerant projection: the wanted columns that exist, in wanted order."""
    have = set(df.columns)
    return df.select(*[col(c) for c in columns if c in have])


def added_columns(before: DataFrame | Sequence[str], after: DataFrame | Sequence[str]) -> list[str]:
    """Sorted names present in ``after`` but not in ``before``."""
    b = set(before.columns if isinstance(before, DataFrame) else before)
    a = after.columns if isinstance(after, DataFrame) else after
    return sorted(c for c in a if c not in b)


def columns_of_kind(df: DataFrame, kinds: Iterable[str] = ("number",), exclude: bool = False) -> list[str]:
    """Columns by type family: ``number``, ``bool``, ``string``, ``datetime``."""
    fam = {
        "number": NUMERIC_TYPES, "bool": (T.BooleanType,), "string": (T.StringType,),
        "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
    }
    want = tuple(t for k in kinds for t in fam[k])
    return [f.name for f in df.schema.fields if isinstance(f.dataType, want) != exclude]


def select_kind(df: DataFrame, kinds: Iterable[str] = ("number",), exclude: bool = False) -> DataFrame:
    return df.select(*columns_of_kind(df, kinds, exclude))


# -- missingness ---------------------------------------------------------------

def is_missing(df: DataFrame, c: str) -> Column:
    """Whether a column has no value: NULL, or NaN where it is a float or double."""
    dt = df.schema[c].dataType
    value = col(c)
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, ordinal, missing_count, missing_pct) from ONE aggregate scan."""
    cols = list(columns or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.sum(is_missing(df, c).cast("long")).alias(f"_m{i}") for i, c in enumerate(cols)])
    stacked = agg.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(i + 1).alias("ordinal"),
                 F.col(f"_m{i}").alias("missing_count")) for i, c in enumerate(cols)])).alias("_s"))
    return stacked.select(
        "_s.column_name", "_s.ordinal", "_s.missing_count",
        (F.try_divide(F.col("_s.missing_count").cast("double"), F.col("_rows")) * 100).alias("missing_pct"))


def missing_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return missing_summary(df, columns).select("column_name", "missing_pct")


def missing_topk(df: DataFrame, k: int = 20, columns: Sequence[str] | None = None) -> DataFrame:
    return missing_summary(df, columns).orderBy(F.desc("missing_count"), "column_name").limit(k) \
        .select("column_name", "missing_count")


def prune_decisions(df: DataFrame, threshold: float = 70.0, columns: Sequence[str] | None = None,
                    protect: Sequence[str] = ()) -> DataFrame:
    """Keep a column iff its missing % is strictly below ``threshold``.

    Protected (core) columns are always kept and reported instead.
    """
    s = missing_summary(df, columns)
    keep = (F.col("missing_pct") < threshold) | F.col("column_name").isin(list(protect) or [""])
    return s.withColumn("kept", F.coalesce(keep, F.lit(True)))


def prune_sparse_columns(df: DataFrame, threshold: float = 70.0, protect: Sequence[str] = ()) -> DataFrame:
    """Drop sparse columns; schema order is kept.  One small aggregate job decides."""
    decided = prune_decisions(df, threshold, protect=protect).where(~F.col("kept")).select("column_name")
    drop = {r[0] for r in decided.collect()}  # at most one row per column
    return df.select(*[c for c in df.columns if c not in drop])


# -- coercion ------------------------------------------------------------------

def parse_timestamp(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """Text -> timestamp; invalid text raises (ANSI), timestamps pass through."""
    dt = df.schema[col].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return df
    return df.withColumn(col, F.to_timestamp(F.col(col), fmt) if fmt else F.to_timestamp(F.col(col)))


def add_property_age(df: DataFrame, date_col: str = "CloseDate", built_col: str = "YearBuilt",
                     out: str = "PropertyAge") -> DataFrame:
    """``year(date) - built`` (may be negative); the built-year column is dropped."""
    cols = []
    for c in df.columns:
        if c == built_col:
            continue
        cols.append(col(c))
    return df.select(*cols, (F.year(date_col).cast("double") - F.col(built_col)).alias(out))


def coerce_numeric_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns -> double: text is parsed leniently, numbers are cast; NaN/Inf -> NULL.

    Numeric columns never take the text path (no per-row formatting).
    """
    want = set(columns)
    out = []
    for f in df.schema.fields:
        if f.name not in want:
            out.append(col(f.name))
        elif isinstance(f.dataType, (*NUMERIC_TYPES, T.BooleanType)):
            out.append(finite_or_null(col(f.name).cast("double")).alias(f.name))
        else:
            out.append(coerce_numeric(f.name).alias(f.name))
    return df.select(*out)


def inf_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN/+-Inf -> NULL over every float/double column, in one projection."""
    want = set(columns) if columns is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (want is None or f.name in want):
            out.append(finite_or_null(col(f.name)).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


# -- imputation ----------------------------------------------------------------

def _one_row(spark, values: Mapping[str, object], typ: str) -> DataFrame:
    """The fitted statistics as a one-row local table (no job to read it back)."""
    schema = ", ".join(f"`{c}` {typ}" for c in values)
    return spark.createDataFrame([tuple(values.values())], schema)


def fit_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fit: one exact median per column (all-NULL column -> 0.0), as a one-row table.

    All columns are bracketed in one scan and counted in another (``column_quantile``).  Fitting is
    eager, like an estimator's ``fit``: the result is k numbers.
    """
    found = column_quantile(df, columns, 0.5)
    return _one_row(df.sparkSession, {c: float(v or 0.0) for c, v in zip(columns, found)}, "double")


def apply_fill(df: DataFrame, stats: DataFrame | Mapping[str, object]) -> DataFrame:
    """Fill NULLs, and NaN in floats and doubles, with fitted constants (a one-row table or a dict), inlined as literals."""
    values = stats.first().asDict() if isinstance(stats, DataFrame) else dict(stats)
    have = {c: F.when(~is_missing(df, c), col(c)) for c in df.columns if c in values}
    return df.select(*[F.coalesce(have[c], F.lit(values[c])).alias(c) if c in values else col(c) for c in df.columns])


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def fit_modes(df: DataFrame, columns: Sequence[str], default: str = "Unknown") -> DataFrame:
    """One row: most frequent non-null value per column, smallest value on ties.

    Counted with a distributed ``groupBy`` (map-side combined), never a
    per-group value map in one task.
    """
    cols = list(columns)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_name"), F.when(~is_missing(df, c), col(c)).cast("string").alias("_value"))
        for c in cols])).alias("_s")
    ).select("_s._name", "_s._value").where(F.col("_value").isNotNull())
    counts = long.groupBy("_name", "_value").agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy("_name").agg(
        F.min_by("_value", F.struct(-F.col("_n"), F.col("_value"))).alias("_mode"))
    row = best.agg(*[F.coalesce(F.max(F.when(F.col("_name") == c, F.col("_mode"))), F.lit(default)).alias(c)
                     for c in cols]).first()
    return _one_row(df.sparkSession, {c: row[c] for c in cols}, "string")


def fill_stats_long(stats: DataFrame, value_name: str = "FillValue") -> DataFrame:
    """Unpivot a one-row statistics table to (Column, value) rows."""
    return stats.unpivot([], stats.columns, "Column", value_name)
