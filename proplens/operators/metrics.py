"""Prediction errors, price bands and regression metrics.

All metrics of a group come from one ``groupBy`` (partial aggregation, so a
hot group is pre-combined map-side) plus the exact median of the
percentage errors (see ``quantiles``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proplens.functions.scalar import PRICE_BANDS, band_label, band_order, finite_or_null, safe_divide, known
from proplens.operators.joins import join_null_safe
from proplens.operators.quantiles import exact_median

METRIC_COLUMNS = ["MAE", "RMSE", "MAPE", "MdAPE", "R2"]


def prediction_errors(df: DataFrame, actual: str = "ActualClosePrice",
                      predicted: str = "PredictedClosePrice") -> DataFrame:
    """Residual, absolute error and signed-denominator absolute % error.

    The percentage divides by the signed actual value (NULL when it is 0).
    """
    a, p = F.col(actual), F.col(predicted)
    return df.withColumns({
        "Residual": a - p,
        "AbsoluteError": F.abs(a - p),
        "AbsolutePercentageError": safe_divide(F.abs(a - p), a) * 100,
    })


def price_bands(df: DataFrame, price_col: str = "ActualClosePrice", label_col: str = "PriceBand",
                order_col: str = "BandOrder", bands=PRICE_BANDS) -> DataFrame:
    return df.withColumns({label_col: band_label(price_col, bands), order_col: band_order(price_col, bands)})


def band_dimension(spark: SparkSession, bands=PRICE_BANDS, label_col: str = "PriceBand",
                   order_col: str = "BandOrder") -> DataFrame:
    """The fixed band table (label, order, bounds): five rows by definition."""
    rows = [(label, i, lo, hi) for i, (label, lo, hi) in enumerate(bands, start=1)]
    return spark.createDataFrame(rows, f"{label_col} string, {order_col} int, LowerBound double, UpperBound double")


def _metric_aggs(actual: str, predicted: str):
    # Every sum and count is over the rows that have both values.
    a, p = known(actual), known(predicted)
    both = a.isNotNull() & p.isNotNull()
    a, p = F.when(both, a), F.when(both, p)
    e = a - p
    ape = F.when(a != 0, F.abs(e / a))
    return [
        F.count(a).alias("ObservationCount"),
        F.avg(F.abs(e)).alias("_mae"),
        F.sqrt(F.avg(e * e)).alias("_rmse"),
        (F.avg(ape) * 100).alias("_mape"),
        F.sum(e * e).alias("_ssres"),
        (F.var_pop(a) * F.count(a)).alias("_sstot"),
        F.count(a).alias("_na"),
    ]


def unscored_rows(df: DataFrame, actual: str = "ActualClosePrice", predicted: str = "PredictedClosePrice") -> int:
    """Rows that the metrics leave out because the actual or the predicted value is missing."""
    return df.where(known(actual).isNull() | known(predicted).isNull()).count()


def regression_metrics(df: DataFrame, actual: str = "ActualClosePrice",
                       predicted: str = "PredictedClosePrice", group_cols: Sequence[str] = (),
                       rounded: bool = True) -> DataFrame:
    """MAE, RMSE, MAPE, MdAPE (percent, rows with actual = 0 skipped) and R^2.

    Rows without an actual or a predicted value count nowhere (see ``unscored_rows``).  R^2 follows the usual library convention: fewer than two rows -> NULL; a
    constant actual gives 1 for an exact fit and 0 otherwise.
    """
    groups = list(group_cols)
    a, p = known(actual), known(predicted)
    valid = a.isNotNull() & p.isNotNull() & (a != 0)
    ape = F.when(valid, F.abs((a - p) / a))
    # The median leaves out groups without any percentage; those keep a null.
    joined = _with_mdape(df, ape, groups, actual, predicted)
    r2 = (F.when(F.col("_na") < 2, F.lit(None).cast("double"))
           .when(F.col("_sstot") == 0, F.when(F.col("_ssres") == 0, 1.0).otherwise(0.0))
           .otherwise(1 - F.col("_ssres") / F.col("_sstot")))
    cols = {
        "MAE": F.col("_mae"), "RMSE": F.col("_rmse"), "MAPE": F.col("_mape"),
        "MdAPE": F.col("_mdape") * 100, "R2": r2,
    }
    if rounded:
        cols = {k: F.round(finite_or_null(v), 4 if k in ("MAE", "RMSE") else 6) for k, v in cols.items()}
    return joined.select(*groups, "ObservationCount", *[v.alias(k) for k, v in cols.items()])


def _with_mdape(df, ape, groups, actual, predicted):
    """The aggregates per group beside the median of ``ape``, both small tables."""
    stats = df.groupBy(*groups).agg(*_metric_aggs(actual, predicted))
    med = exact_median(df.select(*groups, ape.alias("_ape")), "_ape", groups, name="_mdape")
    if not groups:  # a global median is one number: fitted eagerly, inlined as a literal
        return stats.withColumn("_mdape", F.lit(med.first()[0]).cast("double"))
    return join_null_safe(stats, med, groups, "left")


def metrics_by_band(df: DataFrame, actual: str = "ActualClosePrice",
                    predicted: str = "PredictedClosePrice", bands=PRICE_BANDS,
                    extra_groups: Sequence[str] = ()) -> DataFrame:
    """Metrics per actual-price band; empty bands are absent, rows carry the band order."""
    banded = price_bands(df, actual, bands=bands).where(F.col("PriceBand").isNotNull())
    return regression_metrics(banded, actual, predicted, [*extra_groups, "PriceBand", "BandOrder"])
