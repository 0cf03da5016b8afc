"""Queries: errors, bands and metrics on the SQL-definable predictors."""

from __future__ import annotations


from proplens.operators.metrics import metrics_by_band, regression_metrics
from proplens.plans.catalog import query
from proplens.plans.oracle import BAND_LABEL, BAND_ORDER, metrics_select, with_ctes
from proplens.plans.stages import predictions

OLS = "OLS List Price"

_BANDED = ("banded AS (SELECT *, " + BAND_LABEL.format(a="ActualClosePrice") + " AS PriceBand, "
           + BAND_ORDER.format(a="ActualClosePrice") + " AS BandOrder FROM preds)")


@query("metrics_by_band", with_ctes(_BANDED) + f"""
SELECT PriceBand, BandOrder, {metrics_select()}
FROM banded WHERE Model = '{OLS}' AND PriceBand IS NOT NULL
GROUP BY PriceBand, BandOrder""")
def metrics_by_band_q(spark, sf):
    """Flagship: metrics per actual-price band for the OLS predictor on test."""
    return metrics_by_band(predictions(spark, sf, OLS))


@query("regression_metrics", with_ctes() + f"""
SELECT Model, {metrics_select()} FROM preds GROUP BY Model""")
def regression_metrics_q(spark, sf):
    """MAE, RMSE, MAPE, MdAPE, R2 of each predictor over the whole test slice."""
    return regression_metrics(predictions(spark, sf), group_cols=["Model"])
