"""Union, pivot/unpivot and comparison tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proplens.functions.scalar import slug_text


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def wide_predictions(long: DataFrame, id_cols: Sequence[str], model_col: str = "Model",
                     actual: str = "ActualClosePrice", predicted: str = "PredictedClosePrice",
                     models: Sequence[str] | None = None) -> DataFrame:
    """One row per id: actual, then ``<slug>_prediction`` and ``<slug>_absolute_error`` per model.

    A grouped pivot with the model list given up front (no extra distinct job).
    """
    if models is None:
        models = [r[0] for r in long.select(model_col).distinct().orderBy(model_col).collect()]
    aggs = []
    for m in models:
        s = slug_text(m)
        hit = F.col(model_col) == F.lit(m)
        aggs.append(F.max(F.when(hit, F.col(predicted))).alias(f"{s}_prediction"))
        aggs.append(F.max(F.when(hit, F.abs(F.col(actual) - F.col(predicted)))).alias(f"{s}_absolute_error"))
    return long.groupBy(*id_cols).agg(F.first(actual).alias(actual), *aggs)


def improvement_summary(metrics: DataFrame, set_col: str, original: str, engineered: str,
                        metric_cols: Sequence[str] = ("MAE", "RMSE", "MAPE", "MdAPE", "R2"),
                        higher_is_better: Sequence[str] = ("R2",), digits: int = 6) -> DataFrame:
    """Per metric: Original, Engineered and the signed improvement.

    Error metrics improve when they fall (orig - eng); R2 improves when it rises.
    """
    long = metrics.unpivot([set_col], list(metric_cols), "Metric", "Value")
    wide = long.groupBy("Metric").pivot(set_col, [original, engineered]).agg(F.first("Value"))
    o, e = F.col(original), F.col(engineered)
    imp = F.when(F.col("Metric").isin(list(higher_is_better)), e - o).otherwise(o - e)
    return wide.select("Metric", F.round(o, digits).alias("Original"), F.round(e, digits).alias("Engineered"),
                       F.round(imp, digits).alias("Improvement"))


def improvement_verdict(summary: DataFrame) -> DataFrame:
    """Improved iff the MAE gain and the R2 gain are both positive."""
    agg = summary.agg(F.max(F.when(F.col("Metric") == "MAE", F.col("Improvement"))).alias("MAEImprovement"),
                      F.max(F.when(F.col("Metric") == "R2", F.col("Improvement"))).alias("R2Improvement"))
    ok = (F.col("MAEImprovement") > 0) & (F.col("R2Improvement") > 0)
    return agg.select("*", F.coalesce(ok, F.lit(False)).alias("Improved"),
                      F.when(ok, "engineered features improved the model")
                       .otherwise("engineered features did not improve the model").alias("Verdict"))
