"""The workflow stages as lazy DataFrame plans over the driver tables.

sales -> segment (P1) -> core projection (P2) -> PropertyAge (C2) -> date split
(D1) -> predictions of three SQL-definable predictors -> errors, bands,
metrics.  The fixed parameters below are the workflow's configuration.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proplens.operators.clean import add_property_age, filter_equals, project
from proplens.operators.split import split_by_date, split_chronological
from proplens.session import scratch_path
from proplens.sources.tables import LINEITEM_KEYS, prepared_sales

SEGMENT = {"PropertyType": "Residential", "PropertySubType": "SingleFamilyResidence"}
CORE_COLUMNS = ["ClosePrice", "LivingArea", "BedroomsTotal", "BathroomsTotalInteger",
                "LotSizeSquareFeet", "YearBuilt", "City", "CountyOrParish", "ListPrice", "CloseDate"]
NUMERIC_FILL = ["LivingArea", "BedroomsTotal", "BathroomsTotalInteger", "LotSizeSquareFeet",
                "ListPrice", "PropertyAge"]
CATEGORICAL = ["City", "CountyOrParish"]
TARGET = "ClosePrice"
DATE_COL = "CloseDate"
TEST_CUTOFF = "2001-01-01"
VALIDATION_FRACTION = 0.2
MODELS = ["List Price", "OLS List Price", "Train Mean"]


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared_sales(spark, sf_dir)


def segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_equals(sales(spark, sf_dir), SEGMENT)


def core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core listing columns plus the lineitem key columns (a total row order)."""
    return project(segment(spark, sf_dir), CORE_COLUMNS + LINEITEM_KEYS)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core columns with PropertyAge replacing YearBuilt (not yet imputed)."""
    return add_property_age(core(spark, sf_dir), DATE_COL, "YearBuilt")


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_by_date(prepared(spark, sf_dir), DATE_COL, TEST_CUTOFF)


_SPLITS: dict[tuple[str, str], str] = {}
_LOCK = threading.Lock()


def fit_validation(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The first 80 % and the last 20 % of train by date, split once per session and written like ``prepared_sales``."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        path = _SPLITS.get(key)
        if path is None:
            train, _ = train_test(spark, sf_dir)
            fit, val, _ = split_chronological(train, DATE_COL, LINEITEM_KEYS, VALIDATION_FRACTION)
            path = scratch_path(spark, "fit_validation")
            fit.withColumn("_side", F.lit("fit")).unionByName(val.withColumn("_side", F.lit("val"))).write.partitionBy(
                "_side").parquet(path)
            _SPLITS[key] = path
        schema = train_test(spark, sf_dir)[0].schema
    return tuple(spark.read.schema(schema).parquet(f"{path}/_side={side}") for side in ("fit", "val"))


def prediction_columns(train: DataFrame) -> dict:
    """Fit the three SQL-definable predictors on ``train``; return model -> prediction Column.

    ``List Price`` predicts the list price; ``OLS List Price`` is the
    one-feature least-squares line; ``Train Mean`` is the train mean.  Fitting
    is eager (three numbers), so scoring is a plain projection, no join.
    """
    fit = train.agg(
        F.regr_slope(TARGET, "ListPrice").alias("_slope"),
        F.regr_intercept(TARGET, "ListPrice").alias("_intercept"),
        F.avg(TARGET).alias("_mean"),
    ).first()
    lit = lambda v: F.lit(v).cast("double")
    return {
        "List Price": F.col("ListPrice"),
        "OLS List Price": lit(fit["_intercept"]) + lit(fit["_slope"]) * F.col("ListPrice"),
        "Train Mean": lit(fit["_mean"]),
    }


def sql_predictions(train: DataFrame, test: DataFrame, models: list[str] | None = None) -> DataFrame:
    """Long-form (Model, keys, actual, predicted) test predictions of the SQL predictors."""
    preds = prediction_columns(train)
    keys = [F.col(k) for k in LINEITEM_KEYS]
    if models:
        preds = {m: preds[m] for m in models}
    if len(preds) == 1:
        (m, c), = preds.items()
        return test.select(F.lit(m).alias("Model"), *keys, F.col(TARGET).alias("ActualClosePrice"),
                           c.alias("PredictedClosePrice"))
    stacked = test.select(
        *keys, F.col(TARGET).alias("ActualClosePrice"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("Model"), c.alias("PredictedClosePrice"))
                            for m, c in preds.items()])).alias("_p"))
    return stacked.select(F.col("_p.Model").alias("Model"), *keys, "ActualClosePrice",
                          F.col("_p.PredictedClosePrice").alias("PredictedClosePrice"))


def wide_sql_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row per test listing with ``<slug>_prediction`` / ``<slug>_absolute_error`` per model.

    All models score the same rows, so this is one projection (no pivot, no shuffle).
    """
    from proplens.functions.scalar import slug_text
    cols = []
    for m, c in prediction_columns(train).items():
        s = slug_text(m)
        cols += [c.alias(f"{s}_prediction"), F.abs(F.col(TARGET) - c).alias(f"{s}_absolute_error")]
    return test.select(*[F.col(k) for k in LINEITEM_KEYS], F.col(TARGET).alias("ActualClosePrice"), *cols)


def predictions(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    train, test = train_test(spark, sf_dir)
    if model:
        return sql_predictions(train, test, [model]).drop("Model")
    return sql_predictions(train, test)


def validation_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three predictors fitted on the first 80 % of train, scored on the last 20 %."""
    fit, val = fit_validation(spark, sf_dir)
    return sql_predictions(fit, val)


def two_feature_ols(train: DataFrame, x1: str, x2: str, y: str = TARGET) -> DataFrame:
    """Closed-form least squares with two features from one covariance aggregate (one row)."""
    a = train.where(F.col(x1).isNotNull() & F.col(x2).isNotNull() & F.col(y).isNotNull())
    s = a.agg(F.covar_pop(x1, x1).alias("s11"), F.covar_pop(x2, x2).alias("s22"),
              F.covar_pop(x1, x2).alias("s12"), F.covar_pop(x1, y).alias("s1y"),
              F.covar_pop(x2, y).alias("s2y"), F.avg(x1).alias("m1"), F.avg(x2).alias("m2"),
              F.avg(y).alias("my"))
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    b1 = F.try_divide(F.col("s22") * F.col("s1y") - F.col("s12") * F.col("s2y"), det)
    b2 = F.try_divide(F.col("s11") * F.col("s2y") - F.col("s12") * F.col("s1y"), det)
    r = s.select(b1.alias("b1"), b2.alias("b2"), "m1", "m2", "my").select(
        "b1", "b2", (F.col("my") - F.col("b1") * F.col("m1") - F.col("b2") * F.col("m2")).alias("b0")).first()
    return train.sparkSession.createDataFrame([(r["b1"], r["b2"], r["b0"])], "b1 double, b2 double, b0 double")


def feature_set_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test predictions of OLS on the original feature vs with an engineered feature added."""
    from proplens.operators.features import create_features
    train, test = train_test(spark, sf_dir)
    tr, te = create_features(train), create_features(test)
    f1 = tr.agg(F.regr_slope(TARGET, "ListPrice").alias("_s"), F.regr_intercept(TARGET, "ListPrice").alias("_i")) \
           .first()
    f2 = two_feature_ols(tr, "ListPrice", "TotalRoomsApprox").first()
    keys = [F.col(k) for k in LINEITEM_KEYS]
    lit = lambda v: F.lit(v).cast("double")
    p1 = te.select(
        F.lit("Original").alias("FeatureSet"), *keys, F.col(TARGET).alias("ActualClosePrice"),
        (lit(f1["_i"]) + lit(f1["_s"]) * F.col("ListPrice")).alias("PredictedClosePrice"))
    p2 = te.select(
        F.lit("Engineered").alias("FeatureSet"), *keys, F.col(TARGET).alias("ActualClosePrice"),
        (lit(f2["b0"]) + lit(f2["b1"]) * F.col("ListPrice") + lit(f2["b2"]) * F.col("TotalRoomsApprox"))
        .alias("PredictedClosePrice"))
    return p1.unionByName(p2)
