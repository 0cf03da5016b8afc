"""Engineered features (ratios, sums, logs, age flags), one projection each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proplens.functions.names import col

from proplens.functions.scalar import finite_or_null, flag, log1p_clipped, safe_divide
from proplens.operators.clean import coerce_numeric_columns

REQUIRED_COLUMNS = ["LivingArea", "BedroomsTotal", "BathroomsTotalInteger", "LotSizeSquareFeet",
                    "ListPrice", "PropertyAge"]

# Engineered feature names, in creation order.
ENGINEERED = [
    "LivingAreaPerBedroom", "LivingAreaPerBathroom", "BedBathRatio", "ListPricePerSquareFoot",
    "LotToLivingAreaRatio", "TotalRoomsApprox", "OutdoorSpaceApprox", "LogLivingArea",
    "LogLotSize", "LogListPrice", "IsNewProperty", "IsRecentProperty", "IsOlderProperty",
    "PropertyAgeSquared",
]


# The feature dictionary (feature, description), in creation order.
FEATURE_DESCRIPTIONS = [
    ("LivingAreaPerBedroom", "Living area divided by bedroom count"),
    ("LivingAreaPerBathroom", "Living area divided by bathroom count"),
    ("BedBathRatio", "Bedroom count divided by bathroom count"),
    ("ListPricePerSquareFoot", "Listing price divided by living area"),
    ("LotToLivingAreaRatio", "Lot size divided by living area"),
    ("TotalRoomsApprox", "Bedrooms plus bathrooms"),
    ("OutdoorSpaceApprox", "Lot size minus living area"),
    ("LogLivingArea", "Natural log of living area"),
    ("LogLotSize", "Natural log of lot size"),
    ("LogListPrice", "Natural log of listing price"),
    ("IsNewProperty", "1 when property age is five years or less"),
    ("IsRecentProperty", "1 when property age is fifteen years or less"),
    ("IsOlderProperty", "1 when property age is fifty years or more"),
    ("PropertyAgeSquared", "Squared property age for nonlinear relationships"),
]


def feature_dictionary(spark) -> DataFrame:
    """The 14-row (Feature, Description) dimension."""
    return spark.createDataFrame(FEATURE_DESCRIPTIONS, "Feature string, Description string")


def ratio_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "LivingAreaPerBedroom": safe_divide("LivingArea", "BedroomsTotal"),
        "LivingAreaPerBathroom": safe_divide("LivingArea", "BathroomsTotalInteger"),
        "BedBathRatio": safe_divide("BedroomsTotal", "BathroomsTotalInteger"),
        "ListPricePerSquareFoot": safe_divide("ListPrice", "LivingArea"),
        "LotToLivingAreaRatio": safe_divide("LotSizeSquareFeet", "LivingArea"),
    })


def linear_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "TotalRoomsApprox": F.col("BedroomsTotal") + F.col("BathroomsTotalInteger"),
        "OutdoorSpaceApprox": F.col("LotSizeSquareFeet") - F.col("LivingArea"),
    })


def log_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "LogLivingArea": log1p_clipped("LivingArea"),
        "LogLotSize": log1p_clipped("LotSizeSquareFeet"),
        "LogListPrice": log1p_clipped("ListPrice"),
    })


def age_flags(df: DataFrame, age: str = "PropertyAge") -> DataFrame:
    a = F.col(age)
    return df.withColumns({
        "IsNewProperty": flag(a <= 5),
        "IsRecentProperty": flag(a <= 15),
        "IsOlderProperty": flag(a >= 50),
    })


def age_squared(df: DataFrame, age: str = "PropertyAge") -> DataFrame:
    return df.withColumn("PropertyAgeSquared", F.col(age) * F.col(age))


def create_features(df: DataFrame) -> DataFrame:
    """Coerce the required columns, add all 14 features, then non-finite -> NULL.

    Everything is column expressions, so the whole step is one codegen'd
    projection with no shuffle.
    """
    base = coerce_numeric_columns(df, [c for c in REQUIRED_COLUMNS if c in df.columns])
    out = age_squared(age_flags(log_features(linear_features(ratio_features(base)))))
    dbl = {f.name for f in out.schema.fields if f.dataType.typeName() in ("double", "float")}
    return out.select(*[finite_or_null(col(c)).alias(c) if c in dbl else col(c) for c in out.columns])
