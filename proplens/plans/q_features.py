"""Queries: engineered features (null-safe ratios, sums, logs, age flags)."""

from __future__ import annotations

from pyspark.sql import functions as F

from proplens.operators import features as FE
from proplens.plans import stages as S
from proplens.plans.catalog import query
from proplens.plans.oracle import with_ctes

ID = ["l_orderkey", "l_linenumber"]


def _feat(spark, sf):
    return FE.create_features(S.prepared(spark, sf))


def _r(names, digits=6):
    return [F.round(F.col(n), digits).alias(n) for n in names]


def _div(n, d):
    return f"{n} / nullif({d}, 0)"


@query("safe_ratios", with_ctes() + f"""
SELECT l_orderkey, l_linenumber,
  {_div('LivingArea', 'BedroomsTotal')} AS LivingAreaPerBedroom,
  {_div('LivingArea', 'BathroomsTotalInteger')} AS LivingAreaPerBathroom,
  {_div('BedroomsTotal', 'BathroomsTotalInteger')} AS BedBathRatio,
  {_div('ListPrice', 'LivingArea')} AS ListPricePerSquareFoot,
  {_div('LotSizeSquareFeet', 'LivingArea')} AS LotToLivingAreaRatio
FROM prep""")
def safe_ratios(spark, sf):
    """Five ratios; a zero or missing denominator gives NULL (one IEEE division each)."""
    return _feat(spark, sf).select(*ID, *FE.ENGINEERED[:5])


@query("linear_features", with_ctes() + """
SELECT l_orderkey, l_linenumber, BedroomsTotal + BathroomsTotalInteger AS TotalRoomsApprox,
  round(LotSizeSquareFeet - LivingArea, 6) AS OutdoorSpaceApprox FROM prep""")
def linear_features(spark, sf):
    """Rooms = bedrooms + bathrooms; outdoor = lot - living area (NULL propagates)."""
    f = _feat(spark, sf)
    return f.select(*ID, "TotalRoomsApprox", F.round("OutdoorSpaceApprox", 6).alias("OutdoorSpaceApprox"))


def _log(c):
    return f"round(ln(1 + CASE WHEN {c} < 0 THEN 0 ELSE {c} END), 6)"


@query("log_features", with_ctes() + f"""
SELECT l_orderkey, l_linenumber, {_log('LivingArea')} AS LogLivingArea, {_log('LotSizeSquareFeet')} AS LogLotSize,
  {_log('ListPrice')} AS LogListPrice FROM prep""")
def log_features(spark, sf):
    """log1p of the value clipped at 0 (NULL stays NULL)."""
    return _feat(spark, sf).select(*ID, *_r(["LogLivingArea", "LogLotSize", "LogListPrice"]))


@query("age_flags", with_ctes() + """
SELECT l_orderkey, l_linenumber,
  CAST(coalesce(PropertyAge <= 5, false) AS INTEGER) AS IsNewProperty,
  CAST(coalesce(PropertyAge <= 15, false) AS INTEGER) AS IsRecentProperty,
  CAST(coalesce(PropertyAge >= 50, false) AS INTEGER) AS IsOlderProperty FROM prep""")
def age_flags(spark, sf):
    """0/1 flags for age <= 5, <= 15, >= 50; a missing age counts as 0."""
    return _feat(spark, sf).select(*ID, "IsNewProperty", "IsRecentProperty", "IsOlderProperty")


@query("age_squared", with_ctes() + """
SELECT l_orderkey, l_linenumber, PropertyAge * PropertyAge AS PropertyAgeSquared FROM prep""")
def age_squared(spark, sf):
    """PropertyAge squared."""
    return _feat(spark, sf).select(*ID, "PropertyAgeSquared")


@query("feature_summary", with_ctes(f"""f AS (SELECT *,
  {_div('LivingArea', 'BedroomsTotal')} AS LivingAreaPerBedroom,
  {_div('ListPrice', 'LivingArea')} AS ListPricePerSquareFoot,
  BedroomsTotal + BathroomsTotalInteger AS TotalRoomsApprox,
  CAST(coalesce(PropertyAge <= 5, false) AS INTEGER) AS IsNewProperty,
  CAST(coalesce(PropertyAge >= 50, false) AS INTEGER) AS IsOlderProperty FROM prep)""") + """
SELECT CASE WHEN CloseDate < TIMESTAMP '2001-01-01' THEN 'train' ELSE 'test' END AS split,
  count(*) AS rows, count(LivingAreaPerBedroom) AS area_per_bed_rows,
  round(avg(ListPricePerSquareFoot), 6) AS avg_price_per_sqft, CAST(sum(IsNewProperty) AS BIGINT) AS new_properties,
  CAST(sum(IsOlderProperty) AS BIGINT) AS older_properties, round(avg(TotalRoomsApprox), 6) AS avg_rooms
FROM f GROUP BY 1""")
def feature_summary(spark, sf):
    """The full feature step on both splits, summarised per split."""
    train, test = S.train_test(spark, sf)
    both = FE.create_features(train).withColumn("split", F.lit("train")).unionByName(
        FE.create_features(test).withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.count("LivingAreaPerBedroom").alias("area_per_bed_rows"),
        F.round(F.avg("ListPricePerSquareFoot"), 6).alias("avg_price_per_sqft"),
        F.sum("IsNewProperty").cast("long").alias("new_properties"),
        F.sum("IsOlderProperty").cast("long").alias("older_properties"),
        F.round(F.avg("TotalRoomsApprox"), 6).alias("avg_rooms"))
