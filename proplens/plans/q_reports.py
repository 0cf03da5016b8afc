"""Queries: profiles, error reports, leaderboards, comparisons, quality gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from proplens.functions.scalar import format_money, format_percent, format_ratio, slug
from proplens.operators import metrics as M
from proplens.operators import profile as P
from proplens.operators import quality as V
from proplens.operators import rank as R
from proplens.operators import reshape as U
from proplens.operators.clean import apply_fill, fit_medians, fit_modes
from proplens.operators.features import ENGINEERED, FEATURE_DESCRIPTIONS, create_features, feature_dictionary
from proplens.session import scratch_path
from proplens.sources import files
from proplens.plans import stages as S
from proplens.plans.catalog import query
from proplens.plans.oracle import BAND_LABEL, BAND_ORDER, KEYS, metrics_select, with_ctes

ID = ["l_orderkey", "l_linenumber"]
OLS = "OLS List Price"
DESCRIBE5 = ["LivingArea", "BedroomsTotal", "BathroomsTotalInteger", "LotSizeSquareFeet", "ListPrice"]
CORR_COLS = ["ClosePrice", "LivingArea", "BedroomsTotal", "BathroomsTotalInteger", "LotSizeSquareFeet",
             "ListPrice", "PropertyAge"]
PROFILE_COLS = ["ClosePrice", "LivingArea", "BedroomsTotal", "BathroomsTotalInteger", "LotSizeSquareFeet",
                "City", "CountyOrParish", "ListPrice", "PropertyAge"]
IMPORTANCE_FEATURES = ["LivingArea", "BedroomsTotal", "BathroomsTotalInteger", "LotSizeSquareFeet",
                       "ListPrice", "PropertyAge", *ENGINEERED]


# -- SQL fragments ---------------------------------------------------------------

def _describe_sql(cols, src="prep"):
    parts = []
    for i, c in enumerate(cols):
        parts.append(
            f"SELECT '{c}' AS column_name, {i + 1} AS ordinal, count({c}) AS count, round(avg({c}), 4) AS mean, "
            f"round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, "
            f"round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, "
            f"round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM {src}")
    return " UNION ALL ".join(parts)


def _corr_sql(a, b):
    return (f"covar_pop({a}, {b}) / nullif(stddev_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) * "
            f"stddev_pop(CASE WHEN {a} IS NOT NULL THEN {b} END), 0)")


def _hist_sql(src, x, bins=50):
    return f"""h_rng AS (SELECT min({x}) AS lo, max({x}) AS hi FROM {src} WHERE {x} IS NOT NULL),
h_bins AS (SELECT CAST(b AS INTEGER) AS bin, lo, hi FROM h_rng,
  generate_series(0, CASE WHEN hi = lo THEN 0 ELSE {bins - 1} END) g(b)),
h_cnt AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor(({x} - lo) * {bins} / (hi - lo)), {bins - 1}) END
  AS INTEGER) AS bin, count(*) AS n FROM {src}, h_rng WHERE {x} IS NOT NULL GROUP BY 1)"""


_HIST_SELECT = """SELECT h_bins.bin, round(lo + h_bins.bin * ((hi - lo) / {bins}), 4) AS bin_start,
  round(CASE WHEN hi = lo THEN hi ELSE lo + (h_bins.bin + 1) * ((hi - lo) / {bins}) END, 4) AS bin_end,
  coalesce(n, 0) AS count FROM h_bins LEFT JOIN h_cnt ON h_bins.bin = h_cnt.bin"""

_ENG_SQL = """feat AS (SELECT *, LivingArea / nullif(BedroomsTotal, 0) AS LivingAreaPerBedroom,
  LivingArea / nullif(BathroomsTotalInteger, 0) AS LivingAreaPerBathroom,
  BedroomsTotal / nullif(BathroomsTotalInteger, 0) AS BedBathRatio,
  ListPrice / nullif(LivingArea, 0) AS ListPricePerSquareFoot,
  LotSizeSquareFeet / nullif(LivingArea, 0) AS LotToLivingAreaRatio,
  BedroomsTotal + BathroomsTotalInteger AS TotalRoomsApprox,
  LotSizeSquareFeet - LivingArea AS OutdoorSpaceApprox,
  ln(1 + CASE WHEN LivingArea < 0 THEN 0 ELSE LivingArea END) AS LogLivingArea,
  ln(1 + CASE WHEN LotSizeSquareFeet < 0 THEN 0 ELSE LotSizeSquareFeet END) AS LogLotSize,
  ln(1 + CASE WHEN ListPrice < 0 THEN 0 ELSE ListPrice END) AS LogListPrice,
  CAST(coalesce(PropertyAge <= 5, false) AS INTEGER) AS IsNewProperty,
  CAST(coalesce(PropertyAge <= 15, false) AS INTEGER) AS IsRecentProperty,
  CAST(coalesce(PropertyAge >= 50, false) AS INTEGER) AS IsOlderProperty,
  PropertyAge * PropertyAge AS PropertyAgeSquared FROM train)"""

_IMP_RAW = "imp_raw AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS Feature, abs({_corr_sql(f, 'ClosePrice')}) AS c FROM feat" for f in IMPORTANCE_FEATURES) + ")"
_IMP = """imp AS (
  SELECT 'Correlation' AS Model, Feature, round(c / sum(c) OVER (), 6) AS Importance FROM imp_raw WHERE c IS NOT NULL
  UNION ALL
  SELECT 'R2 Share', Feature, round(c * c / sum(c * c) OVER (), 6) FROM imp_raw WHERE c IS NOT NULL)"""

_VAL = f"""ordered AS (SELECT *, row_number() OVER (ORDER BY CloseDate, {KEYS}) AS rn, count(*) OVER () AS n
  FROM train),
fitset AS (SELECT * FROM ordered WHERE rn <= n * 4 // 5),
valset AS (SELECT * FROM ordered WHERE rn > n * 4 // 5),
vfit AS (SELECT regr_slope(ClosePrice, ListPrice) AS slope, regr_intercept(ClosePrice, ListPrice) AS intercept,
  avg(ClosePrice) AS mean FROM fitset),
vpreds AS (
  SELECT 'List Price' AS Model, ClosePrice AS ActualClosePrice, ListPrice AS PredictedClosePrice FROM valset
  UNION ALL SELECT 'OLS List Price', ClosePrice, intercept + slope * ListPrice FROM valset, vfit
  UNION ALL SELECT 'Train Mean', ClosePrice, mean FROM valset, vfit),
vm AS (SELECT Model, {metrics_select()} FROM vpreds GROUP BY Model)"""

_BANDED = ("banded AS (SELECT *, " + BAND_LABEL.format(a="ActualClosePrice") + " AS PriceBand, "
           + BAND_ORDER.format(a="ActualClosePrice") + " AS BandOrder FROM preds)")

_FS = """fs_fit1 AS (SELECT regr_slope(ClosePrice, ListPrice) AS s, regr_intercept(ClosePrice, ListPrice) AS i
  FROM train),
fs_tr AS (SELECT ListPrice AS x1, BedroomsTotal + BathroomsTotalInteger AS x2, ClosePrice AS y FROM train),
fs_cov AS (SELECT covar_pop(x1, x1) AS s11, covar_pop(x2, x2) AS s22, covar_pop(x1, x2) AS s12,
  covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM fs_tr),
fs_fit2 AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM (
  SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
         (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM fs_cov)),
fs_preds AS (
  SELECT 'Original' AS FeatureSet, ClosePrice AS ActualClosePrice, i + s * ListPrice AS PredictedClosePrice
  FROM test, fs_fit1
  UNION ALL
  SELECT 'Engineered', ClosePrice, b0 + b1 * ListPrice + b2 * (BedroomsTotal + BathroomsTotalInteger)
  FROM test, fs_fit2),
fs_m AS (SELECT FeatureSet, """ + metrics_select() + """ FROM fs_preds GROUP BY FeatureSet),
fs_long AS (UNPIVOT fs_m ON MAE, RMSE, MAPE, MdAPE, R2 INTO NAME Metric VALUE Value),
fs_sum AS (SELECT Metric, round(max(CASE WHEN FeatureSet = 'Original' THEN Value END), 6) AS Original,
  round(max(CASE WHEN FeatureSet = 'Engineered' THEN Value END), 6) AS Engineered FROM fs_long GROUP BY Metric),
fs_imp AS (SELECT Metric, Original, Engineered,
  round(CASE WHEN Metric = 'R2' THEN Engineered - Original ELSE Original - Engineered END, 6) AS Improvement
  FROM fs_sum)"""


# -- Spark helpers ---------------------------------------------------------------

def _importances(spark, sf):
    """Filter-method importances of two kinds from train: |corr| and corr^2, each summing to 1."""
    train, _ = S.train_test(spark, sf)
    feat = create_features(train)
    corr = P.target_correlation(feat, S.TARGET, IMPORTANCE_FEATURES, k=len(IMPORTANCE_FEATURES), digits=15)
    raw = corr.select("Feature", F.abs("Correlation").alias("c")).where(F.col("c").isNotNull())
    a = raw.select(F.lit("Correlation").alias("Model"), "Feature", F.col("c").alias("v"))
    b = raw.select(F.lit("R2 Share").alias("Model"), "Feature", (F.col("c") * F.col("c")).alias("v"))
    # Each table has one row per feature: the per-model window is tiny.
    per_model = Window.partitionBy("Model")
    return [d.select("Model", "Feature", F.round(F.col("v") / F.sum("v").over(per_model), 6).alias("Importance"))
            for d in (a, b)]


def _validation_metrics(spark, sf):
    return M.regression_metrics(S.validation_predictions(spark, sf), group_cols=["Model"])


# -- profiles ------------------------------------------------------------------------

@query("describe_target", with_ctes() + _describe_sql(["ClosePrice"]))
def describe_target(spark, sf):
    """count, mean, std, min, exact quartiles, max of the target."""
    return P.describe(S.prepared(spark, sf), ["ClosePrice"])


@query("describe_columns", with_ctes() + _describe_sql(DESCRIBE5))
def describe_columns(spark, sf):
    """The same statistics for five predictors (one pass, long form)."""
    return P.describe(S.prepared(spark, sf), DESCRIBE5)


@query("histogram_price", with_ctes(_hist_sql("prep", "ClosePrice")) + _HIST_SELECT.format(bins=50))
def histogram_price(spark, sf):
    """50 equal-width bins of the close price (last bin closed, empty bins kept)."""
    return P.histogram(S.prepared(spark, sf), "ClosePrice", 50)


@query("histogram_residual", with_ctes(f"""res AS (SELECT ActualClosePrice - PredictedClosePrice AS r FROM preds
  WHERE Model = '{OLS}')""", _hist_sql("res", "r")) + _HIST_SELECT.format(bins=50))
def histogram_residual(spark, sf):
    """50 bins of the OLS residuals on test."""
    p = S.predictions(spark, sf, OLS)
    return P.histogram(p.select((F.col("ActualClosePrice") - F.col("PredictedClosePrice")).alias("r")), "r", 50)


@query("correlation_matrix", with_ctes() + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round({_corr_sql(a, b)}, 6) AS correlation FROM prep"
    for a in CORR_COLS for b in CORR_COLS))
def correlation_matrix(spark, sf):
    """Pairwise-complete Pearson correlations of seven numeric columns, one aggregate."""
    return P.correlation_matrix(S.prepared(spark, sf), CORR_COLS)


@query("target_correlation_topk", with_ctes("tc AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS Feature, round({_corr_sql(c, 'ClosePrice')}, 6) AS Correlation FROM feat"
    for c in IMPORTANCE_FEATURES) + ")").replace("WITH ", "WITH ", 1).replace(
        ",\ntc AS", ",\n" + _ENG_SQL.replace("FROM train)", "FROM prep)") + ",\ntc AS") + """
SELECT Feature, Correlation FROM tc ORDER BY Correlation DESC NULLS LAST, Feature LIMIT 20""")
def target_correlation_topk(spark, sf):
    """Correlation of every base and engineered feature with the target, top 20."""
    feat = create_features(S.prepared(spark, sf))
    return P.target_correlation(feat, S.TARGET, IMPORTANCE_FEATURES, k=20)


_TYPES = {"City": "string", "CountyOrParish": "string"}


@query("column_profile", with_ctes() + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i + 1} AS ordinal, '{_TYPES.get(c, 'double')}' AS data_type, "
    f"count(*) - count({c}) AS missing_count, count(DISTINCT {c}) AS distinct_count FROM prep"
    for i, c in enumerate(PROFILE_COLS)))
def column_profile(spark, sf):
    """Name, type, missing and distinct counts per column, one aggregate."""
    return P.column_profile(S.prepared(spark, sf), PROFILE_COLS)


@query("band_counts", with_ctes("""bands AS (SELECT * FROM (VALUES ('Under $500K', 1), ('$500K-$1M', 2),
  ('$1M-$2M', 3), ('$2M-$5M', 4), ('$5M+', 5)) t(PriceBand, BandOrder)),
tb AS (SELECT """ + BAND_LABEL.format(a="ClosePrice") + """ AS PriceBand FROM test)""") + """
SELECT bands.PriceBand, bands.BandOrder, count(tb.PriceBand) AS ObservationCount
FROM bands LEFT JOIN tb ON bands.PriceBand = tb.PriceBand GROUP BY 1, 2""")
def band_counts(spark, sf):
    """Test rows per actual-price band, zero-count bands kept."""
    _, test = S.train_test(spark, sf)
    banded = M.price_bands(test, "ClosePrice")
    return P.category_counts(banded, M.band_dimension(spark).drop("LowerBound", "UpperBound"),
                             "PriceBand", "BandOrder")


@query("prediction_range", with_ctes() + """
SELECT Model, round(least(min(ActualClosePrice), min(PredictedClosePrice)), 4) AS range_min,
  round(greatest(max(ActualClosePrice), max(PredictedClosePrice)), 4) AS range_max FROM preds GROUP BY Model""")
def prediction_range(spark, sf):
    """Joint min/max of actual and predicted per predictor (plot bounds)."""
    return P.prediction_range(S.predictions(spark, sf), "ActualClosePrice", "PredictedClosePrice", ["Model"])


@query("scatter_grid", with_ctes("""rg AS (SELECT Model, least(min(ActualClosePrice), min(PredictedClosePrice)) AS lo,
  greatest(max(ActualClosePrice), max(PredictedClosePrice)) AS hi FROM preds GROUP BY Model)""") + """
SELECT p.Model,
  CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((ActualClosePrice - lo) * 20 / (hi - lo)), 19) END AS INTEGER) AS x_bin,
  CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((PredictedClosePrice - lo) * 20 / (hi - lo)), 19) END AS INTEGER)
    AS y_bin, count(*) AS count
FROM preds p JOIN rg ON p.Model = rg.Model GROUP BY 1, 2, 3""")
def scatter_grid(spark, sf):
    """Actual-vs-predicted point cloud as a 20 x 20 count grid per predictor."""
    return P.scatter_grid(S.predictions(spark, sf), "ActualClosePrice", "PredictedClosePrice", 20, ["Model"])


# -- errors and bands --------------------------------------------------------------------

@query("prediction_errors", with_ctes() + f"""
SELECT l_orderkey, l_linenumber, ActualClosePrice, round(PredictedClosePrice, 4) AS PredictedClosePrice,
  round(ActualClosePrice - PredictedClosePrice, 4) AS Residual,
  round(abs(ActualClosePrice - PredictedClosePrice), 4) AS AbsoluteError,
  round(abs(ActualClosePrice - PredictedClosePrice) / nullif(ActualClosePrice, 0) * 100, 6)
    AS AbsolutePercentageError
FROM preds WHERE Model = '{OLS}'""")
def prediction_errors(spark, sf):
    """Residual, absolute and absolute-% error of each OLS test prediction."""
    e = M.prediction_errors(S.predictions(spark, sf, OLS))
    r4 = ["PredictedClosePrice", "Residual", "AbsoluteError"]
    return e.select(*ID, "ActualClosePrice", *[F.round(c, 4).alias(c) for c in r4],
                    F.round("AbsolutePercentageError", 6).alias("AbsolutePercentageError"))


@query("price_bands", with_ctes() + f"""
SELECT l_orderkey, l_linenumber, ClosePrice, {BAND_LABEL.format(a='ClosePrice')} AS PriceBand,
  {BAND_ORDER.format(a='ClosePrice')} AS BandOrder FROM test""")
def price_bands(spark, sf):
    """Fixed half-open price bands of the test rows."""
    _, test = S.train_test(spark, sf)
    return M.price_bands(test.select(*ID, "ClosePrice"), "ClosePrice")


@query("largest_errors", with_ctes() + f"""
SELECT l_orderkey, l_linenumber, ActualClosePrice, round(PredictedClosePrice, 4) AS PredictedClosePrice,
  round(abs(ActualClosePrice - PredictedClosePrice), 4) AS AbsoluteError
FROM preds WHERE Model = '{OLS}'
ORDER BY abs(ActualClosePrice - PredictedClosePrice) DESC, {KEYS} LIMIT 20""")
def largest_errors(spark, sf):
    """The 20 largest absolute OLS errors (per-partition top-k, then merge)."""
    e = M.prediction_errors(S.predictions(spark, sf, OLS))
    top = R.top_k(e, 20, [F.col("AbsoluteError").desc(), *S.LINEITEM_KEYS])
    return top.select(*ID, "ActualClosePrice", F.round("PredictedClosePrice", 4).alias("PredictedClosePrice"),
                      F.round("AbsoluteError", 4).alias("AbsoluteError"))


@query("best_worst_band", with_ctes(_BANDED, f"""bm AS (SELECT PriceBand, round(avg(CASE WHEN ActualClosePrice <> 0
  THEN abs((ActualClosePrice - PredictedClosePrice) / ActualClosePrice) END) * 100, 6) AS MAPE
  FROM banded WHERE Model = '{OLS}' AND PriceBand IS NOT NULL GROUP BY PriceBand)""") + """
SELECT arg_min(PriceBand, MAPE) AS Best, arg_max(PriceBand, MAPE) AS Worst, min(MAPE) AS BestMAPE,
  max(MAPE) AS WorstMAPE FROM bm""")
def best_worst_band(spark, sf):
    """Band with the lowest and the highest MAPE for the OLS predictor."""
    bands = M.metrics_by_band(S.predictions(spark, sf, OLS))
    return R.best_and_worst(bands, "PriceBand", "MAPE")


# -- leaderboards ------------------------------------------------------------------------

@query("metrics_by_model", with_ctes(_VAL) + "SELECT * FROM vm")
def metrics_by_model(spark, sf):
    """Validation metrics of the three predictors (fit on the first 80 % of train)."""
    return _validation_metrics(spark, sf)


@query("leaderboard_r2", with_ctes(_VAL) + """
SELECT *, row_number() OVER (ORDER BY R2 DESC NULLS LAST, Model) AS Rank FROM vm""")
def leaderboard_r2(spark, sf):
    """Validation leaderboard by R2, descending."""
    return R.leaderboard(_validation_metrics(spark, sf), "R2", ascending=False)


@query("leaderboard_rmse", with_ctes(_VAL) + """
SELECT *, row_number() OVER (ORDER BY RMSE ASC NULLS LAST, R2 DESC NULLS LAST, Model) AS Rank FROM vm""")
def leaderboard_rmse(spark, sf):
    """Validation leaderboard by RMSE ascending, then R2 descending."""
    return R.leaderboard(_validation_metrics(spark, sf), "RMSE", ascending=True, second=("R2", False))


@query("select_best_model", with_ctes(_VAL) + """
SELECT Model AS BestModel FROM vm ORDER BY RMSE, R2 DESC, Model LIMIT 1""")
def select_best_model(spark, sf):
    """The model with the lowest validation RMSE (never selected on test)."""
    return R.select_best(_validation_metrics(spark, sf), "Model", "RMSE", True, "R2")


@query("best_vs_second", with_ctes(_VAL, """o AS (SELECT *, row_number() OVER (ORDER BY RMSE, Model) AS rn,
  lead(Model) OVER (ORDER BY RMSE, Model) AS RunnerUp, lead(RMSE) OVER (ORDER BY RMSE, Model) AS nx_rmse,
  lead(MAE) OVER (ORDER BY RMSE, Model) AS nx_mae, lead(R2) OVER (ORDER BY RMSE, Model) AS nx_r2 FROM vm)""") + """
SELECT Model AS Best, RunnerUp, round(RMSE - nx_rmse, 6) AS RMSEDelta, round(MAE - nx_mae, 6) AS MAEDelta,
  round(R2 - nx_r2, 6) AS R2Delta FROM o WHERE rn = 1""")
def best_vs_second(spark, sf):
    """Best model minus the runner-up on RMSE, MAE and R2."""
    return R.best_vs_second(_validation_metrics(spark, sf))


@query("model_slug", with_ctes() + """
SELECT DISTINCT Model, lower(replace(replace(Model, ' ', '_'), '-', '_')) || '_prediction' AS prediction_column,
  lower(replace(replace(Model, ' ', '_'), '-', '_')) || '_absolute_error' AS error_column FROM preds""")
def model_slug(spark, sf):
    """Report column names derived from model names."""
    train, test = S.train_test(spark, sf)
    names = spark.createDataFrame([(m,) for m in S.prediction_columns(train)], "Model string")
    m = names if not test.isEmpty() else names.limit(0)  # no row, no prediction, no model
    return m.select("Model", slug("Model", "_prediction").alias("prediction_column"),
                    slug("Model", "_absolute_error").alias("error_column"))


@query("format_leaderboard", with_ctes(_VAL) + """
SELECT Model, '$' || format('{:,.2f}', MAE) AS MAE, '$' || format('{:,.2f}', RMSE) AS RMSE,
  format('{:.2f}', MAPE) || '%' AS MAPE, format('{:.2f}', MdAPE) || '%' AS MdAPE, format('{:.4f}', R2) AS R2
FROM vm""")
def format_leaderboard(spark, sf):
    """Validation leaderboard as display strings ($#,##0.00, 0.00%, 0.0000)."""
    m = _validation_metrics(spark, sf)
    return m.select("Model", format_money("MAE").alias("MAE"), format_money("RMSE").alias("RMSE"),
                    format_percent("MAPE").alias("MAPE"), format_percent("MdAPE").alias("MdAPE"),
                    format_ratio("R2").alias("R2"))


@query("evaluation_summary", with_ctes(_VAL, """best AS (SELECT Model FROM vm ORDER BY RMSE, R2 DESC, Model LIMIT 1),
tm AS (SELECT Model, """ + metrics_select() + """ FROM preds WHERE Model = (SELECT Model FROM best) GROUP BY Model)""")
       + """
SELECT 'test' AS EvaluationSet, Model AS SelectedModel, MAE, RMSE, MAPE, MdAPE, R2,
  (SELECT count(*) FROM train) AS TrainRows, ObservationCount AS TestRows, 1 AS FeatureCount FROM tm""")
def evaluation_summary(spark, sf):
    """Winner chosen on validation, then scored once on test: one summary row."""
    best = R.select_best(_validation_metrics(spark, sf), "Model", "RMSE", True, "R2")
    train, _ = S.train_test(spark, sf)
    tm = M.regression_metrics(S.predictions(spark, sf).join(
        F.broadcast(best.withColumnRenamed("BestModel", "Model")), "Model", "left_semi"), group_cols=["Model"])
    n_train = train.count()
    return tm.select(
        F.lit("test").alias("EvaluationSet"), F.col("Model").alias("SelectedModel"), *M.METRIC_COLUMNS,
        F.lit(n_train).cast("long").alias("TrainRows"), F.col("ObservationCount").alias("TestRows"),
        F.lit(1).alias("FeatureCount"))


@query("select_best_by_set", with_ctes(_VAL, "tm AS (SELECT Model, " + metrics_select() + " FROM preds GROUP BY Model)") + """
SELECT 'validation' AS EvaluationSet, (SELECT Model FROM vm ORDER BY RMSE, R2 DESC, Model LIMIT 1) AS BestModel
UNION ALL SELECT 'test', (SELECT Model FROM tm ORDER BY RMSE, R2 DESC, Model LIMIT 1)""")
def select_best_by_set(spark, sf):
    """The best model of each evaluation set, chosen among that set's rows only."""
    both = _validation_metrics(spark, sf).withColumn("EvaluationSet", F.lit("validation")).unionByName(
        M.regression_metrics(S.predictions(spark, sf), group_cols=["Model"]).withColumn("EvaluationSet", F.lit("test")))
    return U.union_all([R.select_best(both, "Model", "RMSE", True, "R2", selection_set=name)
                        .select(F.lit(name).alias("EvaluationSet"), "BestModel") for name in ("validation", "test")])


# -- importances --------------------------------------------------------------------------

@query("union_importances", with_ctes(_ENG_SQL, _IMP_RAW, _IMP) + "SELECT * FROM imp")
def union_importances(spark, sf):
    """Per-model importance tables stacked into one (UNION ALL by name)."""
    return U.union_all(_importances(spark, sf))


@query("importance_rank", with_ctes(_ENG_SQL, _IMP_RAW, _IMP) + """
SELECT *, row_number() OVER (PARTITION BY Model ORDER BY Importance DESC, Feature) AS Rank FROM imp""")
def importance_rank(spark, sf):
    """Rank of each feature within its model (importance descending, name tie-break)."""
    imp = U.union_all(_importances(spark, sf))
    return R.rank_within(imp, ["Model"], [F.desc("Importance"), "Feature"])


@query("importance_topn", with_ctes(_ENG_SQL, _IMP_RAW, _IMP) + """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Model ORDER BY Importance DESC, Feature) AS Rank FROM imp)
WHERE Rank <= 5""")
def importance_topn(spark, sf):
    """Top five features per model."""
    imp = U.union_all(_importances(spark, sf))
    return R.top_n_per_group(imp, ["Model"], [F.desc("Importance"), "Feature"], 5)


@query("importance_one_model", with_ctes(_ENG_SQL, _IMP_RAW, _IMP) + """
SELECT * FROM imp WHERE Model = (SELECT min(Model) FROM imp) ORDER BY Importance DESC, Feature LIMIT 5""")
def importance_one_model(spark, sf):
    """Top five features of one model: its rows first, then top-k."""
    imp = U.union_all(_importances(spark, sf))
    first = imp.agg(F.min("Model")).first()[0]
    return R.top_k(imp.where(F.col("Model") == first), 5, [F.desc("Importance"), "Feature"])


@query("semi_filter_features", with_ctes(_ENG_SQL, _IMP_RAW, _IMP) + "SELECT * FROM imp WHERE Feature IN ("
       + ", ".join(f"'{f}'" for f in ENGINEERED) + ")")
def semi_filter_features(spark, sf):
    """Importances of the engineered features only (semi-join with the feature list)."""
    imp = U.union_all(_importances(spark, sf))
    wanted = spark.createDataFrame([(f,) for f in ENGINEERED], "Feature string")
    return imp.join(F.broadcast(wanted), "Feature", "left_semi").select("Model", "Feature", "Importance")


@query("top_coefficients", with_ctes(_ENG_SQL, "co AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS Feature, regr_slope(ClosePrice, {f}) AS Coefficient FROM feat" for f in IMPORTANCE_FEATURES)
    + ")") + """
SELECT Feature, round(Coefficient, 6) AS Coefficient FROM co WHERE Coefficient IS NOT NULL
ORDER BY abs(Coefficient) DESC, Feature LIMIT 10""")
def top_coefficients(spark, sf):
    """Ten largest one-feature least-squares slopes by absolute value."""
    train, _ = S.train_test(spark, sf)
    feat = create_features(train)
    co = feat.agg(*[F.regr_slope(S.TARGET, f).alias(f"_c{i}") for i, f in enumerate(IMPORTANCE_FEATURES)])
    long = co.select(F.explode(F.array(*[F.struct(F.lit(f).alias("Feature"), F.col(f"_c{i}").alias("Coefficient"))
                                         for i, f in enumerate(IMPORTANCE_FEATURES)])).alias("_s")).select("_s.*")
    top = R.top_abs(long.where(F.col("Coefficient").isNotNull()), "Coefficient", 10, "Feature")
    return top.select("Feature", F.round("Coefficient", 6).alias("Coefficient"))


# -- wide predictions and comparisons -------------------------------------------------------

@query("wide_predictions", with_ctes() + f"""
SELECT l_orderkey, l_linenumber, max(ActualClosePrice) AS ActualClosePrice,
  round(max(CASE WHEN Model = 'List Price' THEN PredictedClosePrice END), 4) AS list_price_prediction,
  round(max(CASE WHEN Model = 'List Price' THEN abs(ActualClosePrice - PredictedClosePrice) END), 4)
    AS list_price_absolute_error,
  round(max(CASE WHEN Model = 'OLS List Price' THEN PredictedClosePrice END), 4) AS ols_list_price_prediction,
  round(max(CASE WHEN Model = 'OLS List Price' THEN abs(ActualClosePrice - PredictedClosePrice) END), 4)
    AS ols_list_price_absolute_error,
  round(max(CASE WHEN Model = 'Train Mean' THEN PredictedClosePrice END), 4) AS train_mean_prediction,
  round(max(CASE WHEN Model = 'Train Mean' THEN abs(ActualClosePrice - PredictedClosePrice) END), 4)
    AS train_mean_absolute_error
FROM preds GROUP BY {KEYS}""")
def wide_predictions(spark, sf):
    """One row per test listing: actual, then prediction and absolute error per model."""
    train, test = S.train_test(spark, sf)
    w = S.wide_sql_predictions(train, test)
    vals = [c for c in w.columns if c.endswith(("_prediction", "_absolute_error"))]
    return w.select(*ID, "ActualClosePrice", *[F.round(c, 4).alias(c) for c in vals])


@query("improvement_summary", with_ctes(_FS) + "SELECT * FROM fs_imp")
def improvement_summary(spark, sf):
    """Original vs engineered feature set (same OLS learner) with signed improvements."""
    m = M.regression_metrics(S.feature_set_predictions(spark, sf), group_cols=["FeatureSet"], rounded=True)
    return U.improvement_summary(m, "FeatureSet", "Original", "Engineered")


@query("improvement_verdict", with_ctes(_FS) + """
SELECT max(CASE WHEN Metric = 'MAE' THEN Improvement END) AS MAEImprovement,
  max(CASE WHEN Metric = 'R2' THEN Improvement END) AS R2Improvement,
  coalesce(max(CASE WHEN Metric = 'MAE' THEN Improvement END) > 0
    AND max(CASE WHEN Metric = 'R2' THEN Improvement END) > 0, false) AS Improved,
  CASE WHEN max(CASE WHEN Metric = 'MAE' THEN Improvement END) > 0
    AND max(CASE WHEN Metric = 'R2' THEN Improvement END) > 0
    THEN 'engineered features improved the model' ELSE 'engineered features did not improve the model' END
    AS Verdict FROM fs_imp""")
def improvement_verdict(spark, sf):
    """Improved iff both the MAE gain and the R2 gain are positive."""
    return U.improvement_verdict(improvement_summary(spark, sf))


# -- quality gates -----------------------------------------------------------------------------

_GATE_COLS = ["ClosePrice", *S.NUMERIC_FILL, *S.CATEGORICAL]


def _gates_sql(src):
    preds = [c for c in _GATE_COLS if c != "ClosePrice"]
    dbl = [c for c in _GATE_COLS if c not in S.CATEGORICAL]
    parts = [f"SELECT 'required_columns' AS rule, '{src}' AS dataset, CAST(NULL AS VARCHAR) AS column, "
             f"CAST(0 AS BIGINT) AS violations",
             f"SELECT 'not_empty', '{src}', NULL, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM {src}",
             f"SELECT 'target_not_missing', '{src}', 'ClosePrice', count(*) - count(ClosePrice) FROM {src}"]
    parts += [f"SELECT 'predictor_not_missing', '{src}', '{c}', count(*) - count({c}) FROM {src}" for c in preds]
    parts += [f"SELECT 'finite_values', '{src}', '{c}', count(CASE WHEN abs({c}) = 'Infinity'::DOUBLE THEN 1 END) "
              f"FROM {src}" for c in dbl]
    return " UNION ALL ".join(parts)


@query("quality_gates", with_ctes() + _gates_sql("train") + " UNION ALL " + _gates_sql("test"))
def quality_gates(spark, sf):
    """Rule table (required, not empty, no missing target/predictors, finite) for both splits."""
    train, test = S.train_test(spark, sf)
    out = []
    for name, d in (("train", train), ("test", test)):
        out.append(V.quality_rules(d.select(*_GATE_COLS), name, required=_GATE_COLS, target="ClosePrice"))
    return U.union_all(out)


_FILLED_COLS = ", ".join(
    ["ClosePrice"] + [f"coalesce({c}, (SELECT coalesce(median({c}), 0.0) FROM train)) AS {c}" for c in S.NUMERIC_FILL]
    + [f"coalesce({c}, (SELECT coalesce(mode({c}), 'Unknown') FROM train)) AS {c}" for c in S.CATEGORICAL])


@query("quality_gates_filled", with_ctes(*[f"filled_{d} AS (SELECT {_FILLED_COLS} FROM {d})" for d in ("train", "test")])
       + f"""
SELECT replace(dataset, 'filled_', '') AS dataset, CAST(sum(violations) AS BIGINT) AS violations
FROM ({_gates_sql("filled_train")} UNION ALL {_gates_sql("filled_test")}) GROUP BY 1""")
def quality_gates_filled(spark, sf):
    """After train-only median and mode fills every rule passes (violations per dataset)."""
    train, test = S.train_test(spark, sf)
    med = fit_medians(train, S.NUMERIC_FILL)
    modes = fit_modes(train, S.CATEGORICAL)
    out = []
    for name, d in (("train", train), ("test", test)):
        filled = apply_fill(apply_fill(d.select(*_GATE_COLS), med), modes)
        r = V.quality_rules(filled, name, required=_GATE_COLS, target="ClosePrice")
        out.append(r.groupBy("dataset").agg(F.sum("violations").cast("long").alias("violations")))
    return U.union_all(out)


_DICT_SQL = "fdict AS (SELECT * FROM (VALUES " + ", ".join(
    "('" + f + "', '" + d + "')" for f, d in FEATURE_DESCRIPTIONS) + ") t(Feature, Description))"


@query("importance_described", with_ctes(_ENG_SQL, _IMP_RAW, _IMP, _DICT_SQL) + """
SELECT imp.Model, imp.Feature, imp.Importance, fdict.Description
FROM imp LEFT JOIN fdict ON imp.Feature = fdict.Feature""")
def importance_described(spark, sf):
    """Importances with the feature dictionary joined in (base features have none)."""
    imp = U.union_all(_importances(spark, sf))
    # The dictionary has 14 rows by definition.
    return imp.join(F.broadcast(feature_dictionary(spark)), "Feature", "left").select(
        "Model", "Feature", "Importance", "Description")


@query("report_files", with_ctes(_VAL, _BANDED) + f"""
SELECT 'price_band_metrics' AS report, count(DISTINCT PriceBand) AS rows FROM banded
WHERE Model = '{OLS}' AND PriceBand IS NOT NULL
UNION ALL SELECT 'validation_leaderboard', count(*) FROM vm""")
def report_files(spark, sf):
    """Write the band metrics and the leaderboard as single-file CSV reports, read them back."""
    out = []
    for name, df in (("price_band_metrics", M.metrics_by_band(S.predictions(spark, sf, OLS))),
                     ("validation_leaderboard", R.leaderboard(_validation_metrics(spark, sf), "RMSE", ascending=True,
                                                              second=("R2", False)))):
        path = scratch_path(spark, name)
        files.write_report(df, path)
        back = files.guarded_read(spark, path, fmt="csv")
        out.append(back.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("report"), "rows"))
    return U.union_all(out)


@query("report_contents", with_ctes(_BANDED) + f"""
SELECT PriceBand, BandOrder, {metrics_select()}
FROM banded WHERE Model = '{OLS}' AND PriceBand IS NOT NULL GROUP BY PriceBand, BandOrder""")
def report_contents(spark, sf):
    """The band metrics as a CSV report, read back in full."""
    bands, path = M.metrics_by_band(S.predictions(spark, sf, OLS)), scratch_path(spark, "band_report")
    files.write_report(bands, path)
    return files.guarded_read(spark, path, fmt="csv", schema=bands.schema)
