"""DuckDB-dialect SQL for the independent correctness oracle.

Each query in ``catalog`` has a SQL twin here, written directly against the
driver tables (the ``sales`` view is inlined as a CTE).  The SQL is the
specification a reader can check by eye; the Spark side is written with the
DataFrame API, so the two implementations are independent.
"""

from __future__ import annotations

KEYS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
        "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")

SALES = f"""sales AS (
  SELECT l_extendedprice * 60 AS ListPrice,
         l_extendedprice * 60 * (1 - l_discount) * (1 + l_tax) AS ClosePrice,
         CASE WHEN p_size % 17 = 0 THEN NULL ELSE CAST(p_size * 80 AS DOUBLE) END AS LivingArea,
         CAST(l_linenumber AS DOUBLE) AS BedroomsTotal,
         CAST(floor(l_quantity / 12) AS DOUBLE) AS BathroomsTotalInteger,
         CASE WHEN CAST(l_quantity AS INTEGER) % 9 = 0 THEN NULL ELSE o_totalprice / 25 END AS LotSizeSquareFeet,
         CASE WHEN l_linenumber = 7 AND p_size % 5 = 0 THEN NULL
              ELSE CAST(year(o_orderdate) - p_size + 3 AS DOUBLE) END AS YearBuilt,
         CASE WHEN p_brand = 'Brand#13' THEN NULL ELSE p_brand END AS City,
         n_name AS CountyOrParish,
         l_shipdate AS CloseDate,
         CASE WHEN o_orderstatus = 'P' THEN 'Land' ELSE 'Residential' END AS PropertyType,
         CASE WHEN l_returnflag = 'R' THEN 'Condominium' ELSE 'SingleFamilyResidence' END AS PropertySubType,
         CASE WHEN p_size = 1 THEN p_type END AS ElementarySchool,
         {KEYS}
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)"""

SEG = """seg AS (SELECT * FROM sales
  WHERE PropertyType = 'Residential' AND PropertySubType = 'SingleFamilyResidence')"""

PREP = f"""prep AS (SELECT ClosePrice, LivingArea, BedroomsTotal, BathroomsTotalInteger, LotSizeSquareFeet,
  City, CountyOrParish, ListPrice, CloseDate, {KEYS},
  CAST(year(CloseDate) AS DOUBLE) - YearBuilt AS PropertyAge FROM seg)"""

SPLIT = """train AS (SELECT * FROM prep WHERE CloseDate < TIMESTAMP '2001-01-01'),
test AS (SELECT * FROM prep WHERE CloseDate >= TIMESTAMP '2001-01-01')"""

PREDS = f"""fit AS (SELECT regr_slope(ClosePrice, ListPrice) AS slope,
  regr_intercept(ClosePrice, ListPrice) AS intercept, avg(ClosePrice) AS mean FROM train),
preds AS (
  SELECT 'List Price' AS Model, {KEYS}, ClosePrice AS ActualClosePrice, ListPrice AS PredictedClosePrice FROM test
  UNION ALL
  SELECT 'OLS List Price', {KEYS}, ClosePrice, intercept + slope * ListPrice FROM test, fit
  UNION ALL
  SELECT 'Train Mean', {KEYS}, ClosePrice, mean FROM test, fit)"""

BASE = f"WITH {SALES},\n{SEG},\n{PREP},\n{SPLIT},\n{PREDS}"


def with_ctes(*extra: str) -> str:
    """The base CTE chain plus extra named CTEs (each ``name AS (...)``)."""
    return BASE + "".join(",\n" + e for e in extra)


BAND_LABEL = """CASE WHEN {a} < 500000 THEN 'Under $500K'
  WHEN {a} >= 500000 AND {a} < 1000000 THEN '$500K-$1M'
  WHEN {a} >= 1000000 AND {a} < 2000000 THEN '$1M-$2M'
  WHEN {a} >= 2000000 AND {a} < 5000000 THEN '$2M-$5M'
  WHEN {a} >= 5000000 AND {a} < 'Infinity'::DOUBLE THEN '$5M+' END"""

BAND_ORDER = """CASE WHEN {a} < 500000 THEN 1
  WHEN {a} >= 500000 AND {a} < 1000000 THEN 2
  WHEN {a} >= 1000000 AND {a} < 2000000 THEN 3
  WHEN {a} >= 2000000 AND {a} < 5000000 THEN 4
  WHEN {a} >= 5000000 AND {a} < 'Infinity'::DOUBLE THEN 5 END"""


def metrics_select(a: str = "ActualClosePrice", p: str = "PredictedClosePrice") -> str:
    e = f"({a} - {p})"
    ape = f"CASE WHEN {a} <> 0 THEN abs({e} / {a}) END"
    return (f"count(*) AS ObservationCount, round(avg(abs({e})), 4) AS MAE, "
            f"round(sqrt(avg({e} * {e})), 4) AS RMSE, round(avg({ape}) * 100, 6) AS MAPE, "
            f"round(median({ape}) * 100, 6) AS MdAPE, "
            f"round(CASE WHEN count({a}) < 2 THEN NULL WHEN var_pop({a}) * count({a}) = 0 "
            f"THEN CASE WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END "
            f"ELSE 1 - sum({e} * {e}) / (var_pop({a}) * count({a})) END, 6) + 0.0 AS R2")
