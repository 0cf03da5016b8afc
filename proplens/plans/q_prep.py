"""Queries: sources and sinks, filter/projection, coercion, missing data, encoding, splits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from proplens.operators import clean, encode, split
from proplens.plans import stages as S
from proplens.plans.catalog import query
from proplens.plans.oracle import KEYS, with_ctes
from proplens.session import scratch_path
from proplens.sources import files
from proplens.sources.tables import FEED_COLUMNS, LINEITEM_KEYS

DAY = "yyyy-MM-dd"
ID = ["l_orderkey", "l_linenumber"]


# -- sources and sinks ---------------------------------------------------------

@query("scan_union_months", with_ctes() + """
SELECT strftime(CloseDate, '%Y%m') AS CloseMonth, count(*) AS rows,
       round(avg(ClosePrice), 4) AS avg_close_price, count(City) AS city_rows
FROM seg GROUP BY 1""")
def scan_union_months(spark, sf):
    """Write the segment as one CSV folder per close month, scan the month list back, union."""
    root = scratch_path(spark, "monthly_feed")
    seg = S.segment(spark, sf).withColumn("CloseMonth", F.date_format("CloseDate", "yyyyMM"))
    files.write_csv(seg.select(*S.CORE_COLUMNS, "CloseMonth"), root, partition_by=["CloseMonth"])
    # The month list is calendar-sized.
    months = [r[0] for r in seg.select("CloseMonth").distinct().orderBy("CloseMonth").collect()]
    feed = files.scan_months(spark, [f"{root}/CloseMonth={m}" for m in months], base_path=root,
                             schema=files.CORE_SCHEMA)
    return feed.groupBy(F.col("CloseMonth").cast("string").alias("CloseMonth")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("ClosePrice"), 4).alias("avg_close_price"),
        F.count("City").alias("city_rows"))


DRIFT_MONTH = "199801"
DRIFT_DAY = f"{DRIFT_MONTH[:4]}-{DRIFT_MONTH[4:]}-01"


@query("scan_drifting_months", with_ctes() + f"""
SELECT strftime(CloseDate, '%Y%m') AS CloseMonth, count(*) AS rows,
       count(CASE WHEN strftime(CloseDate, '%Y%m') >= '{DRIFT_MONTH}' THEN ElementarySchool END) AS school_rows,
       count(City) AS city_rows
FROM seg GROUP BY 1""")
def scan_drifting_months(spark, sf):
    """Months before the layout change lack a column; the union fills it with NULL."""
    root = scratch_path(spark, "monthly_feed_layouts")
    seg = S.segment(spark, sf).withColumn("CloseMonth", F.date_format("CloseDate", "yyyyMM"))
    # By day, not by month's text: the scans skip what lies on the other side.
    old, new = split.split_by_date(seg, "CloseDate", DRIFT_DAY)
    files.write_csv(old.select(*S.CORE_COLUMNS, "CloseMonth"), f"{root}/old", partition_by=["CloseMonth"])
    files.write_csv(new.select(*S.CORE_COLUMNS, "ElementarySchool", "CloseMonth"), f"{root}/new", partition_by=["CloseMonth"])
    # The month list is calendar-sized; a day's text is made once, not for every row.
    days = seg.groupBy("CloseDate").agg(F.count(F.lit(1))).withColumn("CloseMonth", F.date_format("CloseDate", "yyyyMM"))
    months = [r[0] for r in days.select("CloseMonth").distinct().where("CloseMonth IS NOT NULL").collect()]
    old_paths = [f"{root}/old/CloseMonth={m}" for m in sorted(months) if m < DRIFT_MONTH]
    new_paths = [f"{root}/new/CloseMonth={m}" for m in sorted(months) if m >= DRIFT_MONTH]
    new_schema = T.StructType([*files.CORE_SCHEMA.fields, T.StructField("ElementarySchool", T.StringType())])
    feed = files.scan_layouts(spark, [(old_paths, files.CORE_SCHEMA), (new_paths, new_schema)])
    month = F.date_format("CloseDate", "yyyyMM")
    return feed.groupBy(month.alias("CloseMonth")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("ElementarySchool").alias("school_rows"),
        F.count("City").alias("city_rows"))


@query("scan_reordered_months", with_ctes("""told AS (SELECT *, City || ', "' || CountyOrParish || '"' || chr(10)
  || 'line two' AS Told, CAST(strftime(CloseDate, '%m') AS INTEGER) % 3 AS side FROM seg)""") + """
SELECT strftime(CloseDate, '%Y%m') AS CloseMonth, count(*) AS rows, round(avg(ClosePrice), 4) AS avg_close_price,
  count(DISTINCT Told) AS cities, min(Told) AS first_city, max(Told) AS last_city,
  count(CASE WHEN side < 2 THEN LivingArea END) AS living_area_rows, round(sum(YearBuilt), 2) AS years
FROM told GROUP BY 1""")
def scan_reordered_months(spark, sf):
    """Months in three column orders, one without LivingArea, with commas, quotes and line breaks in City."""
    root = scratch_path(spark, "reordered_feed")
    city = F.concat("City", F.lit(', "'), "CountyOrParish", F.lit('"\nline two'))
    seg = S.segment(spark, sf).select(*S.CORE_COLUMNS).withColumn("City", city)
    orders = [S.CORE_COLUMNS, S.CORE_COLUMNS[::-1], sorted(c for c in S.CORE_COLUMNS if c != "LivingArea")]
    for i, order in enumerate(orders):
        files.write_csv(seg.filter(F.month("CloseDate") % 3 == i).select(*order), f"{root}/order{i}")
    feed = files.scan_feed(spark, root).rows
    return feed.groupBy(F.date_format("CloseDate", "yyyyMM").alias("CloseMonth")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("ClosePrice"), 4).alias("avg_close_price"),
        F.count_distinct("City").alias("cities"), F.min("City").alias("first_city"), F.max("City").alias("last_city"),
        F.count("LivingArea").alias("living_area_rows"), F.round(F.sum("YearBuilt"), 2).alias("years"))


@query("sink_roundtrip", with_ctes("""sides AS (SELECT 'train' AS split, * FROM train
  UNION ALL SELECT 'test', * FROM test)""") + """
SELECT split, count(*) AS rows, round(avg(ClosePrice), 4) AS avg_close_price,
       round(avg(PropertyAge), 6) AS avg_property_age, count(LivingArea) AS living_area_rows
FROM sides GROUP BY split""")
def sink_roundtrip(spark, sf):
    """Write train and test to parquet, read them back, aggregate."""
    train, test = S.train_test(spark, sf)
    out = {}
    for name, d in (("train", train), ("test", test)):
        path = scratch_path(spark, f"processed_{name}")
        files.write_table(d, path)
        out[name] = files.guarded_read(spark, path, hint=f"run the {name} preparation first") \
            .withColumn("split", F.lit(name))
    both = out["train"].unionByName(out["test"])
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("ClosePrice"), 4).alias("avg_close_price"),
        F.round(F.avg("PropertyAge"), 6).alias("avg_property_age"),
        F.count("LivingArea").alias("living_area_rows"))


@query("preview_rows", with_ctes() + f"""
SELECT ClosePrice, LivingArea, BedroomsTotal, BathroomsTotalInteger, LotSizeSquareFeet, YearBuilt,
       City, CountyOrParish, ListPrice, strftime(CloseDate, '%Y-%m-%d') AS CloseDay, l_orderkey, l_linenumber
FROM seg ORDER BY CloseDate, {KEYS} LIMIT 5""")
def preview_rows(spark, sf):
    """First five segment rows in (date, full key) order: a deterministic preview."""
    c = S.core(spark, sf)
    top = c.orderBy("CloseDate", *LINEITEM_KEYS).limit(5)
    return top.select(*[x for x in S.CORE_COLUMNS if x != "CloseDate"],
                      F.date_format("CloseDate", DAY).alias("CloseDay"), *ID)


@query("stage_row_counts", with_ctes() + """
SELECT 'sales' AS stage, 1 AS stage_order, count(*) AS rows, 24 AS columns FROM sales
UNION ALL SELECT 'segment', 2, count(*), 24 FROM seg
UNION ALL SELECT 'core', 3, count(*), 21 FROM seg
UNION ALL SELECT 'train', 4, count(*), 21 FROM train
UNION ALL SELECT 'test', 5, count(*), 21 FROM test""")
def stage_row_counts(spark, sf):
    """Rows and columns at each stage of the preparation, from ONE scan of the sales table.

    Every stage is a filter of the same table, so its row count is a
    conditional count in a single aggregate; column counts come from the
    stage schemas.
    """
    sales = S.sales(spark, sf)
    train, test = S.train_test(spark, sf)
    in_seg = F.lit(True)
    for c, v in S.SEGMENT.items():
        in_seg = in_seg & (F.col(c) == F.lit(v))
    cut = F.lit(S.TEST_CUTOFF).cast("timestamp_ntz")
    conds = {"sales": F.lit(True), "segment": in_seg, "core": in_seg,
             "train": in_seg & (F.col(S.DATE_COL) < cut), "test": in_seg & (F.col(S.DATE_COL) >= cut)}
    widths = {"sales": len(sales.columns), "segment": len(S.segment(spark, sf).columns),
              "core": len(S.core(spark, sf).columns), "train": len(train.columns), "test": len(test.columns)}
    counts = sales.agg(*[F.count_if(c).alias(n) for n, c in conds.items()])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("stage"), F.lit(i + 1).alias("stage_order"), F.col(n).alias("rows"),
                 F.lit(widths[n]).alias("columns")) for i, n in enumerate(conds)])).alias("_s")).select("_s.*")


# -- filter / projection -------------------------------------------------------

@query("filter_segment", with_ctes() + """
SELECT l_orderkey, l_linenumber, PropertyType, PropertySubType, ClosePrice FROM seg""")
def filter_segment(spark, sf):
    """Residential single-family rows only."""
    return S.segment(spark, sf).select(*ID, "PropertyType", "PropertySubType", "ClosePrice")


@query("project_core", with_ctes() + """
SELECT ClosePrice, LivingArea, BedroomsTotal, BathroomsTotalInteger, LotSizeSquareFeet, YearBuilt,
       City, CountyOrParish, ListPrice, strftime(CloseDate, '%Y-%m-%d') AS CloseDay FROM seg""")
def project_core(spark, sf):
    """The ten core columns (date shown as a day string)."""
    c = clean.project(S.segment(spark, sf), S.CORE_COLUMNS)
    return c.withColumn("CloseDay", F.date_format("CloseDate", DAY)).drop("CloseDate")


_FEED_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i + 1} AS ordinal, count(*) - count({c}) AS missing_count, "
    f"count(*) AS n FROM seg" for i, c in enumerate(FEED_COLUMNS))


@query("prune_sparse_columns", with_ctes(f"m AS ({_FEED_MISSING})") + """
SELECT column_name, ordinal, missing_count, round(100.0 * missing_count / n, 4) AS missing_pct,
       (100.0 * missing_count / n < 70) AS kept
FROM m""")
def prune_sparse_columns(spark, sf):
    """Which feed columns survive the strict < 70 % missing rule."""
    d = clean.prune_decisions(S.segment(spark, sf), 70.0, FEED_COLUMNS)
    return d.select("column_name", "ordinal", "missing_count", F.round("missing_pct", 4).alias("missing_pct"),
                    "kept")


# -- scalar functions ----------------------------------------------------------

@query("parse_close_date", with_ctes() + """
SELECT CAST(year(CAST(strftime(CloseDate, '%Y-%m-%d') AS TIMESTAMP)) AS BIGINT) AS CloseYear, count(*) AS rows
FROM seg GROUP BY 1""")
def parse_close_date(spark, sf):
    """Parse text dates (as a raw feed holds them) and count rows per close year."""
    txt = S.segment(spark, sf).select(F.date_format("CloseDate", DAY).alias("CloseDate"))
    parsed = clean.parse_timestamp(txt, "CloseDate", "yyyy-MM-dd")
    return parsed.groupBy(F.year("CloseDate").cast("long").alias("CloseYear")).agg(F.count(F.lit(1)).alias("rows"))


@query("property_age", with_ctes() + """
SELECT l_orderkey, l_linenumber, PropertyAge FROM prep""")
def property_age(spark, sf):
    """year(CloseDate) - YearBuilt (YearBuilt dropped)."""
    return S.prepared(spark, sf).select(*ID, "PropertyAge")


_TEXT = """CASE l_linenumber
    WHEN 1 THEN CAST(l_quantity AS VARCHAR) || 'd'
    WHEN 2 THEN ' ' || CAST(l_quantity AS VARCHAR) || ' '
    WHEN 3 THEN 'abc'
    WHEN 4 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'e2'
    WHEN 5 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ',000'
    WHEN 6 THEN 'inf'
    ELSE CAST(l_quantity AS VARCHAR) END"""


@query("coerce_numeric", with_ctes(f"t AS (SELECT l_linenumber, {_TEXT} AS raw FROM seg)",
                                   r"""c AS (SELECT l_linenumber, CASE WHEN regexp_matches(trim(raw),
    '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN TRY_CAST(trim(raw) AS DOUBLE) END AS v FROM t)""")
        + """
SELECT l_linenumber, count(*) AS rows, count(v) AS parsed, round(sum(v), 4) AS total FROM c GROUP BY l_linenumber""")
def coerce_numeric_q(spark, sf):
    """Lenient text -> number over feed-like text (suffixes, spaces, words, exponents)."""
    q = F.col("l_quantity")
    qs = q.cast("string")
    qi = q.cast("long").cast("string")
    raw = (F.when(F.col("l_linenumber") == 1, F.concat(qs, F.lit("d")))
            .when(F.col("l_linenumber") == 2, F.concat(F.lit(" "), qs, F.lit(" ")))
            .when(F.col("l_linenumber") == 3, F.lit("abc"))
            .when(F.col("l_linenumber") == 4, F.concat(qi, F.lit("e2")))
            .when(F.col("l_linenumber") == 5, F.concat(qi, F.lit(",000")))
            .when(F.col("l_linenumber") == 6, F.lit("inf"))
            .otherwise(qs))
    t = S.segment(spark, sf).select("l_linenumber", raw.alias("raw"))
    c = clean.coerce_numeric_columns(t, ["raw"])
    return c.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("rows"), F.count("raw").alias("parsed"),
                                         F.round(F.sum("raw"), 4).alias("total"))


@query("inf_to_null", with_ctes("""r AS (SELECT BathroomsTotalInteger AS baths,
  CASE WHEN BathroomsTotalInteger = 0 THEN 'Infinity'::DOUBLE ELSE ListPrice / BathroomsTotalInteger END AS ratio
  FROM seg)""") + """
SELECT baths, count(*) AS rows, count(CASE WHEN isfinite(ratio) THEN 1 END) AS finite_rows,
       round(avg(CASE WHEN isfinite(ratio) THEN ratio END), 4) AS avg_ratio
FROM r GROUP BY baths""")
def inf_to_null_q(spark, sf):
    """Raw division gives +Inf on a zero denominator; the frame-wide pass turns it into NULL."""
    seg = S.segment(spark, sf)
    ratio = F.when(F.col("BathroomsTotalInteger") == 0, F.lit(float("inf"))) \
             .otherwise(F.col("ListPrice") / F.col("BathroomsTotalInteger"))
    r = clean.inf_to_null(seg.select(F.col("BathroomsTotalInteger").alias("baths"), ratio.alias("ratio")))
    return r.groupBy("baths").agg(F.count(F.lit(1)).alias("rows"), F.count("ratio").alias("finite_rows"),
                                  F.round(F.avg("ratio"), 4).alias("avg_ratio"))


# -- missing data --------------------------------------------------------------

_CORE_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i + 1} AS ordinal, count(*) - count({c}) AS missing_count, "
    f"count(*) AS n FROM seg" for i, c in enumerate(S.CORE_COLUMNS))


@query("missing_percent", with_ctes(f"m AS ({_CORE_MISSING})") + """
SELECT column_name, ordinal, round(100.0 * missing_count / n, 4) AS missing_pct FROM m""")
def missing_percent(spark, sf):
    """Missing % of each core column (one aggregate scan)."""
    s = clean.missing_summary(S.core(spark, sf), S.CORE_COLUMNS)
    return s.select("column_name", "ordinal", F.round("missing_pct", 4).alias("missing_pct"))


@query("missing_topk", with_ctes(f"m AS ({_FEED_MISSING})") + """
SELECT column_name, missing_count FROM m ORDER BY missing_count DESC, column_name LIMIT 20""")
def missing_topk(spark, sf):
    """Top 20 feed columns by missing count."""
    return clean.missing_topk(S.segment(spark, sf), 20, FEED_COLUMNS)


def _fill_sql(src: str, stats_from: str) -> str:
    cols = ", ".join(f"coalesce({c}, (SELECT coalesce(median({c}), 0.0) FROM {stats_from})) AS {c}"
                     for c in S.NUMERIC_FILL)
    return f"SELECT l_orderkey, l_linenumber, {cols} FROM {src}"


@query("impute_median_global", with_ctes() + _fill_sql("prep", "prep"))
def impute_median_global(spark, sf):
    """Median fill with statistics from the whole (pre-split) table."""
    p = S.prepared(spark, sf)
    stats = clean.fit_medians(p, S.NUMERIC_FILL)
    return clean.apply_fill(p.select(*ID, *S.NUMERIC_FILL), stats)


@query("impute_constant", with_ctes() + """
SELECT coalesce(City, 'Unknown') AS City, coalesce(CountyOrParish, 'Unknown') AS CountyOrParish,
       count(*) AS rows FROM prep GROUP BY 1, 2""")
def impute_constant(spark, sf):
    """'Unknown' for missing categoricals, then counts per (City, County)."""
    f = clean.fill_constant(S.prepared(spark, sf), {c: "Unknown" for c in S.CATEGORICAL})
    return f.groupBy(*S.CATEGORICAL).agg(F.count(F.lit(1)).alias("rows"))


@query("impute_median_train", with_ctes() + "SELECT 'train' AS split, * FROM (" + _fill_sql("train", "train")
       + ") UNION ALL SELECT 'test', * FROM (" + _fill_sql("test", "train") + ")")
def impute_median_train(spark, sf):
    """Medians from the train slice only, applied to train and test (leakage-safe)."""
    train, test = S.train_test(spark, sf)
    stats = clean.fit_medians(train, S.NUMERIC_FILL)
    cols = [*ID, *S.NUMERIC_FILL]
    return clean.apply_fill(train.select(*cols), stats).withColumn("split", F.lit("train")).unionByName(
        clean.apply_fill(test.select(*cols), stats).withColumn("split", F.lit("test")))


_MODE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS Column, coalesce((SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM train
        WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1), 'Unknown') AS FillValue"""
    for c in S.CATEGORICAL)


@query("impute_mode_train", with_ctes() + _MODE_SQL)
def impute_mode_train(spark, sf):
    """Most frequent train value per categorical (smallest on ties; none -> 'Unknown')."""
    train, _ = S.train_test(spark, sf)
    return clean.fill_stats_long(clean.fit_modes(train, S.CATEGORICAL), "FillValue")


_MED_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS Column, round(coalesce(median({c}), 0.0), 6) AS FillValue FROM train"
    for c in S.NUMERIC_FILL)


@query("training_medians", with_ctes() + _MED_SQL)
def training_medians(spark, sf):
    """The exported fill values: (column, train median)."""
    train, _ = S.train_test(spark, sf)
    long = clean.fill_stats_long(clean.fit_medians(train, S.NUMERIC_FILL), "FillValue")
    return long.withColumn("FillValue", F.round("FillValue", 6))


# -- encoding ------------------------------------------------------------------

@query("one_hot_wide", with_ctes("""f AS (SELECT coalesce(City, 'Unknown') AS City,
  coalesce(CountyOrParish, 'Unknown') AS CountyOrParish FROM prep)""") + """
SELECT 'City_' || City AS Feature, count(*) AS Ones FROM f
WHERE City > (SELECT min(City) FROM f) GROUP BY City
UNION ALL
SELECT 'CountyOrParish_' || CountyOrParish, count(*) FROM f
WHERE CountyOrParish > (SELECT min(CountyOrParish) FROM f) GROUP BY CountyOrParish""")
def one_hot_wide_q(spark, sf):
    """One-hot of City and County (first sorted level dropped), summed per indicator."""
    f = clean.fill_constant(S.prepared(spark, sf), {c: "Unknown" for c in S.CATEGORICAL})
    wide = encode.one_hot_wide(f.select(*S.CATEGORICAL), S.CATEGORICAL, as_double=False)
    return _indicator_sums(wide)


def _indicator_sums(wide):
    cols = [c for c in wide.columns if c.startswith(("City_", "CountyOrParish_"))]
    sums = wide.agg(*[F.count_if(F.col(c)).alias(f"_s{i}") for i, c in enumerate(cols)])
    return sums.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("Feature"), F.col(f"_s{i}").cast("long").alias("Ones"))
        for i, c in enumerate(cols)])).alias("_x")).select("_x.*")


@query("align_columns", with_ctes("""tr AS (SELECT coalesce(City, 'Unknown') AS City FROM train),
te AS (SELECT coalesce(City, 'Unknown') AS City FROM test),
lv AS (SELECT DISTINCT City FROM tr WHERE City > (SELECT min(City) FROM tr))""") + """
SELECT 'City_' || lv.City AS Feature, count(te.City) AS Ones
FROM lv LEFT JOIN te ON te.City = lv.City GROUP BY lv.City""")
def align_columns_q(spark, sf):
    """Test one-hot columns aligned to the train columns (absent -> 0, extras dropped)."""
    train, test = S.train_test(spark, sf)
    fill = {"City": "Unknown"}
    tr = encode.one_hot_wide(clean.fill_constant(train.select("City"), fill), ["City"])
    te = encode.one_hot_wide(clean.fill_constant(test.select("City"), fill), ["City"])
    aligned = encode.align_columns(tr.columns, te, fill=False)
    return _indicator_sums(aligned)


# -- splits --------------------------------------------------------------------

@query("split_by_date", with_ctes("""sides AS (SELECT 'train' AS split, * FROM train
  UNION ALL SELECT 'test', * FROM test)""") + """
SELECT split, count(*) AS rows, strftime(min(CloseDate), '%Y-%m-%d') AS first_day,
       strftime(max(CloseDate), '%Y-%m-%d') AS last_day FROM sides GROUP BY split""")
def split_by_date_q(spark, sf):
    """Train before the cutoff, test on/after it; NULL dates in neither."""
    train, test = S.train_test(spark, sf)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                     F.date_format(F.min("CloseDate"), DAY).alias("first_day"),
                                     F.date_format(F.max("CloseDate"), DAY).alias("last_day"))


@query("split_chronological", with_ctes(f"""r AS (SELECT *, row_number() OVER (ORDER BY CloseDate, {KEYS}) AS rn,
  count(*) OVER () AS n FROM train)""") + """
SELECT CASE WHEN rn <= n * 4 // 5 THEN 'fit' ELSE 'validation' END AS split, count(*) AS rows,
       strftime(min(CloseDate), '%Y-%m-%d') AS first_day, strftime(max(CloseDate), '%Y-%m-%d') AS last_day,
       round(avg(ClosePrice), 4) AS avg_close_price
FROM r GROUP BY 1""")
def split_chronological_q(spark, sf):
    """First 80 % of train by (date, full key) fits, the last 20 % validates."""
    train, _ = S.train_test(spark, sf)
    fit, val, _ = split.split_chronological(train, "CloseDate", LINEITEM_KEYS, S.VALIDATION_FRACTION)
    both = fit.withColumn("split", F.lit("fit")).unionByName(val.withColumn("split", F.lit("validation")))
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                     F.date_format(F.min("CloseDate"), DAY).alias("first_day"),
                                     F.date_format(F.max("CloseDate"), DAY).alias("last_day"),
                                     F.round(F.avg("ClosePrice"), 4).alias("avg_close_price"))



@query("stream_feed_ingest", with_ctes() + """
SELECT strftime(CloseDate, '%Y%m') AS CloseMonth, count(*) AS rows,
       round(avg(ClosePrice), 4) AS avg_close_price, count(City) AS city_rows
FROM seg GROUP BY 1""")
def stream_feed_ingest(spark, sf):
    """Feed files streamed through the cleaning step into a month-partitioned sink."""
    from proplens.streaming.ingest import start_feed_ingest
    src = scratch_path(spark, "feed_files")
    feed = S.sales(spark, sf).select(*FEED_COLUMNS)
    files.write_table(feed, src)
    sink, ckpt = scratch_path(spark, "feed_sink"), scratch_path(spark, "feed_sink_checkpoint")
    q = start_feed_ingest(spark, src, sink, ckpt, feed.schema)
    q.awaitTermination()
    out = spark.read.parquet(sink)
    return out.groupBy(F.col("CloseMonth").cast("string").alias("CloseMonth")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("ClosePrice"), 4).alias("avg_close_price"),
        F.count("City").alias("city_rows"))
