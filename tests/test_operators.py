"""Operators on hand-sized frames: imputation, encoding, alignment, histogram, metrics, gates."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from proplens.operators import clean, encode, metrics, profile, quality, quantiles, rank, split


def test_median_fill_train_only(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (None,)], "x double")
    test = spark.createDataFrame([(None,)], "x double")
    stats = clean.fit_medians(train, ["x"])
    assert stats.first()["x"] == 3.0
    assert clean.apply_fill(test, stats).first()["x"] == 3.0
    all_null = spark.createDataFrame([(None,), (None,)], "x double")
    assert clean.fit_medians(all_null, ["x"]).first()["x"] == 0.0


def test_median_fill_ignores_test_rows(spark):
    train = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    t1 = spark.createDataFrame([(None,), (1000.0,)], "x double")
    t2 = spark.createDataFrame([(None,), (-5.0,), (7.0,)], "x double")
    stats = clean.fit_medians(train, ["x"])
    a = clean.apply_fill(t1, stats).where(F.col("x") == 5.0).count()
    b = clean.apply_fill(t2, stats).where(F.col("x") == 5.0).count()
    assert a == 1 and b == 1


def test_mode(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    assert clean.fit_modes(df, ["c"]).first()["c"] == "a"
    nulls = spark.createDataFrame([(None,)], "c string")
    assert clean.fit_modes(nulls, ["c"]).first()["c"] == "Unknown"


def test_one_hot_levels_code_point_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("Unknown",), ("B",)], "c string")
    wide = encode.one_hot_wide(df, ["c"])
    assert wide.columns == ["c_Unknown", "c_a", "c_b"]


def test_align_keeps_nulls_and_fills_absent(spark):
    test = spark.createDataFrame([(None, 1.0)], "a double, z double")
    out = encode.align_columns(["b", "a"], test)
    assert out.columns == ["b", "a"]
    r = out.first()
    assert r["b"] == 0 and r["a"] is None
    assert encode.align_columns(["b", "a"], out).columns == ["b", "a"]  # idempotent


def test_histogram_bins(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (10.0,), (10.0,), (3.0,)], "x double")
    got = [r["count"] for r in profile.histogram(df, "x", 5).orderBy("bin").collect()]
    assert got == [1, 2, 0, 0, 2]
    const = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    h = profile.histogram(const, "x", 5).collect()
    assert len(h) == 1 and h[0]["count"] == 2


def test_metrics_mape_skips_zero_actual(spark):
    df = spark.createDataFrame([(0.0, 1.0), (100.0, 110.0), (-50.0, -40.0)], "ActualClosePrice double, "
                               "PredictedClosePrice double")
    m = metrics.regression_metrics(df).first()
    assert m["MAPE"] == 15.0
    assert m["RMSE"] >= m["MAE"]


def test_r2_degenerate(spark):
    mk = lambda rows: spark.createDataFrame(rows, "ActualClosePrice double, PredictedClosePrice double")  # noqa
    assert metrics.regression_metrics(mk([(5.0, 4.0), (5.0, 6.0)])).first()["R2"] == 0.0
    assert metrics.regression_metrics(mk([(5.0, 5.0), (5.0, 5.0)])).first()["R2"] == 1.0
    assert metrics.regression_metrics(mk([(5.0, 4.0)])).first()["R2"] is None


def test_band_counts_keep_zero(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "p double")
    banded = metrics.price_bands(df, "p")
    dim = metrics.band_dimension(spark).drop("LowerBound", "UpperBound")
    got = [r["ObservationCount"] for r in profile.category_counts(banded, dim, "PriceBand", "BandOrder")
           .orderBy("BandOrder").collect()]
    assert got == [2, 0, 0, 0, 0]


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    r = {(x["column_a"], x["column_b"]): x["correlation"] for x in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert r[("a", "b")] is None and r[("b", "b")] == 1.0


@pytest.mark.parametrize("probs", [[0.5], [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]])
def test_quantiles_match_numpy(spark, probs):
    import random

    import numpy as np
    rnd = random.Random(7)
    rows = [(rnd.choice(["a", "b", "c", None]), float(rnd.randint(-50, 50))) for _ in range(3000)] + [("d", 1.0)]
    rows += [("e", rnd.gauss(0, 1) * 10.0 ** rnd.randint(-300, 300)) for _ in range(501)] + [("f", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: list(r)[1:] for r in quantiles.exact_quantiles(df, "v", probs, group_cols=["g"]).collect()}
    assert set(got) == {"a", "b", "c", None, "d", "e"}
    for g, qs in got.items():
        want = np.quantile([v for h, v in rows if h == g and v is not None], probs)
        assert np.allclose(qs, want, rtol=1e-12, atol=0), g


def test_quantiles_by_brackets(spark, monkeypatch):
    """Brackets that leave most rows out, ties over many ranks, overlapping brackets, and brackets that miss."""
    import numpy as np
    rng = np.random.default_rng(4)
    values = {"smooth": rng.normal(size=4000) * 1e5, "ties": rng.integers(0, 7, 3001).astype(float),
              "ends": np.r_[np.full(900, -np.inf), rng.random(2100), np.full(77, np.inf)], "small": rng.random(30)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs], "g string, v double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.501, 0.9, 1.0]

    def check(**kw):
        got = {r["g"]: list(r)[1:] for r in quantiles.exact_quantiles(df, "v", probs, [f"p{p}" for p in probs], ["g"],
                                                                       **kw).collect()}
        assert set(got) == set(values)
        for g, vs in values.items():
            vs, want = sorted(map(float, vs)), []
            for p in probs:
                at = p * (len(vs) - 1)
                lo, hi, f = vs[int(np.floor(at))], vs[int(np.ceil(at))], at - np.floor(at)
                want.append(lo if f == 0 else lo + (hi - lo) * f)
            assert np.array_equal(got[g], want, equal_nan=True), g

    check(accuracy=200)
    base = df.select(df.g.alias("_g0"), df.v.alias("_v"))
    kept = quantiles._counted(base, ["_g0"], probs, quantiles._brackets(base, ["_g0"], probs, 200)).filter("_g0 = 'smooth'")
    assert 0 < kept.count() < 1200 and kept.agg({"_c": "sum"}).first()[0] == 4000
    wrong = base.groupBy("_g0").agg(*[F.array(*[F.lit(1e9) for _ in probs]).alias(c) for c in ("_lo", "_hi")])
    monkeypatch.setattr(quantiles, "_brackets", lambda *a: wrong)
    check()


def test_running_sum_is_the_sorted_tables(spark):
    from proplens.operators.ranged import running_sum
    rows = [(i * 7919 % 501, i % 13) for i in range(501)]
    df = spark.createDataFrame(rows, "k long, n long").repartition(4)
    got = {r["k"]: r["_cum"] for r in running_sum(df, ["k"], "n").collect()}
    total, want = 0, {}
    for k, n in sorted(rows):
        total += n
        want[k] = total
    assert got == want and running_sum(df.limit(0), ["k"], "n").count() == 0


def test_quantiles_without_groups_or_values(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    r = quantiles.exact_quantiles(df, "v", [0.5, 0.25], ["m", "q"]).first()
    assert r["m"] == 50.0 and r["q"] == 25.0
    assert [tuple(r) for r in quantiles.exact_quantiles(df.limit(0), "v", [0.5], ["m"]).collect()] == [(None,)]


def test_correlations_far_from_zero_with_infinities_and_repeats(spark):
    """Values of 1e9 and a spread of 1; a column constant where another is known; an infinity spoils its own pairs only."""
    import numpy as np
    rng = np.random.default_rng(8)
    a = rng.normal(size=900)
    x = np.c_[1e9 + a, 1e-6 * (a + rng.normal(size=900)), np.where(np.arange(900) < 400, 7.25, a), a, np.full(900, 0.1)]
    x[400:, 3] = np.nan
    x[5, 1] = np.inf
    cols = ["big", "inf", "half", "first", "same"]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x],
                               ", ".join(f"{c} double" for c in cols)).repartition(6)
    got = {(r["column_a"], r["column_b"]): r["correlation"] for r in profile.correlation_matrix(df, cols, 9).collect()}
    assert got["big", "half"] == pytest.approx(np.corrcoef(x[:, 0], x[:, 2])[0, 1], abs=1e-8)
    assert got["big", "first"] == pytest.approx(np.corrcoef(x[:400, 0], x[:400, 3])[0, 1], abs=1e-7)
    assert got["half", "first"] is None and all(got["same", c] is None for c in cols if c != "inf")
    assert all(np.isnan(got["inf", c]) for c in ("big", "half", "first", "inf"))
    # A column is read with the others of its query in one scan, whatever their number.
    empty = profile.correlation_matrix(df.limit(0), ["big", "half"]).collect()
    assert len(empty) == 4 and all(r["correlation"] is None for r in empty)


def test_column_profile_of_every_type_in_one_scan(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1, 0.0D, 'a', DATE'2020-01-01', array(1), binary('x'), true), (2, -0.0D, 'A', NULL, array(1), binary('y'), NULL),
        (1, double('NaN'), '', DATE'2020-01-01', NULL, binary('x'), true), (NULL, double('NaN'), NULL, NULL, array(2), NULL, true)
        AS t(i, d, s, day, arr, bin, ok)""").withColumnRenamed("s", "a.b")
    got = profile.column_profile(df)
    assert [(r["column_name"], r["ordinal"], r["missing_count"], r["distinct_count"]) for r in got.orderBy("ordinal").collect()] \
        == [("i", 1, 1, 2), ("d", 2, 0, 2), ("a.b", 3, 1, 3), ("day", 4, 2, 1), ("arr", 5, 1, 2), ("bin", 6, 1, 2), ("ok", 7, 1, 1)]
    none = profile.column_profile(df.limit(0)).orderBy("ordinal").collect()
    assert [(r["missing_count"], r["distinct_count"]) for r in none] == [(0, 0)] * 7


def test_correlation_blocks_skip_missing_pairwise(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 14)) @ rng.normal(size=(14, 14))
    x[rng.random(x.shape) < 0.1] = np.nan
    cols = [f"c.{i}" for i in range(14)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x],
                               ", ".join(f"`{c}` double" for c in cols))
    want = pd.DataFrame(x).corr().to_numpy()
    got = {(r["column_a"], r["column_b"]): r["correlation"] for r in profile.correlation_matrix(df, cols).collect()}
    assert len(got) == 196
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            assert abs(got[a, b] - want[i, j]) < 1e-5


def test_column_profile_counts(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (2, "y"), (None, "y")], "a int, `b.c` string")
    want = [("a", 1, "int", 1, 2), ("b.c", 2, "string", 1, 2)]
    for frame, rows in ((df, want), (df.limit(0), [(n, i, t, 0, 0) for n, i, t, _, _ in want])):
        for approx in (False, True):
            assert [tuple(r) for r in profile.column_profile(frame, approx=approx).orderBy("ordinal").collect()] == rows


def test_split_chronological_matches_row_number(spark):
    from pyspark.sql import Window
    rows = [(d % 7, i, float(i % 3)) for i, d in enumerate(range(200))]
    df = spark.createDataFrame(rows, "d int, k int, v double")
    fit, val, cut = split.split_chronological(df, "d", ["k", "v"], 0.2)
    assert cut == 160 and fit.count() == 160 and val.count() == 40
    rn = df.withColumn("rn", F.row_number().over(Window.orderBy("d", "k", "v")))
    want = {r["k"] for r in rn.where("rn <= 160").collect()}
    assert {r["k"] for r in fit.collect()} == want


def test_split_spread_rank_matches(spark, monkeypatch):
    from pyspark.sql import Window
    rows = [(1, i % 50, float(i % 7)) for i in range(400)] + [(0, i, 0.0) for i in range(100)]
    df = spark.createDataFrame(rows, "d int, k int, v double")
    monkeypatch.setattr(split, "BUCKETS", 3)
    fit, val, cut = split.split_chronological(df, "d", ["k", "v"], 0.2)
    assert cut == 400 and fit.count() == 400 and val.count() == 100
    rn = df.withColumn("rn", F.row_number().over(Window.orderBy("d", "k", "v")))
    want = sorted((r["d"], r["k"], r["v"]) for r in rn.where("rn > 400").collect())
    assert sorted((r["d"], r["k"], r["v"]) for r in val.collect()) == want


def test_fit_count_rules():
    assert split.fit_count(49703, 0.2) == 39762
    assert split.fit_count(60000, 0.2) == 48000
    with pytest.raises(ValueError):
        split.fit_count(1, 0.2)
    with pytest.raises(ValueError):
        split.fit_count(10, 1.5)


def test_quality_gates_raise(spark):
    df = spark.createDataFrame([(1.0, None), (float("inf"), 2.0)], "y double, x double")
    rules = quality.quality_rules(df, "train", required=["y", "x", "missing"], target="y")
    bad = {(r["rule"], r["column"]): r["violations"] for r in rules.collect()}
    assert bad[("required_columns", "missing")] == 1
    assert bad[("predictor_not_missing", "x")] == 1
    assert bad[("finite_values", "y")] == 1
    with pytest.raises(quality.DataQualityError):
        quality.assert_valid(rules)
    empty = spark.createDataFrame([], "y double")
    with pytest.raises(quality.DataQualityError):
        quality.assert_valid(quality.quality_rules(empty, "test", target="y"))
    assert quality.schema_violations(df, df.select("x", "y")) == ["train and test columns differ"]


def test_assert_valid_names_every_failing_rule(spark):
    rules = spark.createDataFrame([("finite_values", "train", f"c{i:03d}", 1) for i in range(120)],
                                  "rule string, dataset string, column string, violations long")
    with pytest.raises(quality.DataQualityError) as e:
        quality.assert_valid(rules)
    assert all(f"train.c{i:03d}: finite_values (1)" in str(e.value) for i in range(120))


def test_select_best_and_best_vs_second(spark):
    lb = spark.createDataFrame([("a", 10.0, 5.0, 0.5), ("b", 8.0, 6.0, 0.6), ("c", 8.0, 4.0, 0.7)],
                               "Model string, RMSE double, MAE double, R2 double")
    assert rank.select_best(lb).first()[0] == "c"
    r = rank.best_vs_second(lb).first()
    assert r["Best"] == "b" and r["RunnerUp"] == "c" and r["RMSEDelta"] == 0.0


def test_prune_keeps_schema_order(spark):
    df = spark.createDataFrame([(1.0, None, "x"), (2.0, None, "y"), (3.0, 1.0, None)], "a double, b double, c string")
    assert clean.prune_sparse_columns(df, 50.0).columns == ["a", "c"]
    assert clean.prune_sparse_columns(df, 50.0, protect=["b"]).columns == ["a", "b", "c"]


def test_wide_predictions_pivot_from_long(spark):
    from proplens.operators import reshape
    long = spark.createDataFrame([(1, "Model A", 10.0, 12.0), (1, "Model-B", 10.0, 7.0), (2, "Model A", 5.0, 5.0)],
                                 "id int, Model string, ActualClosePrice double, PredictedClosePrice double")
    w = reshape.wide_predictions(long, ["id"]).orderBy("id").collect()
    assert w[0]["model_a_prediction"] == 12.0 and w[0]["model_b_absolute_error"] == 3.0
    assert w[1]["model_b_prediction"] is None


def test_added_columns_and_kinds(spark):
    before = spark.createDataFrame([(1.0, "a", True)], "x double, s string, b boolean")
    after = before.withColumn("z", before.x * 2).withColumn("c", before.x)
    assert clean.added_columns(before, after) == ["c", "z"]
    assert clean.columns_of_kind(after, ["number"]) == ["x", "z", "c"]
    assert clean.columns_of_kind(after, ["number", "bool"], exclude=True) == ["s"]
    assert clean.keep_existing(after, ["z", "nope", "x"]).columns == ["z", "x"]
    assert encode.target_first(after, "s").columns[0] == "s"


def test_row_counts_generic(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    out = profile.row_counts(spark, [("a", a), ("b", a.where("x > 1"))]).orderBy("stage_order").collect()
    assert [(r["stage"], r["rows"], r["columns"]) for r in out] == [("a", 2, 1), ("b", 1, 1)]


def test_null_predictions_count_nowhere(spark):
    from proplens.operators import metrics
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (30.0, None), (4.0, 5.0), (None, 3.0)],
                               "ActualClosePrice double, PredictedClosePrice double")
    r = metrics.regression_metrics(df).first()
    assert (r["ObservationCount"], r["MAE"], r["R2"]) == (2, 0.5, round(1 - 1 / 4.5, 6))
    assert metrics.unscored_rows(df) == 3


def test_missing_metric_never_wins(spark):
    from proplens.operators import rank
    df = spark.createDataFrame([("a", None, 0.1), ("b", 2.0, None), ("c", 2.0, 0.5), ("d", 3.0, 0.9)],
                               "Model string, RMSE double, R2 double")
    assert rank.select_best(df).first()[0] == "c"
    r = rank.best_and_worst(df, "Model", "RMSE").first()
    assert (r["Best"], r["Worst"]) == ("b", "d")
    s = rank.best_vs_second(df, deltas=("RMSE",)).first()
    assert (s["Best"], s["RunnerUp"], s["RMSEDelta"]) == ("b", "c", 0.0)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_chronological_split_in_another_time_zone(spark, kind, monkeypatch):
    import time
    from proplens.operators import split
    step = "day" if kind == "date" else "hour"
    df = spark.range(240).selectExpr("id", f"cast(timestamp'2020-03-01 00:00:00.25' + id * interval 1 {step} as {kind}) d")
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        fit, val, cut = split.split_chronological(df, "d", ["id"], 0.2)
        assert cut == 192 and {r[0] for r in fit.select("id").collect()} == set(range(192)) and val.count() == 48
    finally:
        monkeypatch.undo()
        time.tzset()


def test_odd_column_names(spark):
    from proplens.operators import clean, encode
    df = spark.createDataFrame([("St. Helena", "x", 1.0, float("inf")), ("a`b", "y", None, 2.0), ("z", "y", 3.0, 1.0)],
                               "City string, g string, `p.q` double, `r``s` double")
    wide = encode.one_hot_wide(df, ["City", "g"])
    assert wide.columns == ["p.q", "r`s", "City_a`b", "City_z", "g_y"]
    assert encode.align_columns(wide.columns, wide).columns == wide.columns
    assert clean.inf_to_null(wide).columns == wide.columns
    fixed = clean.apply_fill(df, {"p.q": 9.0, "r`s": 0.0}).collect()
    assert [r["p.q"] for r in fixed] == [1.0, 9.0, 3.0]
    assert {r["column_name"] for r in clean.missing_summary(df).collect()} == set(df.columns)
    assert clean.project(df, ["p.q", "r`s"]).columns == ["p.q", "r`s"]


def test_nan_counts_as_missing_everywhere(spark):
    """x = (1, NaN, 3, NULL): the answers are those of (1, 3)."""
    from proplens.operators import clean, metrics, profile, quality, quantiles
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0), (nan, 5.0), (3.0, 4.0), (None, 1.0)], "x double, y double")
    assert {r["column_name"]: r["missing_count"] for r in clean.missing_summary(df).collect()} == {"x": 2, "y": 0}
    rules = {(r["rule"], r["column"]): r["violations"] for r in quality.quality_rules(df, "d", target="x").collect()}
    assert rules["target_not_missing", "x"] == 2
    rules = {(r["rule"], r["column"]): r["violations"] for r in quality.quality_rules(df, "d", target="y").collect()}
    assert rules["predictor_not_missing", "x"] == 2
    assert clean.fit_medians(df, ["x"]).first()["x"] == 2.0
    assert [r["x"] for r in clean.apply_fill(df, {"x": 2.0}).collect()] == [1.0, 2.0, 3.0, 2.0]
    assert clean.fit_modes(df.unionByName(df).filter("x is null or isnan(x) or x = 3"), ["x"]).first()["x"] == "3.0"
    d = profile.describe(df, ["x"]).first()
    assert (d["count"], d["mean"], d["min"], d["max"], d["q50"]) == (2, 2.0, 1.0, 3.0, 2.0) and d["std"] == 1.4142
    c = {(r["column_a"], r["column_b"]): r["correlation"] for r in profile.correlation_matrix(df, ["x", "y"]).collect()}
    assert c["x", "x"] == 1.0 and c["x", "y"] == 1.0
    h = profile.histogram(df, "x", bins=2).orderBy("bin").collect()
    assert [(r["bin_start"], r["bin_end"], r["count"]) for r in h] == [(1.0, 2.0, 1), (2.0, 3.0, 1)]
    m = metrics.regression_metrics(df.withColumnsRenamed({"x": "ActualClosePrice", "y": "PredictedClosePrice"})).first()
    assert (m["ObservationCount"], m["MAE"], m["RMSE"]) == (2, 1.0, 1.0) and m["MdAPE"] == pytest.approx(66.666667)
    assert quantiles.exact_median(df, "x").first()[0] == 2.0


def test_sales_view_shuffles_lineitem_by_order_and_part_only(spark, monkeypatch):
    from proplens.sources.tables import sales_view
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sales_view(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    customer = [line for line in plan.splitlines() if "Exchange hashpartitioning(o_custkey" in line]
    assert customer and "l_orderkey" not in customer[0]
    depth = lambda text: next(i for i, line in enumerate(plan.splitlines()) if text in line)
    assert depth("hashpartitioning(l_partkey") < depth("hashpartitioning(l_orderkey") < depth("hashpartitioning(o_custkey")


def test_column_quantile_is_exact_quantiles(spark, monkeypatch):
    """Medians of columns side by side: as numpy's, for ties, brackets of one value, few and no values; no row per value."""
    import numpy as np

    from proplens.operators import quantiles as Q
    rng = np.random.default_rng(3)
    n = 24_001
    cols = {"wide": rng.normal(size=n), "ties": rng.integers(0, 4, n).astype(float), "split": np.r_[np.zeros(n // 2), np.ones(n - n // 2)],
            "few": np.where(np.arange(n) < 7, rng.normal(size=n), np.nan), "none": np.full(n, np.nan), "even": rng.normal(size=n)}
    cols["even"][0] = np.nan
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(zip(*cols.values()))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    sent, picked = [], Q._picked
    monkeypatch.setattr(Q, "_picked", lambda counts, *a: sent.append(counts.count()) or picked(counts, *a))
    got = Q.column_quantile(df, list(cols), 0.5)
    for (c, v), g in zip(cols.items(), got):
        v = v[~np.isnan(v)]
        assert g == (np.median(v) if len(v) else None), c
    assert sent and sent[0] < 200
