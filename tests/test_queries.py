"""Registered queries: smoke at sf0.001, expected values from FIXTURES §4 at sf0.01, invariants."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL


def test_entry_flagship(spark):
    import __spark_entry__ as E
    rows = E.entry(spark).orderBy("BandOrder").collect()
    assert [r["ObservationCount"] for r in rows] == [20, 30, 57, 162, 67]


def test_flagship_expected_values(spark):
    import __spark_entry__ as E
    rows = E.queries()["metrics_by_band"](spark, SF_MID).orderBy("BandOrder").collect()
    got = [(r["PriceBand"], r["ObservationCount"], r["MAE"], r["MdAPE"], r["R2"]) for r in rows]
    assert got == [("Under $500K", 227, 8542.8223, 3.013287, 0.992599),
                   ("$500K-$1M", 266, 24698.6307, 2.983347, 0.956862),
                   ("$1M-$2M", 503, 47725.8837, 3.002343, 0.961348),
                   ("$2M-$5M", 1534, 108185.1766, 2.876831, 0.97634),
                   ("$5M+", 612, 172259.9957, 2.819189, 0.689913)]


def test_fixture_facts(spark):
    from proplens.plans import stages as S
    from proplens.operators.split import split_chronological
    train, test = S.train_test(spark, SF_MID)
    assert (train.count(), test.count()) == (23270, 3142)
    fit, val, _ = split_chronological(train, "CloseDate", S.LINEITEM_KEYS, 0.2)
    assert (fit.count(), val.count()) == (18616, 4654)
    assert fit.count() + val.count() == train.count()


def test_all_queries_smoke(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    skip = {"tree_predictions", "forest_predictions", "gbt_predictions", "boosting_curve", "refit_and_score",
            "feature_importance", "model_comparison", "feature_set_ab", "metadata_record", "final_evaluation",
            "linear_coefficients"}
    for name, fn in qs.items():
        if name in skip:
            continue
        df = fn(spark, SF_SMALL)
        assert df.count() >= 0, name


def test_model_queries_run(spark):
    import __spark_entry__ as E
    qs = E.queries()
    r = qs["metadata_record"](spark, SF_SMALL).first()
    assert r["reload_matches"] is True
    imp = qs["feature_importance"](spark, SF_SMALL)
    sums = {x["Model"]: x["s"] for x in imp.groupBy("Model").agg(F.sum("Importance").alias("s")).collect()}
    assert all(abs(v - 1.0) < 1e-6 for v in sums.values())


def test_final_evaluation(spark):
    """Winner by validation RMSE, every metric from numpy's, and one test row of the winner."""
    from proplens.plans import q_models as Q
    seconds = {}
    rows = Q.final_evaluation_rows(*Q._fit_validation(spark, SF_SMALL), rounds=3, seconds=seconds).collect()
    val = {r["Model"]: r for r in rows if r["EvaluationSet"] == "validation"}
    test, = [r for r in rows if r["EvaluationSet"] == "test"]
    assert set(val) == set(Q.CANDIDATES) and set(seconds) == {*Q.CANDIDATES, "refit"}
    winner = min(val.values(), key=lambda r: r["RMSE"])["Model"]
    assert [r["Model"] for r in rows if r["Selected"]] == [winner, winner] and test["Model"] == winner
    assert {n: r["BestRound"] for n, r in val.items()} == {
        n: (r["BestRound"] if n in Q.EARLY_STOPPED else None) for n, r in val.items()}
    assert all(1 <= val[n]["BestRound"] <= 3 for n in Q.EARLY_STOPPED)
    assert test["ObservationCount"] == 336


def test_linear_coefficients_fit_as_numpy_does(spark):
    """The fitted line reaches least squares' error; the query lists the 15 largest coefficients in order."""
    import __spark_entry__ as E
    import numpy as np
    from proplens.plans import q_models as Q, stages as S
    train, _ = Q._frames(spark, SF_SMALL)
    model = Q._fit(train, Q.ENG_FEATURES, "Linear Regression")
    got = model.transform(train).select("features", "label", "prediction").collect()
    x = np.c_[np.array([r["features"].toArray() for r in got]), np.ones(len(got))]
    y, p = np.array([[r["label"], r["prediction"]] for r in got]).T
    best = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    assert abs(np.std(y - p) / np.std(y - best) - 1) < 1e-3
    top = E.queries()["linear_coefficients"](spark, SF_SMALL).collect()
    sizes = [abs(r["Coefficient"]) for r in top]
    assert len(top) == 15 and sizes == sorted(sizes, reverse=True)
    names = Q.K.feature_names(model, Q.ENG_FEATURES, S.CATEGORICAL)
    assert {r["Feature"] for r in top} <= set(names)


def test_model_results_follow_from_their_parts(spark):
    """Curve: one row a round, the best is its minimum.  Comparison: ranks by RMSE.  Forest: one prediction per test row."""
    import __spark_entry__ as E
    qs = E.queries()
    curve = qs["boosting_curve"](spark, SF_SMALL).orderBy("Round").collect()
    assert [r["Round"] for r in curve] == list(range(1, len(curve) + 1))
    assert [r["Round"] for r in curve if r["IsBest"]] == [min(curve, key=lambda r: (r["ValidationRMSE"], r["Round"]))["Round"]]
    forest = qs["forest_predictions"](spark, SF_SMALL)
    assert forest.agg(F.count("PredictedClosePrice"), F.count_distinct("l_orderkey", "l_linenumber")).first()[0] == 336


def test_tree_deterministic(spark):
    import __spark_entry__ as E
    q = E.queries()["tree_predictions"]
    a = q(spark, SF_SMALL).agg(F.sum("PredictedClosePrice")).first()[0]
    b = q(spark, SF_SMALL).agg(F.sum("PredictedClosePrice")).first()[0]
    assert a == b


@pytest.mark.parametrize("name", ["band_counts"])
def test_band_counts_sum_to_test_rows(spark, name):
    import __spark_entry__ as E
    total = E.queries()[name](spark, SF_MID).agg(F.sum("ObservationCount")).first()[0]
    assert total == 3142


def test_drifting_layouts_are_split_by_day(spark, monkeypatch):
    """Each layout's rows are filtered by their day, not by a text made of every row's date; no row is lost."""
    from proplens.plans import q_prep as P, stages as S
    filters, write = [], P.files.write_csv
    monkeypatch.setattr(P.files, "write_csv", lambda df, *a, **k: filters.append([
        x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in x]) or write(df, *a, **k))
    got = P.scan_drifting_months(spark, SF_SMALL).agg(F.sum("rows")).first()[0]
    assert all("CloseDate" in "".join(x) and "date_format" not in "".join(x) for x in filters) and len(filters) == 2
    assert got == S.segment(spark, SF_SMALL).count()
