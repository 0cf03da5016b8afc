"""Property tests (hypothesis) on small random frames: invariants of the operators."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from proplens.operators import metrics, quantiles

FAST = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
values = st.lists(st.one_of(st.none(), st.floats(-1e7, 1e7, allow_nan=False)), min_size=1, max_size=40)


@FAST
@given(values)
def test_exact_quantiles_equal_numpy(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    got = quantiles.exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["a", "b", "c"]).collect()
    clean = [x for x in xs if x is not None]
    if not clean:  # a global aggregate keeps its one row, with NULLs
        assert all(r is None for row in got for r in row)
        return
    want = np.quantile(np.array(clean), [0.1, 0.5, 0.9])
    for g, w in zip(got[0], want):
        assert abs(g - w) <= 1e-6 * max(1.0, abs(w))


def test_order_key_orders_as_doubles_do(spark):
    """Beside powers of two, among the subnormal numbers and at the ends of the range."""
    two = np.ldexp(1.0, np.arange(-1074, 1024))
    x = np.concatenate([two, np.nextafter(two, np.inf), np.nextafter(two, 0), np.random.default_rng(1).normal(size=500),
                        [0.0, np.inf, 5e-324, 1e-310, np.finfo(float).max]])
    x = np.unique(np.concatenate([x, -x]))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i long, v double")
    keys = [r[0] for r in df.select(quantiles.order_key(df.v), "i").orderBy("i").collect()]
    assert all(a < b for a, b in zip(keys, keys[1:]))
    above = spark.sql("SELECT double('NaN') AS v, -0.0D AS z").select(quantiles.order_key(F.col("v")),
                                                                      quantiles.order_key(F.col("z"))).first()
    assert above[0] > keys[-1] and above[1] == 0


@FAST
@given(st.lists(st.tuples(st.floats(-1e7, 1e7), st.floats(-1e7, 1e7)), min_size=1, max_size=40))
def test_band_counts_sum_and_rmse_ge_mae(spark, pairs):
    df = spark.createDataFrame(pairs, "ActualClosePrice double, PredictedClosePrice double")
    m = metrics.regression_metrics(df, rounded=False).first()
    assert m["RMSE"] >= m["MAE"] - 1e-6
    bands = metrics.metrics_by_band(df).collect()
    assert sum(r["ObservationCount"] for r in bands) == len(pairs)
