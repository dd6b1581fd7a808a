"""Metamorphic tests: features never look ahead."""
import numpy as np
from pyspark.sql import functions as F

from barframe.operators.features import ALL_FEATURES, BASE_FEATURES, all_feature_columns


def test_truncating_history_keeps_past_values(spark, bars):
    full = all_feature_columns(bars, None).toPandas().set_index(["symbol", "date"]).sort_index()
    cut = bars.filter(F.col("date") <= F.lit("1996-06-30"))
    part = all_feature_columns(cut, None).toPandas().set_index(["symbol", "date"]).sort_index()
    common = full.loc[part.index, BASE_FEATURES]
    np.testing.assert_allclose(part[BASE_FEATURES].to_numpy(float), common.to_numpy(float),
                               rtol=1e-10, equal_nan=True)


def test_perturbing_last_close_changes_only_last_row(spark, bars):
    last = bars.groupBy("symbol").agg(F.max("date").alias("d"))
    bumped = bars.join(last, "symbol").withColumn(
        "close", F.when(F.col("date") == F.col("d"), F.col("close") * 3).otherwise(F.col("close"))).drop("d")
    a = all_feature_columns(bars, None).toPandas().set_index(["symbol", "date"]).sort_index()
    b = all_feature_columns(bumped, None).toPandas().set_index(["symbol", "date"]).sort_index()
    lastdays = set(map(tuple, last.toPandas().to_numpy()))
    keep = [i for i in a.index if (i[0], i[1]) not in lastdays]
    np.testing.assert_allclose(a.loc[keep, BASE_FEATURES].to_numpy(float),
                               b.loc[keep, BASE_FEATURES].to_numpy(float), rtol=1e-10, equal_nan=True)


def test_no_feature_is_a_label_proxy(spark):
    """Tripwire on a seeded random walk (a driver table is no random walk:
    its daily closes are independent order prices, which mean-revert)."""
    import numpy as np
    import pandas as pd
    from barframe.operators.features import feature_matrix
    from barframe.operators.quality import leakage_tripwire
    rng = np.random.default_rng(20240101)
    n = 800
    close = 100 * np.exp(np.cumsum(rng.normal(0.0004, 0.013, n)))
    open_ = close * (1 + rng.normal(0, 0.003, n))
    spread = np.abs(rng.normal(0.008, 0.004, n))
    pdf = pd.DataFrame({"symbol": "RW", "date": pd.bdate_range("2018-01-02", periods=n).date,
                        "open": open_, "high": np.maximum(open_, close) * (1 + spread),
                        "low": np.minimum(open_, close) * (1 - spread), "close": close, "adj_close": close,
                        "volume": rng.integers(1_000_000, 40_000_000, n)})
    fm = feature_matrix(spark.createDataFrame(pdf), None, include_market=False)
    worst = leakage_tripwire(fm, BASE_FEATURES).agg(F.max("abs_corr")).first()[0]
    assert worst < 0.30
