"""Window indicators against pandas rolling/ewm (an independent oracle)."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barframe.functions.windows import EmaSpec, with_ema
from barframe.operators.features import all_feature_columns


def _frame(spark, values, symbol="S"):
    pdf = pd.DataFrame({"symbol": symbol, "date": pd.bdate_range("2018-01-02", periods=len(values)).date,
                        "x": values})
    return spark.createDataFrame(pdf, "symbol string, date date, x double")


@pytest.mark.parametrize("alpha,minp", [(2 / 11, 10), (2 / 27, 26), (1 / 14, 14), (0.2, 9)])
def test_ema_matches_pandas_with_gaps(spark, alpha, minp):
    rng = np.random.default_rng(5)
    x = 100 + rng.normal(0, 1, 1500).cumsum()
    x[:7] = np.nan                      # leading nulls
    x[rng.choice(np.arange(20, 1500), 25, replace=False)] = np.nan   # tolerated interior nulls
    df = with_ema(_frame(spark, x), [EmaSpec("y", "x", alpha, minp)]).orderBy("date").toPandas()
    want = pd.Series(x).ewm(alpha=alpha, adjust=False, min_periods=minp).mean()
    got = df["y"].astype(float)
    assert (got.isna() == want.isna()).all()
    np.testing.assert_allclose(got[want.notna()], want[want.notna()], rtol=1e-10)


def _pandas_indicators(g: pd.DataFrame) -> pd.DataFrame:
    c = g["close"]
    out = pd.DataFrame(index=g.index)
    out["sma20"] = c.rolling(20, min_periods=20).mean()
    d = c.diff()
    gain, loss = d.clip(lower=0), -d.clip(upper=0)
    ag = gain.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
    al = loss.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
    rsi = 100 - 100 / (1 + ag / al.replace(0, np.nan))
    rsi = rsi.where(al != 0, 100.0).where(ag != 0, 0.0)
    out["rsi_14"] = rsi.where(ag.notna() & al.notna())
    e12 = c.ewm(span=12, adjust=False, min_periods=12).mean()
    e26 = c.ewm(span=26, adjust=False, min_periods=26).mean()
    line = e12 - e26
    sig = line.ewm(span=9, adjust=False, min_periods=9).mean()
    out["macd"], out["macd_signal"] = line / c, sig / c
    mid = c.rolling(20, min_periods=20).mean()
    sd = c.rolling(20, min_periods=20).std(ddof=0)
    out["bb_position"] = (c - (mid - 2 * sd)) / (4 * sd).replace(0, np.nan)
    pc = c.shift(1)
    tr = pd.concat([g["high"] - g["low"], (g["high"] - pc).abs(), (g["low"] - pc).abs()], axis=1).max(axis=1)
    out["atr_14_norm"] = tr.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean() / c
    r = c.pct_change()
    out["volatility_20d"] = r.rolling(20, min_periods=20).std(ddof=1)
    out["close_to_ema10"] = c / c.ewm(span=10, adjust=False, min_periods=10).mean() - 1
    return out


def test_features_match_pandas_on_driver_bars(spark, bars, bars_pd):
    got = all_feature_columns(bars, None).orderBy("symbol", "date").toPandas()
    for sym, g in bars_pd.groupby("symbol"):
        g = g.reset_index(drop=True)
        want = _pandas_indicators(g)
        mine = got[got.symbol == sym].reset_index(drop=True)
        mine = mine.assign(sma20=g["close"].rolling(20, min_periods=20).mean())
        for col in want.columns:
            if col == "sma20":
                continue
            a, b = mine[col].astype(float), want[col].astype(float)
            assert (a.isna() == b.isna()).all(), (sym, col)
            np.testing.assert_allclose(a[b.notna()], b[b.notna()], rtol=1e-8, atol=1e-12, err_msg=col)


def test_sma_hand_values(spark):
    from barframe.functions.windows import sma
    df = _frame(spark, [1.0, 2, 3, 4, 5, 6]).select("date", sma("x", 3).alias("s")).orderBy("date")
    assert [r.s for r in df.collect()] == [None, None, 2.0, 3.0, 4.0, 5.0]


def test_rsi_monotone_extremes(spark):
    up = np.linspace(10, 60, 80)
    down = up[::-1]
    for values, last in ((up, 100.0), (down, 0.0)):
        pdf = pd.DataFrame({"symbol": "S", "date": pd.bdate_range("2018-01-02", periods=80).date,
                            "open": values, "high": values, "low": values, "close": values,
                            "adj_close": values, "volume": 1000})
        df = spark.createDataFrame(pdf)
        out = all_feature_columns(df, None).orderBy(F.col("date").desc()).first()
        assert out.rsi_14 == last


def test_flat_series_rsi_zero_and_target(spark):
    values = [10.0] * 30
    pdf = pd.DataFrame({"symbol": "S", "date": pd.bdate_range("2018-01-02", periods=30).date,
                        "open": values, "high": values, "low": values, "close": values,
                        "adj_close": values, "volume": 5})
    out = all_feature_columns(spark.createDataFrame(pdf), None).orderBy("date").toPandas()
    assert out["rsi_14"].dropna().eq(0.0).all()
    assert out["target_up_next_day"].dropna().eq(0).all()


def test_target_definition(spark):
    closes = [10.0, 11.0, 10.5, 12.0]
    pdf = pd.DataFrame({"symbol": "S", "date": pd.bdate_range("2018-01-02", periods=4).date,
                        "open": closes, "high": closes, "low": closes, "close": closes,
                        "adj_close": closes, "volume": 1})
    out = all_feature_columns(spark.createDataFrame(pdf), None).orderBy("date").collect()
    assert [r.target_up_next_day for r in out] == [1, 0, 1, None]
    assert abs(out[0].next_day_return - 0.1) < 1e-12
