"""Hand-checkable metric, signal and statistics values."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barframe.operators import metrics as M
from barframe.operators import signal as S
from barframe.operators import stats as ST


def _yp(spark, y, p, pred=None):
    pred = pred if pred is not None else [int(v >= 0.5) for v in p]
    pdf = pd.DataFrame({"g": "a", "y": y, "p_up": [float(v) for v in p], "pred": pred})
    return spark.createDataFrame(pdf)


def test_perfect_prediction(spark):
    y = [0, 1, 0, 1, 1, 0]
    r = M.scorecard(_yp(spark, y, y), ["g"]).first()
    assert r.accuracy == r.f1 == r.roc_auc == 1.0


def test_single_class_auc_is_null(spark):
    assert M.scorecard(_yp(spark, [1, 1, 1, 1], [.2, .4, .6, .8]), ["g"]).first().roc_auc is None


def test_confusion_counts(spark):
    df = _yp(spark, [0, 1, 0, 1], [0, 0, 1, 1], pred=[0, 0, 1, 1])
    c = {(r.actual, r.predicted): r["count"] for r in M.confusion(df, ["g"]).collect()}
    assert c == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 1}


def test_auc_matches_mann_whitney_with_ties(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 3000)
    p = np.round(rng.random(3000) * 0.3 + y * 0.1, 2)     # many ties
    got = M.roc_auc(_yp(spark, y.tolist(), p.tolist()), ["g"]).first().roc_auc
    ranks = pd.Series(p).rank()
    n1, n0 = y.sum(), len(y) - y.sum()
    want = (ranks[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    assert abs(got - want) < 1e-12


def test_majority_baseline(spark):
    train = [1] * 70 + [0] * 30
    test = [1, 0] * 20
    rows = [("train", v, 0.0) for v in train] + [("test", v, r) for v, r in
                                                 zip(test, np.linspace(-.02, .02, 40))]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["split", "y", "daily_return"])).withColumn("g", F.lit("a"))
    bp = M.baseline_predictions(df, ["g"])
    card = {r.model_key: r for r in M.scorecard(bp, ["model_key"], proba=None).collect()}
    assert card["baseline_majority_class"].accuracy == 0.5


def test_signal_labels_and_thresholds(spark):
    df = spark.createDataFrame(pd.DataFrame({"p": [0.8, 0.5, 0.2, None]}))
    got = [r.s for r in df.select(S.classify_probability("p").alias("s")).collect()]
    assert got == ["Bullish", "Neutral", "Bearish", "Neutral"]
    with pytest.raises(ValueError):
        S.classify_probability("p", bull=0.4, bear=0.6)


def _study_input(spark, n, seed):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"g": "a", "date": pd.bdate_range("2020-01-01", periods=n).date,
                        "p_up": rng.random(n), "fwd_return": rng.normal(0, 0.01, n)})
    return spark.createDataFrame(pdf), pdf


def _reference_study(pdf, bull=0.55, bps=5.0):
    pos = (pdf.p_up > bull).astype(float)
    gross = pos * pdf.fwd_return
    turn = pos.diff().abs().fillna(pos.iloc[0])
    cost = turn * bps / 1e4
    net = gross - cost
    curve = (1 + net).cumprod()
    return {"observations": len(pdf), "n_position_changes": int(turn.sum()),
            "strategy_total_return_pct": ((1 + net).prod() - 1) * 100,
            "total_cost_pct": cost.sum() * 100,
            "strategy_max_drawdown_pct": (curve / curve.cummax() - 1).min() * 100,
            "days_in_market_pct": pos.mean() * 100}


def test_signal_study_matches_definition(spark):
    df, pdf = _study_input(spark, 60, 3)
    got = S.signal_study(df, ["g"]).first().asDict()
    want = _reference_study(pdf)
    for k, v in want.items():
        assert math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-12), k
    assert got["total_cost_pct"] >= 0 and got["strategy_max_drawdown_pct"] <= 0


def test_costs_reduce_return(spark):
    df, _ = _study_input(spark, 80, 11)
    free = S.signal_study(df, ["g"], bps=0.0).first().strategy_total_return_pct
    paid = S.signal_study(df, ["g"], bps=25.0).first().strategy_total_return_pct
    assert free >= paid


def test_bucket_counts_sum(spark):
    df, _ = _study_input(spark, 50, 5)
    b = S.returns_by_signal(df, ["g"])
    assert b.agg(F.sum("observations")).first()[0] == 50


def test_drawdown_and_volatility_hand_values(spark):
    pdf = pd.DataFrame({"symbol": "S", "date": pd.bdate_range("2020-01-01", periods=4).date,
                        "close": [100.0, 120.0, 60.0, 90.0]})
    assert ST.max_drawdown(spark.createDataFrame(pdf)).first().max_drawdown == -0.5
    pdf["close"] = [1.0, 2.0, 3.0, 4.0]
    assert ST.max_drawdown(spark.createDataFrame(pdf)).first().max_drawdown == 0.0
    r = spark.createDataFrame(pd.DataFrame({"r": [0.01, -0.01] * 100}))
    v = r.agg(ST.annualised_volatility("r").alias("v")).first().v
    assert math.isclose(v, np.std([0.01, -0.01] * 100, ddof=1) * math.sqrt(252), rel_tol=1e-12)


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_auc_bucketing_is_exact(spark, buckets):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 2000)
    p = np.round(rng.random(2000) * 0.5 + y * 0.2, 3)
    df = _yp(spark, y.tolist(), p.tolist())
    t = M._score_table(df, ["g"], "y", "p_up", buckets=buckets)
    auc = t.groupBy("g").agg((F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
                              / (F.sum("pos") * F.sum("neg"))).alias("a")).first().a
    ranks = pd.Series(p).rank()
    n1, n0 = y.sum(), len(y) - y.sum()
    assert abs(auc - (ranks[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)) < 1e-12
