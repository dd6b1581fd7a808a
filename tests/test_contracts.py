"""Smoothers over null runs, full permutations, pairwise correlation, validation and failure contracts."""
import datetime
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barframe.functions.windows import EmaSpec, with_ema
from barframe.operators import explain as X
from barframe.operators import models as ML
from barframe.operators import quality as Q
from barframe.operators import report as R
from barframe.operators import splits as SP

DAY = datetime.date(2000, 1, 3)


def test_ema_carries_through_null_runs(spark):
    rng = np.random.default_rng(1)
    specs = [EmaSpec("a", "x", 1 / 14, 14), EmaSpec("b", "x", 2 / 27, 26), EmaSpec("c", "x", 0.2, 9)]
    frames = []
    for name, (lo, n) in {"none": (0, 0), "r100": (700, 100), "r525": (700, 525), "r1100": (700, 1100), "tail": (1300, 1200)}.items():
        x = 100 + np.cumsum(rng.normal(size=2500))
        x[lo:lo + n] = np.nan
        frames.append(pd.DataFrame({"symbol": name, "date": [DAY + datetime.timedelta(i) for i in range(2500)], "x": x}))
    pdf = pd.concat(frames)
    df = spark.createDataFrame([(s, d, None if np.isnan(v) else float(v)) for s, d, v in pdf.itertuples(index=False)], "symbol string, date date, x double")
    got = with_ema(df, specs).toPandas().sort_values(["symbol", "date"])
    for name, g in got.groupby("symbol"):
        x = pdf[pdf.symbol == name].x.reset_index(drop=True)
        for s in specs:
            want = x.ewm(alpha=s.alpha, adjust=False, min_periods=s.min_periods).mean().to_numpy()
            np.testing.assert_allclose(g[s.out].to_numpy(float), want, rtol=1e-9, equal_nan=True)


@pytest.mark.parametrize("n", [165, 1250, 12000])
def test_permutation_moves_all_but_about_one_row(spark, n):
    rows = spark.range(n).select(F.lit("s").alias("symbol"), F.col("id").alias("date"))
    p = X.permutations(rows, repeats=3)
    per = {r.repeat: r for r in p.groupBy("repeat").agg(F.count("*").alias("n"), F.count_distinct("_rid").alias("a"), F.count_distinct("_partner").alias("b"),
                                                       F.count_if(F.col("_rid") == F.col("_partner")).alias("same")).collect()}
    assert len(per) == 3 and all(r.n == r.a == r.b == n for r in per.values())
    assert all(r.same <= 6 for r in per.values())  # Poisson of mean 1 at every size


def test_correlation_is_pairwise(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(60, 3)), columns=list("abc"))
    pdf["b"] += pdf.a
    pdf.loc[::3, "c"] = np.nan
    pdf["d"] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.itertuples(index=False)],
                               "a double, b double, c double, d double")
    got = {(r.feature_a, r.feature_b): r["corr"] for r in X.feature_correlation(df, list("abcd")).collect()}
    want = pdf.corr()
    assert len(got) == 16 and got["a", "d"] is None
    for a in "abc":
        for b in "abc":
            assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-12)


def test_shapley_of_a_linear_score_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([("s", i, *map(float, rng.normal(size=3))) for i in range(200)], "symbol string, date int, a double, b double, c double")
    coef = {"a": 2.0, "b": -1.0, "c": 0.0}
    score = lambda df: df.withColumn("p_up", sum(F.lit(v) * F.col(f) for f, v in coef.items()))
    got = {r.feature: r.mean_abs_shap for r in X.sampled_shapley(score, rows, list("abc"), samples=4).collect()}
    pdf = rows.toPandas()
    pdf["rid"] = pdf.symbol + "|" + pdf.date.astype(str)
    p = X.permutations(rows, repeats=4).toPandas()
    v = pdf.set_index("rid")
    for f, c in coef.items():
        d = pd.Series(c * (v.loc[p._rid, f].to_numpy() - v.loc[p._partner, f].to_numpy()), index=p._rid)
        assert got[f] == pytest.approx(d.groupby(level=0).mean().abs().mean(), abs=1e-12)


def test_no_single_partition_sort(spark):
    rows = spark.range(100).select(F.lit("s").alias("symbol"), F.col("id").alias("date"), F.col("id").cast("double").alias("a"))
    score = lambda df: df.withColumn("p_up", F.col("a"))
    plan = X.sampled_shapley(score, rows, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_strict_mode_counts_and_lists_every_failure(spark):
    bars = spark.range(60).select(F.concat(F.lit("s"), F.col("id")).alias("symbol"), F.lit(DAY).alias("date"),
                                  *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "adj_close")], F.lit(1).cast("bigint").alias("volume"))
    with pytest.raises(Q.DataValidationError, match="60 symbol") as e:
        Q.assert_valid(Q.validation_report(bars))
    path = str(e.value).split("listed in ")[1].split(";")[0]
    assert spark.read.parquet(path).count() == 60


def test_schema_faults_fail_every_symbol_without_raising(spark, bars):
    r = Q.validation_report(bars.drop("volume")).collect()
    assert len(r) == 5 and not any(x.passed for x in r) and "volume" in r[0].message
    r = Q.validation_report(bars.withColumn("date", F.col("date").cast("string"))).first()
    assert not r.passed and "not a date" in r.message


def test_order_of_ingest(spark):
    rows = [("a", DAY + datetime.timedelta(d), i) for i, d in enumerate([0, 1, 3, 2, 4])] + [("b", DAY, 0)]
    got = {r.symbol: r.out_of_order for r in Q.out_of_order(spark.createDataFrame(rows, "symbol string, date date, seq int"), "seq").collect()}
    assert got == {"a": 1, "b": 0}


def test_short_symbols_are_reported_not_lost(spark):
    df = spark.range(40).select(F.lit("short").alias("symbol"), F.col("id").alias("date"))
    assert [tuple(r) for r in SP.split_failures(SP.split_by_rows(df)).collect()] == [("short", f"40 rows, a split takes {SP.C.MIN_SPLIT_ROWS}")]


def test_ties_go_to_the_first_listed_model(spark):
    df = spark.createDataFrame([("zeta", 0.6, 0.5), ("gradient_boosting", 0.6, 0.5), ("random_forest", 0.6, 0.5), ("logistic_regression", None, 0.9)],
                               "model_key string, roc_auc double, accuracy double")
    assert R.best_model(df).first()[0] == "random_forest"


def _toy(spark, n=400):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=n) > 0).astype(int)
    split = np.where(np.arange(n) < 0.6 * n, "train", np.where(np.arange(n) < 0.8 * n, "validation", "test"))
    rows = [("s", DAY + datetime.timedelta(i), float(x[i, 0]), float(x[i, 1]), int(y[i]), str(split[i])) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, date date, f0 double, f1 double, target_up_next_day int, split string")


def test_every_model_can_be_saved_and_loaded(spark):
    from pyspark.ml import PipelineModel
    small = {"random_forest": {"trees": 3}, "gradient_boosting": {"iters": 2}, "boosted_trees_colsample": {"iters": 2}, "rff_svm": {"components": 16}}
    df = _toy(spark)
    trained, outcomes = ML.run_panel_experiment(df, ["f0", "f1"], [*ML.SPECS, "nope"], small)
    assert [o.status for o in outcomes] == ["trained"] * 5 + ["unknown"]
    out = tempfile.mkdtemp(prefix="barframe-models-")
    test = df.filter("split = 'test'")
    for key, tm in trained.items():
        ML.save_model(tm, f"{out}/{key}", ["f0", "f1"], trained_on=df)
        back = ML.probability_of_up(PipelineModel.load(f"{out}/{key}/pipeline").transform(test))
        a, b = (x.orderBy("date").select("p_up").toPandas().p_up for x in (back, tm.scorer(test)))
        np.testing.assert_allclose(a, b)
        assert tm.test_metrics.first().roc_auc > 0.7


def test_failures_do_not_end_a_run(spark):
    df = _toy(spark)
    broken = df.withColumn("symbol", F.lit("broken")).withColumn("target_up_next_day", F.lit(1))
    preds, failures = ML.logistic_per_symbol(df.unionByName(broken), ["f0", "f1"])
    assert {r.symbol for r in preds.select("symbol").distinct().collect()} == {"s"}
    assert [tuple(r) for r in failures.collect()] == [("broken", "one class only in the fit rows")]
    cv = ML.cv_scores(ML.SPECS["logistic_regression"], df.filter("date < '2000-02-01'").withColumn("f0", F.lit("text")), ["f0"], 2).collect()
    assert len(cv) == 2 and all(r.failure and r.n_scored == 0 for r in cv)
    with pytest.raises(RuntimeError):
        ML.run_panel_experiment(df, ["f0"], ["nope"])


def test_per_symbol_fit_matches_a_reference_solver(spark):
    """At the optimum the gradient of the penalised loss vanishes; MLlib's optimum gives the same probabilities."""
    df = _toy(spark)
    preds, _ = ML.logistic_per_symbol(df, ["f0", "f1"])
    tm = ML.train_single_model(ML.SPECS["logistic_regression"], df, ["f0", "f1"])
    a = preds.orderBy("date").toPandas().p_up
    b = tm.test_predictions.orderBy("date").toPandas().p_up
    np.testing.assert_allclose(a, b, atol=2e-3)
