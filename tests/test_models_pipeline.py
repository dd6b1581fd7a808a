"""End-to-end training on driver bars (small model settings), sources and streaming."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from barframe.operators import models as ML
from barframe.operators.features import ALL_FEATURES

SMALL = {"random_forest": {"trees": 20}, "gradient_boosting": {"iters": 10},
         "boosted_trees_colsample": {"iters": 10}, "rff_svm": {"components": 32}}


@pytest.fixture(scope="module")
def panel(spark, bars):
    from barframe.plans.experiment import run_panel
    return run_panel(spark, bars, model_keys=("logistic_regression", "gradient_boosting", "nope"),
                     overrides=SMALL, min_coverage=0.5, require_span=False)


def test_panel_tables(panel):
    t = panel.tables
    comp = t["comparison"].toPandas()
    assert {"logistic_regression", "gradient_boosting", "baseline_majority_class",
            "baseline_momentum_persistence"} <= set(comp.model_key)
    assert comp.test_accuracy.between(0, 1).all()
    assert any("nope" in w for w in panel.warnings)
    assert t["verdict"].count() == 1
    assert t["importance"].count() == 15
    assert t["signal_study"].first().observations > 0
    sizes = {r.split: r.rows for r in t["split_sizes"].collect()}
    assert set(sizes) == {"train", "validation", "test"}


def test_probabilities_are_probabilities(panel):
    p = panel.trained["logistic_regression"].test_predictions
    lo, hi = p.agg(F.min("p_up"), F.max("p_up")).first()
    assert 0.0 <= lo <= hi <= 1.0


def test_registry(spark):
    assert set(ML.PANEL_MODELS) <= set(ML.available_models())
    with pytest.raises(KeyError):
        ML.get_model_spec("unknown")


def test_rff_svm_and_cv(spark, bars):
    from barframe.operators.features import feature_matrix
    from barframe.operators.splits import split_by_dates
    from barframe.plans.catalog import market_for
    from barframe.session import cut_lineage
    from barframe.operators.features import panel_features
    fm = cut_lineage(feature_matrix(bars, market_for(bars)))
    feats = panel_features(fm)
    ds = cut_lineage(split_by_dates(fm))
    tm = ML.train_single_model(ML.SPECS["rff_svm"], ds, feats, overrides={"components": 32})
    r = tm.test_metrics.first()
    assert 0 <= r.accuracy <= 1 and r.roc_auc is not None
    cv = ML.cv_scores(ML.SPECS["logistic_regression"], ds.filter("split = 'train'"), feats, 3)
    assert cv.count() == 3


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(1.0,)] * 70 + [(0.0,)] * 30, "label double")
    w = {r.label: r.weight for r in ML.with_class_weights(df).distinct().collect()}
    assert abs(w[1.0] * 70 + w[0.0] * 30 - 100) < 1e-9 and abs(w[0.0] - 100 / 60) < 1e-12


def test_symbol_file_reader(spark, bars):
    from barframe.sources.snapshot import read_symbol_files
    d = tempfile.mkdtemp(prefix="barframe-csv-")
    for sym, name in (("1-URGENT", "aaa"), ("2-HIGH", "bb.x")):
        pdf = bars.filter(F.col("symbol") == sym).select("date", "open", "high", "low", "close", "volume") \
            .toPandas()
        pdf = pdf._append(pdf.iloc[[0]])    # a duplicated date: keep the last one read
        pdf.assign(Name=name).to_csv(os.path.join(d, f"{name}_data.csv"), index=False)
    got = read_symbol_files(spark, d)
    assert {r.symbol for r in got.select("symbol").distinct().collect()} == {"AAA", "BB.X"}
    assert got.groupBy("symbol", "date").count().filter("count > 1").count() == 0


def test_stream_matches_batch(spark):
    from barframe.plans.catalog import QUERIES
    from conftest import SF_SMALL
    a = QUERIES["bars_hourly_stream"](spark, SF_SMALL)
    b = QUERIES["bars_hourly"](spark, SF_SMALL)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_report_and_model_sinks(spark, panel):
    """S13 + S14: result tables and the fitted pipeline round-trip through files."""
    from pyspark.ml import PipelineModel
    from barframe.operators.report import write_report
    out = tempfile.mkdtemp(prefix="barframe-report-")
    write_report({"comparison": panel.tables["comparison"], "verdict": panel.tables["verdict"]}, out)
    back = spark.read.json(f"{out}/comparison")
    assert back.count() == panel.tables["comparison"].count()
    tm = panel.trained["logistic_regression"]
    ML.save_model(tm, f"{out}/model", ["f"], symbols=["A"])
    loaded = PipelineModel.load(f"{out}/model/pipeline")
    assert len(loaded.stages) == len(tm.model.stages)
    meta = spark.read.json(f"{out}/model/metadata").first()
    assert meta.model_key == "logistic_regression" and meta.tickers == ["A"]


@pytest.mark.parametrize("broken", [None, "one class only in the fit rows"])
def test_panel_queries_compare_all_panel_models(spark, monkeypatch, broken):
    """The fits are stubs; every panel model is a candidate, and the one with the best scores wins."""
    from types import SimpleNamespace

    from barframe.operators import sweep as S
    from barframe.plans import queries_sweep as Q

    days = spark.range(40).select(F.lit("s").alias("symbol"), F.expr("date_add(date'2020-01-01', cast(id as int))").alias("date"), F.lit("panel").alias("panel"),
                                  F.when(F.col("id") < 30, "train").otherwise("test").alias("split"), (F.col("id") % 2).cast("int").alias("target_up_next_day"), F.lit(0.1).alias("daily_return"))
    found = SimpleNamespace(failures=spark.createDataFrame([("panel", broken)] if broken else [], "grp string, failure string"))
    score = {k: 0.9 if k == "gradient_boosting" else 0.5 for k in S.PANEL_MODELS}
    cards = spark.createDataFrame([("panel", k, S.NAMES[k], 10, *[v] * 7, v, 0.1, 5, 1.0) for k, v in score.items()],
                                  "grp string, model_key string, model string, observations bigint, val_accuracy double, val_roc_auc double, test_accuracy double, test_precision double, test_recall double, "
                                  "test_f1 double, test_roc_auc double, cv_roc_auc_mean double, cv_roc_auc_std double, n_scored bigint, fit_seconds double")
    monkeypatch.setattr(Q, "panel_sweep", lambda spark, sf: (found, days, []))
    monkeypatch.setattr(Q.S, "model_rows", lambda found: cards)
    monkeypatch.setattr(Q, "_DONE", {})
    if broken:
        with pytest.raises(RuntimeError, match=broken):
            Q.q_verdict(spark, "x")
        return
    rows = {r.model_key: r for r in Q.q_panel_comparison(spark, "x").collect()}
    assert set(rows) == set(S.PANEL_MODELS) | {"baseline_majority_class", "baseline_momentum_persistence"}
    assert rows["baseline_majority_class"].model == "Baseline: majority class" and rows["baseline_majority_class"].val_accuracy is None
    assert rows["gradient_boosting"].cv_roc_auc_mean == 0.9 and not rows["gradient_boosting"].is_baseline
    verdict = Q.q_verdict(spark, "x").first()
    assert verdict.best_model_key == "gradient_boosting" and verdict.beats_baselines
