"""Experiments with every model: the sweep over symbols and the pooled panel.

A sweep is fitted once per session and data folder; its written predictions, trees
and coefficients serve all queries below. Fits have no SQL twin: they are checked
against MLlib and brute-force trees in the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators import explain as X
from ..operators import features as FE
from ..operators import grouped as G
from ..operators import grouped_trees as T
from ..operators import metrics as M
from ..operators import report as R
from ..operators import splits as SP
from ..operators import sweep as S
from ..session import cut_lineage
from .catalog import bars_once, market_for, register, rounded

_DONE: dict[tuple, tuple] = {}


def _once(kind: str, spark, sf, make):
    key = (kind, spark.sparkContext.applicationId, sf)
    if key not in _DONE:
        _DONE[key] = make()
    return _DONE[key]


def _matrix(spark, sf) -> tuple[DataFrame, list[str]]:
    bars = bars_once(spark, sf)
    fm = cut_lineage(FE.feature_matrix(bars, market_for(bars)), "matrix")
    return fm, FE.panel_features(fm)


def symbol_sweep(spark, sf) -> tuple[S.Sweep, DataFrame, DataFrame]:
    """(sweep, split rows, split failures): all models on every symbol's own rows."""
    def make():
        fm, feats = _matrix(spark, sf)
        rows = cut_lineage(SP.split_by_rows(fm), "split")
        return S.sweep(rows.where("split IS NOT NULL"), feats), rows, SP.split_failures(rows)
    return _once("symbols", spark, sf, make)


def panel_sweep(spark, sf) -> tuple[S.Sweep, DataFrame, list[str]]:
    """(sweep, split rows, features): the panel models on all symbols together, cross-validated."""
    def make():
        fm, feats = _matrix(spark, sf)
        rows = cut_lineage(SP.split_by_dates(fm).withColumn("panel", F.lit("panel")), "split")
        return S.sweep(rows, feats, "panel", S.PANEL_MODELS, C.CV_SPLITS), rows, feats
    return _once("panel", spark, sf, make)


def sweep_rows(spark, sf) -> DataFrame:
    """(symbol, model_key, scores, both baselines' accuracy) of the sweep."""
    found, rows, _ = symbol_sweep(spark, sf)
    cards = S.model_rows(found).withColumnRenamed("grp", "symbol")
    base = M.baseline_predictions(rows.where("split IS NOT NULL").withColumn("y", F.col(C.TARGET_COLUMN)), ["symbol"])
    hit = (F.col("y") == F.col("pred")).cast("double")
    acc = base.groupBy("symbol").agg(F.avg(F.when(F.col("model_key") == "baseline_majority_class", hit)).alias("majority_baseline_accuracy"),
                                     F.avg(F.when(F.col("model_key") == "baseline_momentum_persistence", hit)).alias("momentum_baseline_accuracy"))
    return cards.drop("fit_seconds", "cv_roc_auc_mean", "cv_roc_auc_std", "n_scored").join(acc, "symbol")


@register("per_symbol_sweep", None)
def q_per_symbol_sweep(spark, sf):
    """A row per (symbol, model) with validation and test scores and both
    baselines, and a row with the reason for every symbol that could not be fitted."""
    found, _, short = symbol_sweep(spark, sf)
    failures = found.failures.withColumnRenamed("grp", "symbol").unionByName(short.withColumnRenamed("reason", "failure"))
    return rounded(sweep_rows(spark, sf).withColumn("failure", F.lit(None).cast("string")).unionByName(failures, allowMissingColumns=True))


@register("sweep_summary", None)
def q_sweep_summary(spark, sf):
    """A14-A16, O8 over the sweep: medians and shares of each model, and which is the strongest."""
    table = cut_lineage(sweep_rows(spark, sf), "sweep")
    summary = cut_lineage(R.model_summary(table), "summary")
    return rounded(summary.join(R.strongest_model(summary).select(F.col("strongest_model_key").alias("model_key"), F.lit(True).alias("strongest")), "model_key", "left")
                   .withColumn("strongest", F.coalesce("strongest", F.lit(False))))


@register("sweep_best", None)
def q_sweep_best(spark, sf):
    """W17 + A16 over the sweep: each symbol's best model (chosen on the test rows, so biased) and their median."""
    return rounded(R.best_per_symbol(sweep_rows(spark, sf)))


def _panel_tables(spark, sf) -> tuple[DataFrame, DataFrame]:
    found, rows, _ = panel_sweep(spark, sf)
    missing = found.failures.first()
    if missing is not None:
        raise RuntimeError(f"the panel can't be fitted: {missing.failure}")
    models = _once("panel rows", spark, sf, lambda: cut_lineage(S.model_rows(found), "rows"))
    base = M.scorecard(M.baseline_predictions(rows.withColumn("y", F.col(C.TARGET_COLUMN)), ["panel"]), ["model_key"], proba=None)
    return models, base


@register("panel_comparison", None)
def q_panel_comparison(spark, sf):
    """M9 + O5 + E8 / E9: the panel models with validation, fold and test scores, and both baselines."""
    models, base = _panel_tables(spark, sf)
    return rounded(R.full_comparison(models, base))


@register("verdict", None)
def q_verdict(spark, sf):
    """Best of the panel models against the strongest baseline."""
    models, base = _panel_tables(spark, sf)
    return rounded(R.verdict(models.select("model_key", F.col("test_accuracy").alias("accuracy"), F.col("test_roc_auc").alias("roc_auc")), base))


@register("cv_scores", None)
def q_cv_scores(spark, sf):
    """L4: expanding-window CV of all panel models over the training sessions; one pass an iteration serves all folds."""
    found, _, _ = panel_sweep(spark, sf)
    cards = cut_lineage(S.scorecards(found.predictions.where(F.col("fit") >= G.FOLD)), "cards")
    return rounded(cards.select("model_key", (F.col("fit") - G.FOLD + 1).alias("fold"), "support", "roc_auc").join(S.fold_scores(cards).drop("grp"), "model_key"))


@register("tree_importance", None)
def q_tree_importance(spark, sf):
    """I1 / O3 of the panel's fitted ensembles: the largest shares of their splits' gains."""
    found, _, feats = panel_sweep(spark, sf)
    keys = F.create_map(*[x for s in (T.FOREST, T.GRADIENT, T.COLSAMPLE) for x in (F.lit(s.number), F.lit(s.key))])
    shares = T.importances(found.trees.where(F.col("fit") == G.FINAL), feats).select(F.element_at(keys, F.col("model")).alias("model_key"), "feature", "importance")
    best = Window.partitionBy("model_key").orderBy(F.col("importance").desc(), "feature")
    return rounded(shares.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= C.IMPORTANCE_TOP_N))


@register("fitted_permutation_importance", None)
def q_fitted_permutation_importance(spark, sf):
    """I2 of the panel's fitted logistic regression over all test rows."""
    found, rows, feats = panel_sweep(spark, sf)
    m = found.linear.where(F.col("fit") == G.FINAL).first()  # one model: a number per feature

    def score(df: DataFrame) -> DataFrame:
        z = F.lit(m.beta[-1])
        for f, b, mean, sd in zip(feats, m.beta, m.mean, m.sd):
            z = z + F.lit(b / sd) * (F.col(f) - F.lit(mean))
        return df.withColumn("p_up", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    test = cut_lineage(rows.where("split = 'test'").select("symbol", "date", F.col(C.TARGET_COLUMN).cast("double").alias("label"), *feats), "test")
    return rounded(X.permutation_importance(score, test, feats))
