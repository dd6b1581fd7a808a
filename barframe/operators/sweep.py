"""Every model on every group: a sweep over symbols, or the pooled panel as one group.

The rows are split and packed once; each model family reads the same blocks and
fits all groups, both parts of the split and the folds together (``grouped``,
``grouped_trees``). A group that can't be fitted is a row with its reason.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage
from . import grouped as G
from . import grouped_trees as T
from . import metrics as M

#: Display names of the models, best known first where scores tie.
NAMES = {"logistic_regression": "Logistic Regression", "random_forest": "Random Forest", "gradient_boosting": "Gradient Boosting",
         "boosted_trees_colsample": "Boosted Trees (column sampling)", "rff_svm": "RBF-approximate SVM"}
PANEL_MODELS = tuple(NAMES)[:4]


@dataclass
class Sweep:
    """predictions: (grp, symbol, date, model_key, fit, y, p_up); failures: (grp, failure);
    seconds: of each model's fits; trees: ``SPLIT`` rows of the ensembles; linear: models of the logistic regression."""

    predictions: DataFrame
    failures: DataFrame
    seconds: dict[str, float]
    trees: DataFrame | None
    linear: DataFrame | None


def group_failures(rows: DataFrame, group: str, target: str) -> DataFrame:
    """(grp, failure) of groups without test rows, or with one class only in a training set."""
    y = F.col(target) == 1
    counts = []
    for fit in (G.TRAIN, G.FINAL):
        inside = F.getbit("fits", F.lit(fit)) == 1
        counts += [F.count_if(inside).alias(f"n{fit}"), F.count_if(inside & y).alias(f"up{fit}")]
    found = rows.groupBy(F.col(group).cast("string").alias("grp")).agg(*counts, F.count_if(F.getbit("scored", F.lit(G.FINAL)) == 1).alias("tests"))
    one = (F.col("up0") == 0) | (F.col("up0") == F.col("n0")) | (F.col("up1") == 0) | (F.col("up1") == F.col("n1"))
    why = F.when(F.col("tests") == 0, "no test rows").when(one, "one class only in the fit rows")
    return found.select("grp", why.alias("failure")).where("failure IS NOT NULL")


def sweep(split_df: DataFrame, features: list[str], group: str = "symbol", models=tuple(NAMES), n_splits: int = 0,
          target: str = C.TARGET_COLUMN, forest: T.Trees = T.FOREST, boosted: tuple[T.Trees, ...] = (T.GRADIENT, T.COLSAMPLE),
          svm: G.Linear = G.SVM) -> Sweep:
    """The models of all groups of (symbol, date, split, target, features) rows.

    Each is fitted on train and scored on validation, refitted on both and scored on test, and
    on ``n_splits`` expanding folds of the training sessions (0: none)."""
    unknown = set(models) - set(NAMES)
    if unknown:
        raise KeyError(f"unknown models {sorted(unknown)}; known are {sorted(NAMES)}")
    rows = cut_lineage(G.with_masks(split_df, group, n_splits), "masked")
    date_type = rows.schema["date"].dataType.simpleString()
    failures = cut_lineage(group_failures(rows, group, target), "failures")
    rows = rows.join(failures.select(F.col("grp").alias(group)), group, "left_anti")
    blocks = G.feature_blocks(rows, features, group, target)
    fits = [G.TRAIN, G.FINAL, *range(G.FOLD, G.FOLD + n_splits)]
    scores, seconds, trees, linear = [], {}, None, None

    def keep(key: str, found: DataFrame, started: float) -> None:
        scores.append(cut_lineage(G.predictions(found, date_type, key), "scores"))
        seconds[key] = time.perf_counter() - started

    if "logistic_regression" in models:
        t0 = time.perf_counter()
        found, linear = G.logistic(blocks, fits)
        keep("logistic_regression", found, t0)
    wanted = [s for s in boosted if s.key in models]
    if wanted or forest.key in models:
        t0 = time.perf_counter()
        codes = T.binned(blocks, T.bin_edges(rows, features, group, fits))
        if forest.key in models:
            trees = T.fit_forest(codes, len(features), forest)
            keep(forest.key, T.score_forest(codes, trees, forest), t0)
        if wanted:
            t0 = time.perf_counter()
            splits, margins = T.fit_boosted(codes, len(features), wanted)
            trees = splits if trees is None else trees.unionByName(splits)
            both = T.score_boosted(codes, margins)
            for s in wanted:
                keep(s.key, both.where(F.col("model") == s.number), t0)
    if svm.key in models:
        t0 = time.perf_counter()
        found, _ = G.svm(blocks, svm)
        keep(svm.key, found, t0)
    predictions = scores[0]
    for s in scores[1:]:
        predictions = predictions.unionByName(s)
    return Sweep(predictions, failures, seconds, trees, linear)


def scorecards(predictions: DataFrame) -> DataFrame:
    """(grp, model_key, fit, accuracy, ..., roc_auc) of every fit's scored rows."""
    return M.scorecard(predictions.withColumn("pred", M.threshold("p_up")), ["grp", "model_key", "fit"])


def fold_scores(cards: DataFrame) -> DataFrame:
    """L4: (grp, model_key, cv_roc_auc_mean, cv_roc_auc_std, n_scored) over the folds that could be scored."""
    return cards.where(F.col("fit") >= G.FOLD).groupBy("grp", "model_key").agg(
        F.avg("roc_auc").alias("cv_roc_auc_mean"), F.stddev_pop("roc_auc").alias("cv_roc_auc_std"), F.count("roc_auc").alias("n_scored"))


def model_rows(found: Sweep) -> DataFrame:
    """A row per (grp, model) with validation, test and fold scores, display name and fit seconds."""
    cards = cut_lineage(scorecards(found.predictions), "cards")
    val = cards.where(F.col("fit") == G.TRAIN).select("grp", "model_key", F.col("accuracy").alias("val_accuracy"), F.col("roc_auc").alias("val_roc_auc"))
    test = cards.where(F.col("fit") == G.FINAL).select("grp", "model_key", F.col("support").alias("observations"), *[F.col(c).alias(f"test_{c}") for c in ("accuracy", "precision", "recall", "f1", "roc_auc")])
    names = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    seconds = F.create_map(*[F.lit(x) for kv in found.seconds.items() for x in kv])
    return (test.join(val, ["grp", "model_key"], "left").join(fold_scores(cards), ["grp", "model_key"], "left")
            .select("grp", "model_key", F.element_at(names, F.col("model_key")).alias("model"), "observations", "val_accuracy", "val_roc_auc",
                    "test_accuracy", "test_precision", "test_recall", "test_f1", "test_roc_auc", "cv_roc_auc_mean", "cv_roc_auc_std", F.coalesce("n_scored", F.lit(0)).alias("n_scored"),
                    F.element_at(seconds, F.col("model_key")).alias("fit_seconds")))
