"""Result tables of an experiment: comparison table, per-symbol rows and the
per-model summaries (O5-O8, A14-A16, R5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.selection import medians
from ..session import cut_lineage
from . import metrics as M


def comparison_table(models: DataFrame, baselines: DataFrame) -> DataFrame:
    """Model rows and baseline rows in one table (ordered by test
    ROC-AUC desc, nulls last, when displayed)."""
    m = models.select("model_key", F.col("accuracy").alias("test_accuracy"),
                      F.col("precision").alias("test_precision"), F.col("recall").alias("test_recall"),
                      F.col("f1").alias("test_f1"), F.col("roc_auc").alias("test_roc_auc"))
    b = baselines.select("model_key", F.col("accuracy").alias("test_accuracy"),
                         F.col("precision").alias("test_precision"), F.col("recall").alias("test_recall"),
                         F.col("f1").alias("test_f1"), F.lit(None).cast("double").alias("test_roc_auc"))
    return m.unionByName(b).withColumn("is_baseline", F.col("model_key").startswith("baseline_"))


def full_comparison(models: DataFrame, baselines: DataFrame) -> DataFrame:
    """O5 / E9 with every column: model rows (``sweep.model_rows``) and baselines, whose fit columns are null."""
    name = F.concat(F.lit("Baseline: "), F.translate(F.regexp_replace("model_key", "^baseline_", ""), "_", " "))
    base = baselines.select("model_key", name.alias("model"), F.col("support").alias("observations"),
                            *[F.col(c).alias(f"test_{c}") for c in ("accuracy", "precision", "recall", "f1")])
    both = models.drop("grp").unionByName(base, allowMissingColumns=True)
    return both.withColumn("is_baseline", F.col("model_key").startswith("baseline_"))


def ordered(table: DataFrame) -> DataFrame:
    return table.orderBy(F.col("test_roc_auc").desc_nulls_last())


#: Rank of the models where scores tie: the first listed wins, unknown keys last by name.
MODEL_ORDER = ("logistic_regression", "random_forest", "gradient_boosting", "boosted_trees_colsample", "rff_svm")


def _best_first(*scores) -> list:
    place = F.coalesce(F.element_at(F.create_map(*[x for i, k in enumerate(MODEL_ORDER) for x in (F.lit(k), F.lit(i))]),
                                    F.col("model_key")), F.lit(len(MODEL_ORDER)))
    return [*[s.desc() for s in scores], place.asc(), F.col("model_key").asc()]


def best_model(models: DataFrame) -> DataFrame:
    """Largest (roc_auc or 0, accuracy); ties to the first in ``MODEL_ORDER``."""
    order = _best_first(F.coalesce("roc_auc", F.lit(0.0)), F.col("accuracy"))
    return models.orderBy(*order).limit(1).select(F.col("model_key").alias("best_model_key"))


def per_symbol_rows(cards: DataFrame, split_df: DataFrame, y: str = "y") -> DataFrame:
    """The per-symbol sweep table: every (symbol, model) test score with both
    baseline accuracies on the same window."""
    bp = M.baseline_predictions(split_df, ["symbol"], y)
    acc = bp.groupBy("symbol").agg(
        F.avg(F.when(F.col("model_key") == "baseline_majority_class",
                     (F.col(y) == F.col("pred")).cast("double"))).alias("majority_baseline_accuracy"),
        F.avg(F.when(F.col("model_key") == "baseline_momentum_persistence",
                     (F.col(y) == F.col("pred")).cast("double"))).alias("momentum_baseline_accuracy"))
    return cards.select("symbol", "model_key", F.col("support").alias("observations"),
                        F.col("accuracy").alias("test_accuracy"), F.col("f1").alias("test_f1"),
                        F.col("roc_auc").alias("test_roc_auc")).join(acc, "symbol")


def best_per_symbol(rows: DataFrame) -> DataFrame:
    """W17 + A16: best model per symbol by test AUC (selection-biased) and the
    median of those AUCs."""
    w = Window.partitionBy("symbol").orderBy(F.col("test_roc_auc").desc_nulls_last(), "model_key")
    best = cut_lineage(rows.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1"), "best")
    median = medians(best.select(F.lit("all").alias("_all"), "test_roc_auc"), ["_all"], ["test_roc_auc"]).first()  # one number
    return best.select("symbol", "model_key", "test_roc_auc", F.lit(median.test_roc_auc if median else None).cast("double").alias("biased_median_auc"))


def model_summary(rows: DataFrame) -> DataFrame:
    """A14 + A15: per-model medians and shares across symbols."""
    auc = F.col("test_roc_auc")
    middle = {"test_roc_auc": "median_test_roc_auc", "test_accuracy": "median_test_accuracy", "test_f1": "median_test_f1",
              "majority_baseline_accuracy": "median_majority_baseline", "momentum_baseline_accuracy": "median_momentum_baseline"}
    rows = cut_lineage(rows.select("model_key", *middle), "summary")
    shares = rows.groupBy("model_key").agg(
        F.count("*").alias("n_symbols"), F.avg(auc).alias("mean_test_roc_auc"),
        F.avg(F.when(auc.isNotNull(), (auc > 0.5).cast("double"))).alias("share_above_half_auc"),
        F.avg((F.col("test_accuracy") > F.col("majority_baseline_accuracy")).cast("double")).alias("share_beating_majority"))
    return shares.join(medians(rows, ["model_key"], list(middle)).withColumnsRenamed(middle), "model_key")


def strongest_model(summary: DataFrame) -> DataFrame:
    """O8."""
    order = _best_first(F.coalesce("median_test_roc_auc", F.lit(0.0)))
    return summary.orderBy(*order).limit(1).select(F.col("model_key").alias("strongest_model_key"),
                                                   F.col("median_test_roc_auc").alias("strongest_median_test_roc_auc"))


def comparison_series(table: DataFrame, metric: str = "test_roc_auc") -> DataFrame:
    """Chart rows with a non-null metric and a baseline flag."""
    return table.filter(F.col(metric).isNotNull()).select(
        "model_key", metric, F.col("model_key").startswith("baseline_").alias("is_baseline"))


def best_baseline_accuracy(baselines: DataFrame) -> DataFrame:
    """O7."""
    return baselines.agg(F.max("accuracy").alias("best_baseline_accuracy"))


def verdict(models: DataFrame, baselines: DataFrame) -> DataFrame:
    """The best model (O6 order: AUC or 0, then accuracy) against the
    strongest naive rule on the same test window."""
    order = _best_first(F.coalesce("roc_auc", F.lit(0.0)), F.col("accuracy"))
    naive = best_baseline_accuracy(baselines).first().best_baseline_accuracy  # one number
    best = models.orderBy(*order).limit(1).select(F.col("model_key").alias("best_model_key"), F.col("accuracy").alias("best_model_accuracy"),
                                                  F.lit(naive).cast("double").alias("best_baseline_accuracy"))
    return best.withColumn("beats_baselines", F.col("best_model_accuracy") > F.col("best_baseline_accuracy"))


def write_report(tables: dict[str, DataFrame], out_dir: str, fmt: str = "json") -> None:
    """Every result table written under ``out_dir/<name>`` (small tables
    go to one file each)."""
    for name, df in tables.items():
        w = df.coalesce(1).write.mode("overwrite")
        (w.json if fmt == "json" else w.parquet)(f"{out_dir}/{name}")
