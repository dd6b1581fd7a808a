"""Classification metrics, tie-aware ROC-AUC, ROC points and the baselines.

Everything is a grouped aggregate keyed by ``group`` columns (model, split,
symbol, ...), so one pass scores every model and symbol at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage

#: Score ranges of a group in the prefix sums of the ROC table.
SCORE_RANGES = 256


def deterministic_score(close_to_sma20: str = "close_to_sma20",
                        slope: float = C.SCORE_SLOPE) -> Column:
    """A fixed, model-free P(up) used to exercise metrics and the signal
    study: ``1 / (1 + exp(-slope * close_to_sma20))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.lit(slope) * F.col(close_to_sma20)))


def threshold(p: str = "p_up", cut: float = 0.5) -> Column:
    """The positive class is ``p >= 0.5`` (not Spark ML's ``p > t``)."""
    return (F.col(p) >= F.lit(cut)).cast("int")


def scorecard(df: DataFrame, group: list[str], y: str = "y", pred: str = "pred",
              proba: str | None = "p_up") -> DataFrame:
    """E1 + E2: accuracy, precision, recall, f1 (0 when undefined), roc_auc
    (null for one class or no probabilities), support, rates."""
    yy, pp = F.col(y).cast("int"), F.col(pred).cast("int")
    counts = df.groupBy(*group).agg(
        F.count_if((yy == 1) & (pp == 1)).alias("tp"), F.count_if((yy == 0) & (pp == 1)).alias("fp"),
        F.count_if((yy == 1) & (pp == 0)).alias("fn"), F.count_if((yy == 0) & (pp == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    out = counts.select(
        *group,
        ((tp + tn) / n).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"),
        n.cast("bigint").alias("support"),
        ((tp + fn) / n).alias("positive_rate"),
        ((tp + fp) / n).alias("predicted_positive_rate"))
    if proba is None:
        return out.withColumn("roc_auc", F.lit(None).cast("double"))
    return out.join(roc_auc(df, group, y, proba), group, "left")


def _score_table(df: DataFrame, group: list[str], y: str, proba: str,
                 buckets: int = SCORE_RANGES) -> DataFrame:
    """Distinct scores per group with (pos, neg) counts, plus the number of
    negatives / positives strictly below each score.

    Ties collapse in a map-side combined aggregate first. Each group is cut at
    approximate quantiles into ``buckets`` ranges: the range totals form a small
    table whose prefix sums give each range's offset, and the exact prefix inside
    a range is a window over that range only, so a large group spreads over many
    tasks. The plan is the same for every size.
    """
    if not group:
        raise ValueError("group by at least one column (use a constant column for a single group)")
    yy = F.col(y).cast("int")
    agg = df.filter(F.col(proba).isNotNull() & yy.isNotNull()).groupBy(*group, proba).agg(
        F.count_if(yy == 1).alias("pos"), F.count_if(yy == 0).alias("neg"))
    qs = [i / buckets for i in range(1, buckets)]
    bounds = agg.groupBy(*group).agg(F.percentile_approx(proba, qs, 10000).alias("_bounds") if qs else
                                     F.array().cast("array<double>").alias("_bounds"))
    agg = agg.join(bounds, group)
    agg = agg.withColumn("_bucket", F.size(F.filter("_bounds", lambda b: b < F.col(proba)))).drop("_bounds")
    totals = agg.groupBy(*group, "_bucket").agg(F.sum("neg").alias("_bneg"), F.sum("pos").alias("_bpos"))
    wb = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*group, "_bucket",
                           F.coalesce(F.sum("_bneg").over(wb), F.lit(0)).alias("_neg_before"),
                           F.coalesce(F.sum("_bpos").over(wb), F.lit(0)).alias("_pos_before"))
    wi = Window.partitionBy(*group, "_bucket").orderBy(proba).rowsBetween(Window.unboundedPreceding, -1)
    agg = agg.select("*", F.coalesce(F.sum("neg").over(wi), F.lit(0)).alias("_neg_in"),
                     F.coalesce(F.sum("pos").over(wi), F.lit(0)).alias("_pos_in"))
    agg = agg.join(totals, group + ["_bucket"])
    return agg.select(*group, proba, "_bucket", "pos", "neg",
                      (F.col("_neg_before") + F.col("_neg_in")).alias("neg_below"),
                      (F.col("_pos_before") + F.col("_pos_in")).alias("pos_below"))


def roc_auc(df: DataFrame, group: list[str], y: str = "y", proba: str = "p_up") -> DataFrame:
    """E5: ``sum(pos * (neg_below + neg / 2)) / (P * N)``; null for one class."""
    t = _score_table(df, group, y, proba)
    auc = t.groupBy(*group).agg(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)).alias("_num"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return auc.select(*group, F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                                     F.col("_num") / (F.col("_p") * F.col("_n"))).alias("roc_auc"))


def roc_points(df: DataFrame, group: list[str], y: str = "y", proba: str = "p_up", drop_collinear: bool = False) -> DataFrame:
    """One (fpr, tpr) point per distinct threshold ``score >= p`` plus (0, 0).

    ``drop_collinear`` leaves out the points that lie on the line between their
    neighbours, as usual for a curve that is drawn: where the step to a point, in positives
    and negatives, equals the step from it. Exact counts decide; the ends stay."""
    t = _score_table(df, group, y, proba)
    if drop_collinear:
        t = cut_lineage(t, "scores")
    tot = t.groupBy(*group).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    t = (_with_lower(t, group, proba) if drop_collinear else t).join(tot, group)
    if drop_collinear:
        top = (F.col("pos") + F.col("pos_below") == F.col("_P")) & (F.col("neg") + F.col("neg_below") == F.col("_N"))
        t = t.where(top | F.col("_lower").isNull() | (F.col("_lower.pos") != F.col("pos")) | (F.col("_lower.neg") != F.col("neg")))
    pts = t.select(*group, F.col(proba).alias("threshold"),
                   F.try_divide(F.col("_N") - F.col("neg_below"), F.col("_N")).alias("fpr"),
                   F.try_divide(F.col("_P") - F.col("pos_below"), F.col("_P")).alias("tpr"))
    origin = tot.select(*group, F.lit(None).cast("double").alias("threshold"),
                        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def _with_lower(t: DataFrame, group: list[str], proba: str) -> DataFrame:
    """Adds ``_lower``, the counts (pos, neg) at the next lower score of a written score table, null at the lowest.

    Neighbours are found within the range that the table was built by; the first
    row of a range gets the last one of the ranges below, a row per range."""
    inside = Window.partitionBy(*group, "_bucket").orderBy(proba)
    last = t.groupBy(*group, "_bucket").agg(F.max_by(F.struct("pos", "neg"), proba).alias("_below"))
    last = last.select(*group, "_bucket", F.lag("_below").over(Window.partitionBy(*group).orderBy("_bucket")).alias("_below"))
    found = t.join(last, [*group, "_bucket"])
    return found.withColumn("_lower", F.coalesce(F.lag(F.struct("pos", "neg")).over(inside), F.col("_below"))).drop("_below")


def confusion(df: DataFrame, group: list[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """2x2 counts in long form (actual, predicted, count), zero-filled."""
    yy, pp = F.col(y).cast("int"), F.col(pred).cast("int")
    c = df.groupBy(*group).agg(*[F.count_if((yy == a) & (pp == b)).alias(f"c{a}{b}")
                                 for a in (0, 1) for b in (0, 1)])
    return c.selectExpr(*[f"`{g}`" for g in group],
                        "stack(4, 0, 0, c00, 0, 1, c01, 1, 0, c10, 1, 1, c11) AS (actual, predicted, count)")


def majority_class(train: DataFrame, group: list[str], y: str = "y") -> DataFrame:
    """Mode of the training labels, ties to the smaller class."""
    return train.groupBy(*group).agg(
        F.when(F.avg(F.col(y).cast("double")) > 0.5, F.lit(1)).otherwise(F.lit(0)).alias("majority"))


def baseline_predictions(split_df: DataFrame, group: list[str], y: str = "y",
                         daily_return: str = "daily_return") -> DataFrame:
    """E6 + E7 on the test rows: majority class of the train rows, and
    momentum persistence ``daily_return > 0`` (missing -> 0)."""
    if not group:
        raise ValueError("group by at least one column (use a constant column for a single group)")
    maj = majority_class(split_df.filter(F.col("split") == "train"), group, y)
    test = split_df.filter(F.col("split") == "test")
    test = test.join(maj, group, "left")
    mom = test.select(*group, y, F.lit("baseline_momentum_persistence").alias("model_key"),
                      F.coalesce((F.col(daily_return) > 0).cast("int"), F.lit(0)).alias("pred"))
    majp = test.select(*group, y, F.lit("baseline_majority_class").alias("model_key"),
                       F.coalesce(F.col("majority"), F.lit(0)).alias("pred"))
    return mom.unionByName(majp)
