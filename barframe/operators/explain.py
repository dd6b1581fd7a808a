"""Explainability tables: native importance, permutation importance and the
feature correlation matrix (I1-I5, A22, V13)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage
from . import metrics as M

#: Hex digits of a random key that name its range (16 ** 3 ranges).
RANGE_DIGITS = 3


def native_importance(spark: SparkSession, model: PipelineModel, features: list[str]) -> DataFrame | None:
    """Tree importances, or |coefficient| with its sign for linear models;
    None when the final stage has neither."""
    est = model.stages[-1]
    if hasattr(est, "featureImportances"):
        vals = est.featureImportances.toArray().tolist()
        rows = [(f, float(v), float(v)) for f, v in zip(features, vals)]
    elif hasattr(est, "coefficients") and getattr(est, "numClasses", 2) == 2 and \
            len(est.coefficients) == len(features):
        vals = est.coefficients.toArray().tolist()
        rows = [(f, abs(float(v)), float(v)) for f, v in zip(features, vals)]
    else:
        return None
    return spark.createDataFrame(rows, "feature string, importance double, signed_value double")


def random_ranks(rows: DataFrame, part: list[str], key: str, rank: str) -> DataFrame:
    """Adds the 1-based rank of ``key`` (uniform hex digits) within ``part``.

    The rank is the position inside the key's range plus the rows in the ranges
    before it: a window never holds more than one range of one part, so no
    task sorts a whole part."""
    rows = rows.withColumn("_range", F.substring(key, 1, RANGE_DIGITS))
    sizes = rows.groupBy(*part, "_range").agg(F.count("*").alias("_in"))
    before = Window.partitionBy(*part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*part, "_range", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*part, "_range").orderBy(key, "_rid"))
    return (rows.withColumn("_at", within).join(offsets, [*part, "_range"])
            .withColumn(rank, F.col("_at") + F.col("_before")).drop("_at", "_before", "_range"))


def permutations(test: DataFrame, repeats: int = C.PERMUTATION_REPEATS, seed: int = C.RANDOM_STATE,
                 keys: tuple[str, ...] = ("symbol", "date")) -> DataFrame:
    """(_rid, repeat, _partner): one random permutation of all rows per repeat.

    Two independent random orders of the rows are joined rank to rank. The
    orders are md5 keys of (row id, repeat), so a recomputed task draws the same."""
    rid = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    ids = test.select(rid.alias("_rid")).withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))

    def key(which: str):
        return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(which), F.col("repeat").cast("string"), F.col("_rid")))

    to = random_ranks(ids.withColumn("_key", key("to")), ["repeat"], "_key", "_k").drop("_key")
    source = random_ranks(ids.withColumn("_key", key("from")), ["repeat"], "_key", "_k")
    return to.join(source.select("repeat", "_k", F.col("_rid").alias("_partner")), ["repeat", "_k"]).drop("_k")


def permuted_copies(test: DataFrame, features: list[str], repeats: int = C.PERMUTATION_REPEATS,
                    seed: int = C.RANDOM_STATE, keys: tuple[str, ...] = ("symbol", "date")) -> DataFrame:
    """Rows x features x repeats, each copy with one column taken from its partner.

    One permutation of all rows per repeat serves every feature: the partner's
    row is joined once, and the copies per feature are made within the task."""
    rid = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    base = test.withColumn("_rid", rid)
    partner = base.select(F.col("_rid").alias("_partner"), *[F.col(f).alias(f"_p_{f}") for f in features])
    wide = permutations(test, repeats, seed, keys).join(base, "_rid").join(partner, "_partner")
    long = wide.withColumn("perm_feature", F.explode(F.array(*[F.lit(f) for f in features])))
    return long.select(*[F.when(F.col("perm_feature") == F.lit(c), F.col(f"_p_{c}")).otherwise(F.col(c)).alias(c)
                         if c in features else F.col(c) for c in base.columns if c != "_rid"],
                       "perm_feature", "repeat")


def permutation_importance(score, test: DataFrame, features: list[str], repeats: int = C.PERMUTATION_REPEATS,
                           seed: int = C.RANDOM_STATE, keys: tuple[str, ...] = ("symbol", "date")) -> DataFrame:
    """Mean and population std of the ROC-AUC drop when one column is
    shuffled. ``score(df)`` must add ``p_up`` (a fitted model's scorer)."""
    y = F.col("label").cast("int").alias("y")
    base = M.roc_auc(score(test).select(F.lit("all").alias("_all"), y, "p_up"), ["_all"]).first()
    # scored once, then the grouped aggregates read the written copy
    perm = cut_lineage(score(permuted_copies(test, features, repeats, seed, keys)).select("perm_feature", "repeat", y, "p_up"), "permuted")
    drops = M.roc_auc(perm, ["perm_feature", "repeat"]).withColumn(
        "drop", F.lit(base.roc_auc if base else None).cast("double") - F.col("roc_auc"))
    return drops.groupBy(F.col("perm_feature").alias("feature")).agg(
        F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("std"),
        F.avg("drop").alias("signed_value"))


def top_features(spark: SparkSession, model: PipelineModel, features: list[str], score=None,
                 test: DataFrame | None = None, top_n: int = 10) -> tuple[DataFrame, str]:
    """Native importance when available, permutation otherwise."""
    frame = native_importance(spark, model, features)
    method = "native"
    if frame is None:
        if score is None or test is None:
            raise ValueError("This estimator exposes no native importances; supply the scorer "
                             "and test rows so permutation importance can be computed.")
        frame = permutation_importance(score, test, features)
        method = "permutation"
    return frame.orderBy(F.col("importance").desc()).limit(top_n), method


def feature_std(matrix: DataFrame, features: list[str]) -> DataFrame:
    row = matrix.agg(*[F.stddev_samp(f).alias(f) for f in features])
    stack = ", ".join(f"'{f}', `{f}`" for f in features)
    return row.selectExpr(f"stack({len(features)}, {stack}) AS (feature, std)")


def feature_correlation(matrix: DataFrame, features: list[str], top_n: int = C.CORRELATION_TOP_N) -> DataFrame:
    """Pearson correlation matrix (long form) of the ``top_n``
    highest-variance features, each pair over the rows that have both values.

    The upper triangle of pairs is one row of mergeable correlation buffers (counts,
    means and co-moments of each pair), updated by a row of the matrix as it is:
    nothing is copied per pair, and a task hands on one row. The result, a number per
    pair of the top features, is laid out as rows here."""
    top = [r.feature for r in feature_std(matrix, features).orderBy(F.col("std").desc(), "feature")
           .limit(top_n).collect()] if len(features) > top_n else list(features)
    pairs = [(a, b) for i, a in enumerate(top) for b in top[i:]]
    row = matrix.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")) for a, b in pairs]).first() if pairs else ()
    corr = dict(zip(pairs, row))
    return matrix.sparkSession.createDataFrame([(a, b, corr.get((a, b), corr.get((b, a)))) for a in top for b in top],
                                               "feature_a string, feature_b string, corr double")


def sampled_shapley(score, rows: DataFrame, features: list[str], samples: int = 16, seed: int = C.RANDOM_STATE,
                    keys: tuple[str, ...] = ("symbol", "date")) -> DataFrame:
    """I4 re-aimed: mean |Shapley value| per feature by permutation sampling
    (Strumbelj and Kononenko 2014), as one Spark job over all given rows.

    For each row and sample a background row is drawn by a random permutation of
    the rows (see ``permutations``). Each feature j then takes its place in a
    random order, given by hash priorities; the coalitions with and without j
    take the features before j from the row and the rest from the background.
    Both are scored in one ``transform``; phi_j is the mean difference.
    """
    rid = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    base = rows.select(rid.alias("_rid"), *features)
    partner = base.select(F.col("_rid").alias("_partner"), *[F.col(f).alias(f"_z_{f}") for f in features])
    drawn = permutations(rows, samples, seed, keys).join(base, "_rid").join(partner, "_partner")
    cand = drawn.withColumn("_j", F.explode(F.array(*[F.lit(f) for f in features])))
    pri = {f: F.xxhash64("_rid", "_j", "repeat", F.lit(f), F.lit(seed + 1)) for f in features}
    pj = F.xxhash64("_rid", "_j", "repeat", "_j", F.lit(seed + 1))
    plus, minus = [], []
    for f in features:
        before = pri[f] < pj
        plus.append(F.when(before | (F.col("_j") == F.lit(f)), F.col(f)).otherwise(F.col(f"_z_{f}")).alias(f))
        minus.append(F.when(before & (F.col("_j") != F.lit(f)), F.col(f)).otherwise(F.col(f"_z_{f}")).alias(f))
    both = cand.select("_rid", "_j", F.explode(F.array(F.struct(F.lit(1.0).alias("_sign"), *plus),
                                                      F.struct(F.lit(-1.0).alias("_sign"), *minus))).alias("_c")).select("_rid", "_j", "_c.*")
    phi = score(both).groupBy("_rid", "_j").agg(
        (F.sum(F.col("_sign") * F.col("p_up")) / F.lit(float(samples))).alias("phi"))
    return phi.groupBy(F.col("_j").alias("feature")).agg(F.avg(F.abs("phi")).alias("mean_abs_shap"))
