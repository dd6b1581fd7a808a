"""Registered queries that fit models (rows-only checks) and the correlation
tables (DuckDB twins)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import explain as X
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import models as ML
from ..operators import splits as SP
from . import oracle as O
from ..session import cut_lineage
from .catalog import bars_once, market_for, register, rounded
from .queries_analytics import _date_split_ctes, _feat_all_ctes

FEATURES = FE.ALL_FEATURES


def panel_split(spark, sf) -> tuple[DataFrame, list[str]]:
    """Feature matrix with the date split, written once to the checkpoint
    folder (every fit rereads a flat scan instead of re-planning the
    windows), and the feature list every symbol shares."""
    bars = bars_once(spark, sf)
    fm = cut_lineage(FE.feature_matrix(bars, market_for(bars)))
    return cut_lineage(SP.split_by_dates(fm), "split"), FE.panel_features(fm)


def _metrics_of(tm: ML.TrainedModel) -> DataFrame:
    v = tm.validation_metrics.withColumn("split", F.lit("validation"))
    t = tm.test_metrics.withColumn("split", F.lit("test"))
    return rounded(v.unionByName(t))


def _train_query(key: str):
    def q(spark, sf):
        ds, feats = panel_split(spark, sf)
        return _metrics_of(ML.train_single_model(ML.SPECS[key], ds, feats))
    return q


for _k, _q in (("logistic_regression", "train_logistic"), ("random_forest", "train_forest"),
               ("gradient_boosting", "train_gbt"), ("boosted_trees_colsample", "train_gbt_colsample"),
               ("rff_svm", "train_rff_svc")):
    register(_q, None)(_train_query(_k))


@register("per_symbol_experiment", None)
def q_per_symbol_experiment(spark, sf):
    """A linear model per symbol (row split), test scores per symbol,
    and a row with the reason for every symbol that could not be fitted."""
    bars = bars_once(spark, sf)
    fm = cut_lineage(FE.feature_matrix(bars, market_for(bars)))
    rows = SP.split_by_rows(fm)
    preds, failures = ML.logistic_per_symbol(rows.filter("split IS NOT NULL"), FE.panel_features(fm))
    scored = preds.withColumn("pred", M.threshold("p_up")).withColumn("model_key", F.lit("logistic_regression"))
    cards = M.scorecard(scored, ["symbol", "model_key"]).withColumn("failure", F.lit(None).cast("string"))
    failures = failures.unionByName(SP.split_failures(rows).withColumnRenamed("reason", "failure"))
    return rounded(cards.unionByName(failures, allowMissingColumns=True))


@register("native_importance", None)
def q_native_importance(spark, sf):
    """I1 on the linear model (|coefficient| with sign), top 15."""
    ds, feats = panel_split(spark, sf)
    tm = ML.train_single_model(ML.SPECS["logistic_regression"], ds, feats)
    frame, _ = X.top_features(spark, tm.model, feats, top_n=C.IMPORTANCE_TOP_N)
    return rounded(frame)


#: A fixed linear score: its importances don't depend on a solver, so SQL can state them.
FIXED_SCORE = {"close_to_sma20": 3.0, "daily_return": -2.0, "return_5d": 1.0, "volatility_20d": -0.5, "rsi_14": 0.001}


def fixed_score(df: DataFrame) -> DataFrame:
    """p_up = the linear form, added up in the order listed (AUC needs no sigmoid)."""
    total = None
    for f, c in FIXED_SCORE.items():
        term = F.lit(c) * F.col(f)
        total = term if total is None else total + term
    return df.withColumn("p_up", total)


def _score_sql(value) -> str:
    return " + ".join(f"CAST({c!r} AS DOUBLE) * {value(f)}" for f, c in FIXED_SCORE.items())


def _test_rows(spark, sf) -> DataFrame:
    """Test rows of the date split with features rounded to 6 decimals, so that both engines permute the same numbers."""
    ds, _ = panel_split(spark, sf)
    t = rounded(ds.filter("split = 'test'").select("symbol", "date", C.TARGET_COLUMN, *FEATURES))
    return cut_lineage(t.withColumn(ML.LABEL, F.col(C.TARGET_COLUMN).cast("double")))


def _permutation_ctes(repeats: int) -> list:
    key = "md5('{seed}|{which}|' || repeat || '|' || rid)"
    ranked = lambda which: ("SELECT rid, repeat, row_number() OVER (PARTITION BY repeat ORDER BY "
                            + key.format(seed=C.RANDOM_STATE, which=which) + ", rid) AS k FROM ids")
    where = O.matrix_filter(FE.BASE_FEATURES, FE.MARKET_FEATURES, ["next_day_return"])
    return _date_split_ctes() + [
        ("t", "SELECT symbol || '|' || CAST(feat.date AS VARCHAR) AS rid, target_up_next_day AS y, "
              + ", ".join(O.rnd(f, f) for f in FEATURES)
              + f" FROM (SELECT * FROM feat WHERE {where}) feat JOIN dsplit ON feat.date = dsplit.date AND dsplit.split = 'test'"),
        ("ids", f"SELECT rid, unnest(range({repeats})) AS repeat FROM t"),
        ("r_to", ranked("to")), ("r_from", ranked("from")),
        ("perm", "SELECT a.rid, a.repeat, b.rid AS partner FROM r_to a JOIN r_from b ON a.repeat = b.repeat AND a.k = b.k")]


def _permutation_sql() -> str:
    cases = " ".join(f"WHEN '{f}' THEN " + _score_sql(lambda g, f=f: f"q.{g}" if g == f else f"t.{g}") for f in FIXED_SCORE)
    auc = """SELECT {g}, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM (
  SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
    SELECT {g}, p, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM {src} GROUP BY {g}, p)) GROUP BY {g}"""
    return O.sql(_permutation_ctes(C.PERMUTATION_REPEATS) + [
        ("copies", f"""SELECT f.feature, perm.repeat, t.y, CASE f.feature {cases} ELSE {_score_sql(lambda g: f't.{g}')} END AS p
FROM perm JOIN t ON t.rid = perm.rid JOIN t q ON q.rid = perm.partner, (SELECT unnest([{', '.join(repr(f) for f in FEATURES)}]) AS feature) f"""),
        ("b0", f"SELECT 'all' AS feature, y, {_score_sql(lambda g: f't.{g}')} AS p FROM t"),
        ("base", auc.format(g="feature", part="PARTITION BY feature", src="b0")),
        ("a", auc.format(g="feature, repeat", part="PARTITION BY feature, repeat", src="copies")),
        ("d", "SELECT feature, (SELECT auc FROM base) - auc AS d FROM a")],
        f"""SELECT feature, {O.rnd('avg(d)', 'importance')}, {O.rnd('stddev_pop(d)', 'std')}, {O.rnd('avg(d)', 'signed_value')}
FROM d GROUP BY feature""")


@register("permutation_importance", _permutation_sql())
def q_permutation_importance(spark, sf):
    """I2 of a fixed linear score over all test rows (10 full permutations)."""
    return rounded(X.permutation_importance(fixed_score, _test_rows(spark, sf), FEATURES))


SHAPLEY_SAMPLES = 16


def _none(f: str, row: str) -> str:
    """A feature that the score leaves out counts 0, also where it is null."""
    return f"{row}.{f}" if f in FIXED_SCORE else f"coalesce({row}.{f}, 0.0)"


def _shapley_sql() -> str:
    phi = [f"SELECT perm.rid, '{f}' AS feature, sum(CAST({FIXED_SCORE.get(f, 0.0)!r} AS DOUBLE) * ({_none(f, "t")} - {_none(f, "q")})) / {SHAPLEY_SAMPLES}.0 AS phi "
           "FROM perm JOIN t ON t.rid = perm.rid JOIN t q ON q.rid = perm.partner GROUP BY perm.rid" for f in FEATURES]
    return O.sql(_permutation_ctes(SHAPLEY_SAMPLES) + [("phi", "\nUNION ALL\n".join(phi))],
                 f"SELECT feature, {O.rnd('avg(abs(phi))', 'mean_abs_shap')} FROM phi GROUP BY feature")


@register("sampled_shapley", _shapley_sql())
def q_sampled_shapley(spark, sf):
    """I4 of the fixed linear score over all test rows: there the sampled value of
    a feature is exactly its coefficient times the mean distance to the drawn rows."""
    return rounded(X.sampled_shapley(fixed_score, _test_rows(spark, sf), FEATURES, SHAPLEY_SAMPLES))


# ---------------------------------------------------------------------------
# correlations (SQL twins)
# ---------------------------------------------------------------------------
def _fm_sql_ctes():
    where = O.matrix_filter(FE.BASE_FEATURES, FE.MARKET_FEATURES, ["next_day_return"])
    return _feat_all_ctes() + [("fm", f"SELECT * FROM feat WHERE {where}")]


@register("feature_target_corr", O.sql(_fm_sql_ctes() + [
    ("c", "SELECT " + ", ".join(f"corr({f}, CAST(target_up_next_day AS DOUBLE)) AS {f}" for f in FEATURES) + " FROM fm"),
    ("u", "UNPIVOT c ON " + ", ".join(FEATURES) + " INTO NAME feature VALUE corr")],
    f"SELECT feature, {O.rnd('corr', 'corr')}, {O.rnd('abs(corr)', 'abs_corr')} FROM u"))
def q_feature_target_corr(spark, sf):
    """V13 leakage tripwire table: |corr(feature, target)| per feature."""
    from ..operators.quality import leakage_tripwire
    bars = bars_once(spark, sf)
    return rounded(leakage_tripwire(FE.feature_matrix(bars, market_for(bars)), FEATURES))


def _corr_sql() -> str:
    std = "SELECT " + ", ".join(f"stddev_samp({f}) AS {f}" for f in FEATURES) + " FROM fm"
    pairs = [(a, b) for a in FEATURES for b in FEATURES]
    corr = "SELECT " + ", ".join(f"corr({a}, {b}) AS \"{a}__{b}\"" for a, b in pairs) + " FROM fm"
    return O.sql(_fm_sql_ctes() + [
        ("sd", std), ("sdu", "UNPIVOT sd ON " + ", ".join(FEATURES) + " INTO NAME feature VALUE std"),
        ("top", f"SELECT feature FROM sdu ORDER BY std DESC, feature LIMIT {C.CORRELATION_TOP_N}"),
        ("cr", corr), ("cru", "UNPIVOT cr ON COLUMNS(*) INTO NAME pair VALUE corr"),
        ("crs", "SELECT split_part(pair, '__', 1) AS feature_a, split_part(pair, '__', 2) AS feature_b, corr FROM cru")],
        f"""SELECT feature_a, feature_b, {O.rnd('corr', 'corr')} FROM crs
WHERE feature_a IN (SELECT feature FROM top) AND feature_b IN (SELECT feature FROM top)""")


@register("feature_correlation", _corr_sql())
def q_feature_correlation(spark, sf):
    bars = bars_once(spark, sf)
    fm = cut_lineage(FE.feature_matrix(bars, market_for(bars)))
    return rounded(X.feature_correlation(fm, FEATURES))
