"""Further operators as queries of their own, each with its SQL twin: the reduced ROC
curve, the index by its default rule, provenance, panel outcomes, the choice of the best
model over fixed scores, comparison series, prices of kept rows, train + validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators import report as R
from ..operators import splits as SP
from ..operators.index import build_snapshot, equal_weight_index, provenance
from ..session import cut_lineage
from . import oracle as O
from .catalog import (BAR_DOUBLES, INDEX_COVERAGE, INDEX_SPAN, SQL, _bars_ctes, _feature_sql, bars_once, market_for, register, rounded,
                      sel_rounded)
from .queries_analytics import (BARS, DAMAGED, IDX, _auc_ctes, _baseline_ctes, _date_split_ctes, _scorecard_sql, _validation_sql, damaged_bars, date_split)


@register("roc_points_reduced", O.sql(_date_split_ctes() + _auc_ctes("ds", "split")[:2] + [
    ("tot", "SELECT split, sum(pos) AS P, sum(neg) AS N FROM sagg GROUP BY split"),
    ("near", """SELECT *, lag(pos) OVER w AS lower_pos, lag(neg) OVER w AS lower_neg, lead(p_up) OVER w AS higher FROM scum
WINDOW w AS (PARTITION BY split ORDER BY p_up)""")],
    f"""SELECT near.split, {O.rnd('p_up', 'threshold')}, {O.rnd('(N - neg_below) / nullif(N, 0)', 'fpr')},
       {O.rnd('(P - pos_below) / nullif(P, 0)', 'tpr')} FROM near JOIN tot USING (split)
WHERE higher IS NULL OR lower_pos IS NULL OR lower_pos <> pos OR lower_neg <> neg
UNION ALL SELECT split, NULL, 0.0, 0.0 FROM tot"""))
def q_roc_points_reduced(spark, sf):
    """E4 without the points between two equal steps."""
    return rounded(M.roc_points(date_split(spark, sf), ["split"], drop_collinear=True))


def monthly_bars(bars: DataFrame) -> DataFrame:
    """Bars of whole months: a calendar that symbols cover without gaps."""
    return bars.groupBy("symbol", F.trunc("date", "month").alias("month")).agg(
        F.min_by("open", "date").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "date").alias("close"),
        F.max_by("adj_close", "date").alias("adj_close"), F.sum("volume").alias("volume")).withColumnRenamed("month", "date")


MONTHLY = [("days", _bars_ctes()[0][1]), ("bars", """SELECT symbol, CAST(date_trunc('month', date) AS DATE) AS date, arg_min(open, days.date) AS open, max(high) AS high, min(low) AS low,
       arg_max(close, days.date) AS close, arg_max(adj_close, days.date) AS adj_close, CAST(sum(volume) AS BIGINT) AS volume FROM days GROUP BY symbol, date_trunc('month', days.date)""")]


@register("index_default_rule", O.sql(MONTHLY + O.index_ctes(min_coverage=0.99, require_span=True),
                                      f"SELECT {sel_rounded(BAR_DOUBLES, ['symbol', 'date', 'volume'])} FROM idx"))
def q_index_default_rule(spark, sf):
    """J9 / A11 by the default rule: members span the calendar and hold 99 % of it."""
    return rounded(equal_weight_index(cut_lineage(monthly_bars(bars_once(spark, sf)), "months")))


@register("provenance", O.sql([("meta", SQL["snapshot_metadata"])] + BARS + IDX, f"""SELECT 'driver tables' AS source_name, meta.*,
       (SELECT count(*) FROM members) AS market_index_constituents, (SELECT count(DISTINCT symbol) FROM bars) AS source_tickers_available FROM meta"""))
def q_provenance(spark, sf):
    """S11 whole, but for the time of the build."""
    bars = bars_once(spark, sf)
    snap = build_snapshot(bars, min_coverage=INDEX_COVERAGE, require_span=INDEX_SPAN, require_members=False)
    return rounded(provenance(bars, snap, "driver tables", min_coverage=INDEX_COVERAGE, require_span=INDEX_SPAN).drop("source_url", "built_at_utc", "adjustment_note"))


_GOOD = [("rep", _validation_sql(DAMAGED))] + [(("every" if n == "bars" else n), sql) for n, sql in DAMAGED] + [
    ("bars", "SELECT * FROM every WHERE symbol IN (SELECT symbol FROM rep GROUP BY symbol HAVING bool_and(passed))")]


@register("panel_outcomes", O.sql(_GOOD + O.feature_ctes(market=None), f"""SELECT symbol, true AS included, count(*) AS n_rows, CAST(NULL AS VARCHAR) AS reason FROM feat
WHERE {O.matrix_filter(FE.BASE_FEATURES, FE.MARKET_FEATURES, ['next_day_return'], with_market=False)} GROUP BY symbol
UNION ALL SELECT symbol, false, 0, symbol || ': ' || message FROM rep WHERE NOT passed
UNION ALL SELECT DISTINCT symbol, false, 0, symbol || ': no row has all features' FROM bars WHERE symbol NOT IN (
  SELECT symbol FROM feat WHERE {O.matrix_filter(FE.BASE_FEATURES, FE.MARKET_FEATURES, ['next_day_return'], with_market=False)})"""))
def q_panel_outcomes(spark, sf):
    """Every symbol's part in the panel, with its rows or why it has none."""
    good, skipped = Q.valid_bars(damaged_bars(spark, sf))
    fm = cut_lineage(FE.feature_matrix(good, None, include_market=False), "matrix")
    gone = skipped.unionByName(FE.vanished(good, fm))
    out = fm.groupBy("symbol").agg(F.lit(True).alias("included"), F.count("*").alias("n_rows"), F.lit(None).cast("string").alias("reason"))
    return out.unionByName(gone.select("symbol", F.lit(False).alias("included"), F.lit(0).cast("bigint").alias("n_rows"), "reason"))


_FIXED = _baseline_ctes() + [("card", _scorecard_sql("bp", "model_key")), ("mt", """SELECT 'sma20_score' AS model_key, y, pred, p_up FROM ds WHERE split = 'test'
UNION ALL SELECT 'inverse_sma20_score', y, CAST(1 - p_up >= 0.5 AS INTEGER), 1 - p_up FROM ds WHERE split = 'test'"""), ("mcard", _scorecard_sql("mt", "model_key"))] + _auc_ctes("mt", "model_key")


def fixed_cards(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Scorecards of two fixed scores and of the baselines on the panel's test rows."""
    ds = cut_lineage(date_split(spark, sf).withColumn("panel", F.lit("panel")), "scored")
    test = ds.where("split = 'test'").select("y", "p_up")
    both = test.withColumn("model_key", F.lit("sma20_score")).unionByName(test.select("y", (1 - F.col("p_up")).alias("p_up"), F.lit("inverse_sma20_score").alias("model_key")))
    models = M.scorecard(both.withColumn("pred", M.threshold("p_up")), ["model_key"])
    return models, M.scorecard(M.baseline_predictions(ds, ["panel"]), ["model_key"], proba=None)


@register("verdict_fixed", O.sql(_FIXED, f"""SELECT model_key AS best_model_key, {O.rnd('accuracy', 'best_model_accuracy')}, {O.rnd('naive', 'best_baseline_accuracy')}, accuracy > naive AS beats_baselines
FROM (SELECT *, (SELECT max(accuracy) FROM card) AS naive FROM mcard LEFT JOIN auc USING (model_key) ORDER BY coalesce(auc.roc_auc, 0) DESC, accuracy DESC, model_key LIMIT 1)"""))
def q_verdict_fixed(spark, sf):
    """G5 / O6 / O7 over fixed scores."""
    return rounded(R.verdict(*fixed_cards(spark, sf)))


@register("comparison_series", O.sql(_FIXED, f"""SELECT model_key, {O.rnd('auc.roc_auc', 'test_roc_auc')}, false AS is_baseline FROM mcard JOIN auc USING (model_key) WHERE auc.roc_auc IS NOT NULL"""))
def q_comparison_series(spark, sf):
    """The bars of a comparison chart."""
    return rounded(R.comparison_series(R.comparison_table(*fixed_cards(spark, sf))))


@register("matrix_prices", _feature_sql(["open", "high", "low", "close", "adj_close"], matrix=True, extra_cols=["volume"]))
def q_matrix_prices(spark, sf):
    """The prices of the rows that the matrix keeps."""
    bars = bars_once(spark, sf)
    return rounded(FE.feature_matrix(bars, market_for(bars), keep_prices=True).select("symbol", "date", *BAR_DOUBLES, "volume"))


@register("train_plus_validation", O.sql(_date_split_ctes(), f"""SELECT symbol, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date
FROM ds WHERE split IN ('train', 'validation') GROUP BY symbol"""))
def q_train_plus_validation(spark, sf):
    """The rows of the final refit."""
    return SP.train_plus_validation(date_split(spark, sf)).groupBy("symbol").agg(F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
