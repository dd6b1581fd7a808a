"""The pooled panel experiment end to end (the reference's flagship run):
bars -> validation -> features -> date split -> models -> baselines ->
comparison -> best model -> importance -> signal study -> result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import explain as X
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import models as ML
from ..operators import quality as Q
from ..operators import report as R
from ..operators import signal as S
from ..operators import splits as SP
from ..operators.index import equal_weight_index, market_returns
from ..session import cut_lineage


@dataclass
class PanelResult:
    tables: dict[str, DataFrame]
    trained: dict[str, ML.TrainedModel]
    warnings: list[str]


def run_panel(spark: SparkSession, bars: DataFrame, model_keys=ML.PANEL_MODELS,
              overrides: dict[str, dict] | None = None, min_coverage: float = 0.99,
              require_span: bool = True, out_dir: str | None = None) -> PanelResult:
    bars = cut_lineage(bars)
    market = cut_lineage(market_returns(equal_weight_index(bars, min_coverage=min_coverage,
                                                           require_span=require_span)))
    equities = bars.filter(F.col("symbol") != C.MARKET_SYMBOL)
    good, skipped = Q.valid_bars(equities)
    fm = cut_lineage(FE.feature_matrix(good, market))
    # true intersection of the feature lists (T15): market columns only if
    # every kept symbol has them
    features = FE.panel_features(fm)
    ds = cut_lineage(SP.split_by_dates(fm.select("symbol", "date", *features, *FE.LABELS)))
    trained, outcomes = ML.run_panel_experiment(ds, features, model_keys, overrides)
    warnings = [f"{o.model_key} {o.status}: {o.detail}" for o in outcomes if o.status != "trained"]
    models = None
    for tm in trained.values():
        models = tm.test_metrics if models is None else models.unionByName(tm.test_metrics)
    base = ds.withColumn("panel", F.lit("panel")).withColumn("y", F.col(C.TARGET_COLUMN))
    baselines = M.scorecard(M.baseline_predictions(base, ["panel"]), ["model_key"], proba=None)
    best_key = R.best_model(models).first()[0]
    best = trained[best_key]
    importance, method = X.top_features(spark, best.model, features, best.scorer,
                                        ds.filter("split = 'test'").withColumn(
                                            ML.LABEL, F.col(C.TARGET_COLUMN).cast("double")),
                                        top_n=C.IMPORTANCE_TOP_N)
    daily = S.panel_daily(best.test_predictions)
    tables = {
        "skipped": skipped.unionByName(FE.vanished(good, fm)),
        "split_sizes": SP.split_sizes(ds),
        "comparison": R.comparison_table(models, baselines),
        "verdict": R.verdict(models, baselines),
        "importance": importance.withColumn("method", F.lit(method)),
        "signal_study": S.signal_study(S.require_overlap(daily), ["series"]),
        "signal_buckets": S.returns_by_signal(daily, ["series"]),
        "confusion": M.confusion(best.test_predictions, ["model_key"]),
    }
    if out_dir:
        R.write_report(tables, out_dir)
    return PanelResult(tables, trained, warnings)
