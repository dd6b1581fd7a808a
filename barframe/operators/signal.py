"""Three-state research signal and the cost-aware long/flat study."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.segments import POS, SLICE, largest, multiplied, positioned, with_before, with_halo, within, without_halo
from ..session import cut_lineage


def check_thresholds(bull: float, bear: float) -> None:
    if bear > bull:
        raise ValueError("bearish_threshold must not exceed bullish_threshold.")


def signal_label(p: str | Column = "p_up", bull: float = C.BULLISH_THRESHOLD,
                 bear: float = C.BEARISH_THRESHOLD) -> Column:
    """Bearish is tested first so it wins overlapping thresholds; a null
    probability reads Neutral."""
    p = F.col(p) if isinstance(p, str) else p
    return (F.when(p < F.lit(bear), F.lit(C.SIGNAL_BEARISH))
            .when(p > F.lit(bull), F.lit(C.SIGNAL_BULLISH))
            .otherwise(F.lit(C.SIGNAL_NEUTRAL)))


def classify_probability(p: str | Column = "p_up", bull: float = C.BULLISH_THRESHOLD,
                         bear: float = C.BEARISH_THRESHOLD) -> Column:
    """C14: validated thresholds, then the same labelling."""
    check_thresholds(bull, bear)
    return signal_label(p, bull, bear)


def panel_daily(df: DataFrame, p: str = "p_up", fwd: str = "next_day_return") -> DataFrame:
    """Mean probability and mean forward return per session."""
    return df.groupBy("date").agg(F.avg(p).alias("p_up"), F.avg(fwd).alias("fwd_return")) \
        .withColumn("series", F.lit("panel"))


def _aligned(df: DataFrame, group: list[str], p: str, fwd: str) -> DataFrame:
    """Rows with both a probability and a forward return."""
    return df.select(*group, "date", F.col(p).alias("p_up"), F.col(fwd).alias("fwd_return")) \
        .dropna(subset=["p_up", "fwd_return"])


def study_rows(df: DataFrame, group: list[str], p: str = "p_up", fwd: str = "fwd_return",
               bull: float = C.BULLISH_THRESHOLD, bps: float = C.TRANSACTION_COST_BPS) -> DataFrame:
    """Per-session position, turnover, cost and net return, plus both equity
    curves and their drawdowns (G1 rows, G3)."""
    a = with_halo(positioned(_aligned(df, group, p, fwd), group), group, 1)
    pos = (F.col("p_up") > F.lit(bull)).cast("double")
    a = a.withColumn("position", pos)
    prev = F.lag("position").over(Window.partitionBy(*group, SLICE).orderBy(POS))
    a = a.withColumn("turnover", F.coalesce(F.abs(F.col("position") - prev), F.col("position")))
    a = a.withColumn("cost", F.col("turnover") * F.lit(bps / 10_000.0))
    a = cut_lineage(without_halo(a.withColumn("net_return", F.col("position") * F.col("fwd_return") - F.col("cost"))), "study")
    grown = {k: F.lit(1.0) + F.coalesce(r, F.lit(0.0)) for k, r in (("strategy", F.col("net_return")), ("buy_hold", F.col("fwd_return")))}
    run = within(group)
    a = with_before(a, group, {f"_{k}": multiplied(x) for k, x in grown.items()})
    a = cut_lineage(a.select("*", *[(F.col(f"_{k}") * F.product(x).over(run)).alias(f"{k}_equity") for k, x in grown.items()]), "equity")
    a = with_before(a, group, {f"_{k}_peak": largest(F.col(f"{k}_equity")) for k in grown})
    peak = {k: F.greatest(F.col(f"_{k}_peak"), F.max(f"{k}_equity").over(run)) for k in grown}
    a = a.select("*", *[(F.col(f"{k}_equity") / peak[k] - 1).alias(f"{k}_drawdown") for k in grown])
    return a.drop(POS, SLICE, *[f"_{k}" for k in grown], *[f"_{k}_peak" for k in grown])


def _annualised(r: str) -> tuple[Column, Column]:
    n = F.count(r)
    growth = F.product(F.lit(1.0) + F.col(r))
    ann = (F.when(n == 0, F.lit(0.0)).when(growth <= 0, F.lit(-1.0))
           .otherwise(F.pow(growth, F.lit(float(C.TRADING_DAYS_PER_YEAR)) / n) - F.lit(1.0)))
    vol = F.coalesce(F.stddev_samp(r), F.lit(0.0)) * F.lit(C.TRADING_DAYS_PER_YEAR ** 0.5)
    return ann, vol


def require_overlap(df: DataFrame, p: str = "p_up", fwd: str = "fwd_return") -> DataFrame:
    """G1: the rows, or an error if no session has both a probability and a forward return."""
    if df.filter(F.col(p).isNotNull() & F.col(fwd).isNotNull()).isEmpty():
        raise ValueError("probabilities and returns have no session in common")
    return df


def signal_study(df: DataFrame, group: list[str], p: str = "p_up", fwd: str = "fwd_return",
                 bull: float = C.BULLISH_THRESHOLD, bps: float = C.TRANSACTION_COST_BPS) -> DataFrame:
    """G1: one row per group with the 13 study fields (unrounded; the
    reference rounds them to 2-3 decimals for display)."""
    rows = study_rows(df, group, p, fwd, bull, bps)
    s_ann, s_vol = _annualised("net_return")
    b_ann, b_vol = _annualised("fwd_return")
    return rows.groupBy(*group).agg(
        F.count("*").alias("observations"),
        (F.avg("position") * 100).alias("days_in_market_pct"),
        ((F.product(F.lit(1.0) + F.col("net_return")) - 1) * 100).alias("strategy_total_return_pct"),
        ((F.product(F.lit(1.0) + F.col("fwd_return")) - 1) * 100).alias("buy_hold_total_return_pct"),
        (s_ann * 100).alias("strategy_annualised_return_pct"),
        (b_ann * 100).alias("buy_hold_annualised_return_pct"),
        (s_vol * 100).alias("strategy_annualised_volatility_pct"),
        (b_vol * 100).alias("buy_hold_annualised_volatility_pct"),
        (F.min("strategy_drawdown") * 100).alias("strategy_max_drawdown_pct"),
        (F.min("buy_hold_drawdown") * 100).alias("buy_hold_max_drawdown_pct"),
        F.sum("turnover").cast("bigint").alias("n_position_changes"),
        (F.sum("cost") * 100).alias("total_cost_pct"),
        F.lit(float(bps)).alias("transaction_cost_bps"))


def returns_by_signal(df: DataFrame, group: list[str], p: str = "p_up", fwd: str = "fwd_return",
                      bull: float = C.BULLISH_THRESHOLD, bear: float = C.BEARISH_THRESHOLD) -> DataFrame:
    """Count, mean and sample std (x100) of the forward return per bucket."""
    a = df.select(*group, signal_label(p, bull, bear).alias("signal"), F.col(fwd).alias("_f")) \
        .dropna(subset=["_f"])
    order = F.when(F.col("signal") == C.SIGNAL_BEARISH, 0).when(F.col("signal") == C.SIGNAL_NEUTRAL, 1) \
        .otherwise(2)
    return a.groupBy(*group, "signal").agg(
        F.count("*").alias("observations"),
        (F.avg("_f") * 100).alias("mean_next_day_return_pct"),
        (F.stddev_samp("_f") * 100).alias("std_next_day_return_pct")).withColumn("bucket_order", order)


def latest_signal(df: DataFrame, group: list[str], p: str = "p_up",
                  bull: float = C.BULLISH_THRESHOLD, bear: float = C.BEARISH_THRESHOLD) -> DataFrame:
    """The last labelled row's probability and label per group."""
    last = df.groupBy(*group).agg(F.max("date").alias("date"), F.max_by(p, "date").alias("p_up"))
    return last.withColumn("signal", signal_label("p_up", bull, bear))
