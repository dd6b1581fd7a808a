"""The 38 causal features, the next-session label and the panel.

The whole matrix is built on the long bar table in a handful of window
stages, never per symbol and never over a whole symbol: scans fold slices of a
symbol, and the frames run over slices with the rows that they reach
(``functions.segments``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.segments import OWN, POS, dealt, positioned, with_filled, with_halo, without_halo
from ..functions.windows import (SYMBOL, lag, lead, pct_change, prefix_columns, prefix_count, prefix_mean,
                                 rolling_std, rolling_sum, sdiv)
from ..session import cut_lineage
from .indicators import FRAME, bollinger_columns, with_smoothed

PRICE_FEATURES = ["daily_return", "log_return", "overnight_return", "intraday_return",
                  "high_low_range", "close_to_high"]
MOMENTUM_FEATURES = [f"return_{n}d" for n in C.MOMENTUM_WINDOWS]
MA_FEATURES = ([f"close_to_sma{n}" for n in C.SMA_WINDOWS]
               + [f"close_to_ema{n}" for n in C.EMA_WINDOWS]
               + ["sma5_to_sma20", "sma20_to_sma50"])
TECHNICAL_FEATURES = ["rsi_14", "macd", "macd_signal", "macd_hist", "bb_position", "bb_width",
                      "atr_14_norm"]
VOLATILITY_FEATURES = [f"volatility_{n}d" for n in C.VOLATILITY_WINDOWS] + ["vol_ratio_5_20"]
VOLUME_FEATURES = ["volume_change", "relative_volume", "volume_trend_5d"]
CALENDAR_FEATURES = ["day_of_week", "month"]
MARKET_FEATURES = ["market_return", "market_return_5d", "market_volatility_20d", "excess_return"]
BASE_FEATURES = (PRICE_FEATURES + MOMENTUM_FEATURES + MA_FEATURES + TECHNICAL_FEATURES
                 + VOLATILITY_FEATURES + VOLUME_FEATURES + CALENDAR_FEATURES)
ALL_FEATURES = BASE_FEATURES + MARKET_FEATURES
LABELS = [C.TARGET_COLUMN, "next_day_return"]
#: Rows before a slice that its frames reach (a deviation of 20 returns is the deepest after the 50-row mean), and after it.
REACH, AHEAD = 60, 1
NON_FEATURE_COLUMNS = ("open", "high", "low", "close", "adj_close", "volume",
                       C.TARGET_COLUMN, "next_day_return")


def _stage_inputs(bars: DataFrame) -> DataFrame:
    """Plain lags/leads and running sums/counts (inputs of the trailing means) within a slice and its halo."""
    return bars.select(
        "*",
        lag("close", 1, FRAME).alias("_pc"),
        lead("close", 1, FRAME).alias("_nc"),
        *prefix_columns("close", "_cp", FRAME),
        *prefix_columns(F.col("volume").cast("double"), "_vp", FRAME),
    )


def price_columns() -> dict[str, Column]:
    c, o, h, l = (F.col(x) for x in ("close", "open", "high", "low"))
    return {
        "daily_return": pct_change("_fc", 1, FRAME, fill=False),
        "log_return": F.log(sdiv(c, "_pc")),
        "overnight_return": sdiv(o, "_pc") - F.lit(1.0),
        "intraday_return": sdiv(c, o) - F.lit(1.0),
        "high_low_range": sdiv(h - l, c),
        "close_to_high": sdiv(h - c, c),
    }


def momentum_columns() -> dict[str, Column]:
    return {f"return_{n}d": pct_change("_fc", n, FRAME, fill=False) for n in C.MOMENTUM_WINDOWS}


def moving_average_columns() -> dict[str, Column]:
    c = F.col("close")
    smas = {n: prefix_mean("_cp", n, FRAME) for n in C.SMA_WINDOWS}
    out = {f"close_to_sma{n}": sdiv(c, s) - F.lit(1.0) for n, s in smas.items()}
    out.update({f"close_to_ema{n}": sdiv(c, F.col(f"ema{n}")) - F.lit(1.0) for n in C.EMA_WINDOWS})
    out["sma5_to_sma20"] = sdiv(smas[5], smas[20]) - F.lit(1.0)
    out["sma20_to_sma50"] = sdiv(smas[20], smas[50]) - F.lit(1.0)
    return out


def technical_columns() -> dict[str, Column]:
    c = F.col("close")
    bands = bollinger_columns(middle=prefix_mean("_cp", C.BOLLINGER_WINDOW, FRAME),
                              count=prefix_count("_cp", C.BOLLINGER_WINDOW, FRAME), part=FRAME)
    return {
        "rsi_14": F.col("rsi14"),
        "macd": sdiv("macd_line", c),
        "macd_signal": sdiv("macd_signal_line", c),
        "macd_hist": sdiv("macd_hist_line", c),
        "bb_position": bands["bb_position"],
        "bb_width": bands["bb_width"],
        "atr_14_norm": sdiv("atr14", c),
    }


def volume_columns() -> dict[str, Column]:
    v = F.col("volume").cast("double")
    vsma = prefix_mean("_vp", C.VOLUME_SMA_WINDOW, FRAME)
    return {
        "volume_change": pct_change("_fv", 1, FRAME, fill=False),
        "relative_volume": sdiv(v, vsma),
        "volume_trend_5d": sdiv(prefix_mean("_vp", 5, FRAME), vsma),
    }


def calendar_columns() -> dict[str, Column]:
    return {"day_of_week": F.weekday("date").cast("double"),
            "month": F.month("date").cast("double")}


def volatility_columns() -> dict[str, Column]:
    """Needs ``daily_return`` materialised."""
    out = {f"volatility_{n}d": rolling_std("daily_return", n, 1, FRAME) for n in C.VOLATILITY_WINDOWS}
    out["vol_ratio_5_20"] = sdiv(out["volatility_5d"], out["volatility_20d"])
    return out


def target_columns() -> dict[str, Column]:
    ndr = sdiv("_nc", "close") - F.lit(1.0)
    return {"next_day_return": ndr,
            C.TARGET_COLUMN: F.when(ndr.isNotNull(), (ndr > 0).cast("int"))}


def join_market(bars: DataFrame, market: DataFrame | None) -> DataFrame:
    """Left-join the market series on date as ``_mr``.

    The market table holds one row per session (it is grouped by date); whether it
    is small enough to be broadcast is left to Spark.
    """
    if market is None:
        return bars.withColumn("_mr", F.lit(None).cast("double"))
    m = market.select("date", F.col("market_return").alias("_mr"))
    return bars.join(m, "date", "left")


def market_columns(df: DataFrame, present: bool, min_coverage: float = C.MARKET_COVERAGE_MIN) -> DataFrame:
    """Roll the *aligned* market series and null the four columns for symbols
    whose coverage is below ``min_coverage`` (``market_ok`` says which)."""
    if not present:
        return df.select("*", *[F.lit(None).cast("double").alias(c) for c in MARKET_FEATURES],
                         F.lit(False).alias("market_ok")).drop("_mr")
    cover = (df.where(OWN).groupBy("symbol").agg((F.avg(F.col("_mr").isNotNull().cast("double")) >= F.lit(min_coverage)).alias("market_ok")))
    ok = F.col("market_ok")
    cols = {
        "market_return": F.col("_mr"),
        "market_return_5d": rolling_sum("_mr", 5, FRAME),
        "market_volatility_20d": rolling_std("_mr", 20, 1, FRAME),
        "excess_return": F.col("daily_return") - F.col("_mr"),
    }
    rolled = df.select("*", *[e.alias(f"_m_{k}") for k, e in cols.items()])
    return (rolled.join(cover, "symbol").select(*[c for c in df.columns if c != "_mr"], "market_ok", *[F.when(ok, F.col(f"_m_{k}")).alias(k) for k in cols]))


def by_symbol(df: DataFrame) -> DataFrame:
    """Rows dealt by symbol (see ``segments.dealt``)."""
    return dealt(df, "symbol")


def all_feature_columns(bars: DataFrame, market: DataFrame | None = None) -> DataFrame:
    """Bars + every feature and label column (no warm-up drop, no dropna)."""
    df = positioned(join_market(bars, market))
    df = with_filled(df, SYMBOL, {"_fc": F.col("close"), "_fv": F.col("volume").cast("double")})
    df = cut_lineage(with_smoothed(df), "levels")
    df = _stage_inputs(with_halo(df, SYMBOL, REACH, AHEAD))
    first = {}
    for block in (price_columns(), momentum_columns(), moving_average_columns(),
                  technical_columns(), volume_columns(), calendar_columns(), target_columns()):
        first.update(block)
    df = df.select("*", *[e.alias(k) for k, e in first.items()])
    df = df.select("*", *[e.alias(k) for k, e in volatility_columns().items()])
    return without_halo(market_columns(df, market is not None))


def feature_matrix(bars: DataFrame, market: DataFrame | None = None,
                   warmup: int = C.WARMUP_ROWS, include_market: bool = True,
                   keep_prices: bool = False) -> DataFrame:
    """features + labels, first ``warmup`` rows per symbol dropped, then
    any row with a null feature or label dropped."""
    df = all_feature_columns(bars, market if include_market else None)
    feats = ALL_FEATURES if include_market else BASE_FEATURES
    required = F.lit(True)
    for c in BASE_FEATURES + LABELS:
        required = required & F.col(c).isNotNull()
    if include_market:
        # a symbol without market coverage keeps its rows (its matrix simply
        # has no market columns); otherwise the market columns are required
        market_present = F.lit(True)
        for c in MARKET_FEATURES:
            market_present = market_present & F.col(c).isNotNull()
        required = required & (~F.col("market_ok") | market_present)
    df = df.filter((F.col(POS) >= F.lit(warmup)) & required)
    prices = ["open", "high", "low", "close", "adj_close", "volume"] if keep_prices else []
    extra = ["market_ok"] if include_market else []
    return df.select("symbol", "date", *feats, *LABELS, *prices, *extra)


def vanished(bars: DataFrame, matrix: DataFrame) -> DataFrame:
    """(symbol, reason) of symbols with bars but no feature row left."""
    gone = bars.select("symbol").distinct().join(matrix.select("symbol").distinct(), "symbol", "left_anti")
    return gone.select("symbol", F.concat(F.col("symbol"), F.lit(": no row has all features")).alias("reason"))


def panel_features(matrix: DataFrame) -> list[str]:
    """The feature list shared by every symbol of a matrix: the four
    market columns only if every symbol has them (one tiny aggregate)."""
    if "market_ok" not in matrix.columns:
        return list(BASE_FEATURES)
    ok = matrix.agg(F.min(F.col("market_ok").cast("int"))).first()[0]
    return list(ALL_FEATURES) if ok == 1 else list(BASE_FEATURES)
