"""Technical indicators as window expressions (all trailing / causal)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.segments import POS, SLICE, positioned, with_halo, without_halo
from ..functions.windows import (SYMBOL, EmaSpec, diff, full, lag, rolling_std, sdiv, sma,
                                 with_ema)

#: A slice of a symbol with its halo.
FRAME = [SYMBOL, SLICE]


def gain_loss(close: str = "close", part=SYMBOL) -> tuple[Column, Column]:
    """Clipped deltas; a null delta stays null (``greatest`` alone would skip it)."""
    d = diff(close, part)
    gain = F.when(d.isNotNull(), F.greatest(d, F.lit(0.0)))
    loss = F.when(d.isNotNull(), -F.least(d, F.lit(0.0)))
    return gain, loss


def true_range(part=SYMBOL) -> Column:
    prev_close = lag("close", 1, part)
    return F.greatest(F.col("high") - F.col("low"),
                      F.abs(F.col("high") - prev_close),
                      F.abs(F.col("low") - prev_close))


def rsi_from_averages(avg_gain: str, avg_loss: str) -> Column:
    g, l = F.col(avg_gain), F.col(avg_loss)
    return (F.when(g.isNull() | l.isNull(), F.lit(None).cast("double"))
            .when(g == 0.0, F.lit(0.0))
            .when(l == 0.0, F.lit(100.0))
            .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + g / l)))


def with_indicator_inputs(bars: DataFrame) -> DataFrame:
    """Columns fed to the exponential smoothers; they reach back one row. bars have positions."""
    gain, loss = gain_loss(part=FRAME)
    return without_halo(with_halo(bars, SYMBOL, 1).select("*", gain.alias("_gain"), loss.alias("_loss"), true_range(FRAME).alias("_tr")))


def first_pass_specs() -> list[EmaSpec]:
    specs = [EmaSpec.span(f"ema{n}", "close", n) for n in C.EMA_WINDOWS]
    for n in (C.MACD_FAST, C.MACD_SLOW):
        if n not in C.EMA_WINDOWS:
            specs.append(EmaSpec.span(f"ema{n}", "close", n))
    specs += [EmaSpec.wilder("_avg_gain", "_gain", C.RSI_WINDOW),
              EmaSpec.wilder("_avg_loss", "_loss", C.RSI_WINDOW),
              EmaSpec.wilder("atr14", "_tr", 14)]
    return specs


def with_smoothed(bars: DataFrame) -> DataFrame:
    """EMA 10/12/20/26, RSI, ATR and the MACD line/signal/histogram (raw units).

    Two EMA passes: the first-level smoothers share one pass, the MACD signal
    (an EMA of the MACD line) needs a second one. Bars without positions get them
    for the while.
    """
    own = POS in bars.columns
    df = with_ema(with_indicator_inputs(bars if own else positioned(bars)), first_pass_specs())
    df = df.withColumn("rsi14", rsi_from_averages("_avg_gain", "_avg_loss"))
    df = df.withColumn("macd_line", F.col(f"ema{C.MACD_FAST}") - F.col(f"ema{C.MACD_SLOW}"))
    df = with_ema(df, [EmaSpec.span("macd_signal_line", "macd_line", C.MACD_SIGNAL)])
    df = df.withColumn("macd_hist_line", F.col("macd_line") - F.col("macd_signal_line"))
    return df.drop("_gain", "_loss", "_tr", "_avg_gain", "_avg_loss", *([] if own else [POS, SLICE]))


def bollinger_columns(close: str = "close", n: int = C.BOLLINGER_WINDOW,
                      k: float = C.BOLLINGER_STD, middle: Column | None = None,
                      count: Column | None = None, part=SYMBOL) -> dict[str, Column]:
    middle = middle if middle is not None else sma(close, n, part)
    spread = full(close, n, F.stddev_pop, part, count=count)
    upper = middle + F.lit(k) * spread
    lower = middle - F.lit(k) * spread
    return {
        "bb_middle": middle,
        "bb_upper": upper,
        "bb_lower": lower,
        "bb_width": sdiv(upper - lower, middle),
        "bb_position": sdiv(F.col(close) - lower, upper - lower),
    }


def rsi_flag(rsi: str = "rsi14") -> Column:
    return (F.when(F.col(rsi) > 70, F.lit("overbought"))
            .when(F.col(rsi) < 30, F.lit("oversold")))


__all__ = ["with_smoothed", "bollinger_columns", "rsi_flag", "true_range",
           "gain_loss", "rsi_from_averages", "full"]
