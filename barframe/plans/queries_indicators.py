"""Indicator levels (W4-W11) as their own queries: EMA, RSI, MACD, Bollinger
bands, ATR. Price-level outputs keep 8 significant digits and MACD lines 3
decimals (the block EMA and the row-by-row recursion agree to about 1e-15
relative, 3e-10 absolute on MACD), RSI 6 decimals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.segments import positioned, with_halo, without_halo
from ..operators.indicators import FRAME, bollinger_columns, rsi_flag, with_smoothed
from ..sources.ticks import daily_bars
from . import oracle as O
from .catalog import _bars_ctes, bars_once, register, round_half_up, round_sig

LEVEL_DIGITS = 8
MACD_DECIMALS = 3


def _indicators(spark, sf):
    return with_smoothed(daily_bars(spark, sf))


def _sql(select: str) -> str:
    return O.sql(_bars_ctes() + O.feature_ctes(market=None), f"SELECT symbol, date, {select} FROM feat")


EMA_NS = sorted(set(C.EMA_WINDOWS) | {C.MACD_FAST, C.MACD_SLOW})


@register("ema", _sql(", ".join(O.rnd_sig(f"e{n}", f"ema{n}", LEVEL_DIGITS) for n in EMA_NS)))
def q_ema(spark, sf):
    """Span EMAs 10/12/20/26 of the close (null until n observations)."""
    df = _indicators(spark, sf)
    return df.select("symbol", "date", *[round_sig(f"ema{n}", LEVEL_DIGITS).alias(f"ema{n}") for n in EMA_NS])


@register("rsi", _sql(f"""{O.rnd('rsi14', 'rsi_14')},
       CASE WHEN rsi14 > 70 THEN 'overbought' WHEN rsi14 < 30 THEN 'oversold' END AS rsi_flag"""))
def q_rsi(spark, sf):
    """W6 + W7 + R4: Wilder RSI(14) and its 70/30 flags."""
    df = _indicators(spark, sf)
    return df.select("symbol", "date", round_half_up("rsi14").alias("rsi_14"), rsi_flag().alias("rsi_flag"))


@register("macd", _sql(", ".join([O.rnd("macd_line", "macd", MACD_DECIMALS),
                                  O.rnd("macd_signal_line", "macd_signal", MACD_DECIMALS),
                                  O.rnd("macd_line - macd_signal_line", "macd_hist", MACD_DECIMALS)])))
def q_macd(spark, sf):
    """MACD line, signal and histogram (price units)."""
    df = _indicators(spark, sf)
    return df.select("symbol", "date", round_half_up("macd_line", MACD_DECIMALS).alias("macd"),
                     round_half_up("macd_signal_line", MACD_DECIMALS).alias("macd_signal"),
                     round_half_up("macd_hist_line", MACD_DECIMALS).alias("macd_hist"))


@register("atr", _sql(O.rnd_sig("atr14", "atr_14", LEVEL_DIGITS)))
def q_atr(spark, sf):
    """True range smoothed with alpha 1/14."""
    df = _indicators(spark, sf)
    return df.select("symbol", "date", round_sig("atr14", LEVEL_DIGITS).alias("atr_14"))


#: A stretch without prices in every symbol: from this row to this share of its rows.
GAP_FROM, GAP_TO = 100, 0.8
PRICES = ("open", "high", "low", "close", "adj_close")


def gapped_bars(spark, sf) -> DataFrame:
    """Daily bars whose prices are null over most of each series."""
    bars = bars_once(spark, sf)
    row = F.row_number().over(Window.partitionBy("symbol").orderBy("date")) - 1
    n = F.count("*").over(Window.partitionBy("symbol"))
    bars = bars.select("*", row.alias("_r"), n.alias("_n"))
    gap = (F.col("_r") >= GAP_FROM) & (F.col("_r") < F.floor(F.col("_n") * F.lit(GAP_TO)))
    return bars.select("symbol", "date", *[F.when(~gap, F.col(c)).alias(c) for c in PRICES], "volume")


def _gap_sql(select: str) -> str:
    ctes = [("bars0", _bars_ctes()[0][1]), ("bars1", "SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS r, "
                                            "count(*) OVER (PARTITION BY symbol) AS n FROM bars0"),
            ("bars", "SELECT symbol, date, " + ", ".join(f"CASE WHEN NOT (r >= {GAP_FROM} AND r < floor(n * {GAP_TO!r})) THEN {c} END AS {c}"
                                                         for c in PRICES) + ", volume FROM bars1")]
    return O.sql(ctes + O.feature_ctes(market=None), f"SELECT symbol, date, {select} FROM feat")


@register("ema_gaps", _gap_sql(", ".join(O.rnd_sig(f"e{n}", f"ema{n}", LEVEL_DIGITS) for n in EMA_NS)))
def q_ema_gaps(spark, sf):
    """W5 over a long run of nulls: the value is carried through it."""
    df = with_smoothed(gapped_bars(spark, sf))
    return df.select("symbol", "date", *[round_sig(f"ema{n}", LEVEL_DIGITS).alias(f"ema{n}") for n in EMA_NS])


@register("rsi_gaps", _gap_sql(O.rnd("rsi14", "rsi_14")))
def q_rsi_gaps(spark, sf):
    """W6 + W7 over a long run of nulls."""
    df = with_smoothed(gapped_bars(spark, sf))
    return df.select("symbol", "date", round_half_up("rsi14").alias("rsi_14"))


# a 20-row mean of two-decimal prices is a short terminating decimal: keep
# enough digits to hold it exactly, so no rounding tie can arise
MIDDLE_DIGITS = 10
_MID = O.full("close", C.BOLLINGER_WINDOW, "avg")
_SD = O.full("close", C.BOLLINGER_WINDOW, "stddev_pop")


@register("bollinger", O.sql(_bars_ctes(), f"""SELECT symbol, date,
       {O.rnd_sig(_MID, 'bb_middle', MIDDLE_DIGITS)},
       {O.rnd_sig(f'{_MID} + {C.BOLLINGER_STD} * {_SD}', 'bb_upper', LEVEL_DIGITS)},
       {O.rnd_sig(f'{_MID} - {C.BOLLINGER_STD} * {_SD}', 'bb_lower', LEVEL_DIGITS)} FROM bars"""))
def q_bollinger(spark, sf):
    """Middle, upper and lower bands (20 rows, population std, 2 sigma)."""
    b = bollinger_columns(part=FRAME)
    bars = with_halo(positioned(daily_bars(spark, sf)), "symbol", C.BOLLINGER_WINDOW - 1)
    return without_halo(bars.select("symbol", "date", "_own", *[e.alias(k) for k, e in b.items()])).select(
        "symbol", "date", round_sig("bb_middle", MIDDLE_DIGITS).alias("bb_middle"),
        *[round_sig(c, LEVEL_DIGITS).alias(c) for c in ("bb_upper", "bb_lower")])
