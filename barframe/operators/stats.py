"""Descriptive statistics per symbol.

All outputs keep full precision; the reference rounds to 2 decimals only for
display (``display_round`` does the same when wanted).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.windows import (drawdown, ffill, pct_change, rolling_std, running, sma, win)

SQRT_YEAR = C.TRADING_DAYS_PER_YEAR ** 0.5


def with_returns(bars: DataFrame) -> DataFrame:
    """``daily_return`` = pct_change(close) (forward fill first)."""
    df = bars.withColumn("_fc", ffill("close"))
    return df.withColumn("daily_return", pct_change("_fc", 1, fill=False)).drop("_fc")


def annualised_return(r: str) -> Column:
    """A2: ``prod(1+r)^(252/n) - 1`` over non-null r; empty -> 0; growth <= 0 -> -1."""
    n = F.count(r)
    growth = F.product(F.when(F.col(r).isNotNull(), F.lit(1.0) + F.col(r)))
    return (F.when(n == 0, F.lit(0.0)).when(growth <= 0, F.lit(-1.0))
            .otherwise(F.pow(growth, F.lit(float(C.TRADING_DAYS_PER_YEAR)) / n) - F.lit(1.0)))


def annualised_volatility(r: str) -> Column:
    """A3: sample std x sqrt(252); fewer than 2 values -> 0."""
    return F.when(F.count(r) < 2, F.lit(0.0)).otherwise(F.stddev_samp(r) * F.lit(SQRT_YEAR))


def price_summary(bars: DataFrame) -> DataFrame:
    """A1 (+A4): one row per symbol with the ten summary fields (x100)."""
    df = with_returns(bars).withColumn("_dd", F.when(F.col("close").isNotNull(), drawdown("close")))
    r = F.col("daily_return")
    return df.groupBy("symbol").agg(
        F.count("*").alias("observations"),
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        (F.when(F.count("*") > 1, F.max_by("close", "date") / F.min_by("close", "date") - 1)
         .otherwise(F.lit(0.0)) * 100).alias("total_return_pct"),
        (annualised_return("daily_return") * 100).alias("annualised_return_pct"),
        (annualised_volatility("daily_return") * 100).alias("annualised_volatility_pct"),
        (F.coalesce(F.max(r), F.lit(0.0)) * 100).alias("largest_daily_gain_pct"),
        (F.coalesce(F.min(r), F.lit(0.0)) * 100).alias("largest_daily_loss_pct"),
        (F.when(F.count("close") < 2, F.lit(0.0)).otherwise(F.min("_dd")) * 100).alias("max_drawdown_pct"),
        (F.coalesce(F.avg(F.when(r.isNotNull(), (r > 0).cast("double"))), F.lit(0.0)) * 100)
        .alias("up_day_share_pct"))


def max_drawdown(bars: DataFrame, price: str = "close") -> DataFrame:
    """A4 price drawdown per symbol (with the trough date)."""
    df = bars.filter(F.col(price).isNotNull()).withColumn("_dd", drawdown(price))
    return df.groupBy("symbol").agg(
        F.when(F.count("*") < 2, F.lit(0.0)).otherwise(F.min("_dd")).alias("max_drawdown"),
        F.min_by("date", F.struct("_dd", "date")).alias("trough_date"))


def monthly_returns(bars: DataFrame) -> DataFrame:
    """A7 (long form): last close of each calendar month, months without a
    session padded by the forward fill (0 %), pct change x100."""
    m = bars.filter(F.col("close").isNotNull()).groupBy(
        "symbol", F.trunc("date", "month").alias("month_start")).agg(
        F.max_by("close", "date").alias("month_close"))
    span = m.groupBy("symbol").agg(F.min("month_start").alias("_a"), F.max("month_start").alias("_b"))
    spine = span.select("symbol", F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 MONTH")))
                        .alias("month_start"))
    s = spine.join(m, ["symbol", "month_start"], "left")
    w = win("symbol", "month_start")
    s = s.withColumn("_fc", F.last("month_close", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    s = s.withColumn("return_pct", (F.try_divide(F.col("_fc"), F.lag("_fc").over(w)) - 1) * 100)
    return s.filter(F.col("return_pct").isNotNull()).select(
        "symbol", F.year("month_start").alias("year"), F.month("month_start").alias("month"),
        F.date_format("month_start", "MMM").alias("month_name"), "return_pct")


def monthly_return_table(bars: DataFrame) -> DataFrame:
    """A7 pivot: one row per (symbol, year), a column per month name."""
    long = monthly_returns(bars)
    return long.groupBy("symbol", "year").pivot("month_name", list(C.MONTH_NAMES)).avg("return_pct")


def weekday_returns(bars: DataFrame) -> DataFrame:
    """Mean return (%) and count by weekday, Monday..Friday only."""
    df = with_returns(bars).filter(F.col("daily_return").isNotNull())
    wd = F.weekday("date")
    return df.filter(wd < 5).groupBy("symbol", wd.alias("weekday_index")).agg(
        (F.avg("daily_return") * 100).alias("mean_return_pct"),
        F.count("*").alias("observations")).withColumn(
        "weekday", F.element_at(F.array(*[F.lit(d) for d in C.WEEKDAY_NAMES]), F.col("weekday_index") + 1))


def up_down(bars: DataFrame) -> DataFrame:
    """Up sessions and down-or-flat sessions."""
    df = with_returns(bars).filter(F.col("daily_return").isNotNull())
    return df.groupBy("symbol").agg(F.count_if(F.col("daily_return") > 0).alias("up_days"),
                                    F.count_if(F.col("daily_return") <= 0).alias("down_days"))


def return_histogram(bars: DataFrame, bins: int = C.HISTOGRAM_BINS) -> DataFrame:
    """A10: equal-width bins between each symbol's min and max daily return
    (percent), count per bin, plus the symbol's mean return."""
    df = with_returns(bars).filter(F.col("daily_return").isNotNull()) \
        .withColumn("_r", F.col("daily_return") * 100)
    w = Window.partitionBy("symbol")
    df = df.select("symbol", "_r", F.min("_r").over(w).alias("_lo"), F.max("_r").over(w).alias("_hi"),
                   F.avg("_r").over(w).alias("mean_return_pct"))
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width > 0, F.least(F.floor((F.col("_r") - F.col("_lo")) / width * bins), F.lit(bins - 1))) \
        .otherwise(F.lit(0))
    df = df.withColumn("bin", b.cast("int"))
    return df.groupBy("symbol", "bin").agg(
        F.count("*").alias("count"),
        F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"),
        F.first("mean_return_pct").alias("mean_return_pct")).select(
        "symbol", "bin", "count",
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins).alias("bin_start"),
        "mean_return_pct")


def rolling_volatility(bars: DataFrame, windows=C.VOLATILITY_WINDOWS) -> DataFrame:
    """Annualised rolling volatility (%) per window."""
    df = with_returns(bars)
    return df.select("symbol", "date", *[
        (rolling_std("daily_return", n) * F.lit(SQRT_YEAR) * 100).alias(f"volatility_{n}d_pct")
        for n in windows])


def price_series(bars: DataFrame, windows=(5, 20, 50)) -> DataFrame:
    """R1 + R2: close with its moving averages, volume with its 20-day mean."""
    v = F.col("volume").cast("double")
    return bars.select("symbol", "date", "close", *[sma("close", n).alias(f"sma_{n}") for n in windows],
                       "volume", sma(v, C.VOLUME_SMA_WINDOW).alias("volume_sma_20"))


def last_non_null(x: str) -> Column:
    """Latest non-null value of x by date."""
    return F.max_by(F.col(x), F.when(F.col(x).isNotNull(), F.col("date")))


def latest_indicators(ind: DataFrame) -> DataFrame:
    """R3 + R4: the last RSI, MACD histogram, band position, close vs SMA20."""
    df = ind.select("symbol", "date", "rsi_14", "macd_hist", "bb_position",
                    (F.col("close_to_sma20") * 100).alias("close_vs_sma20_pct"))
    out = df.groupBy("symbol").agg(
        F.max("date").alias("as_of"),
        *[last_non_null(c).alias(c) for c in ("rsi_14", "macd_hist", "bb_position", "close_vs_sma20_pct")])
    return out.withColumn("rsi_flag", F.when(F.col("rsi_14") > 70, F.lit("overbought"))
                          .when(F.col("rsi_14") < 30, F.lit("oversold")))


def last_n_bars(bars: DataFrame, n: int = C.RAW_VIEW_ROWS) -> DataFrame:
    """O2: the newest n bars per symbol, newest first (a top-k per group)."""
    w = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    return bars.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= n)


def display_round(df: DataFrame, digits: int = 2) -> DataFrame:
    from pyspark.sql import types as T
    return df.select(*[F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])
